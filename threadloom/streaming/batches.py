"""Tables that a stream adds to, one folder per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

Work = Callable[[DataFrame, int], None]


def stored(spark: SparkSession, table: str, schema: T.StructType, before: int) -> DataFrame:
    """The rows of the batches before this one; other folders are pruned by name."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return _with_batch(spark, table, with_batch, before).drop("batch")


def _with_batch(spark: SparkSession, table: str, schema: T.StructType, before: int) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(table).where(F.col("batch") < before)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest(spark: SparkSession, table: str, schema: T.StructType, before: int) -> DataFrame:
    """The rows of the last batch before this one: for a table of which every batch holds the whole state."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = _with_batch(spark, table, with_batch, before)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == F.lit(-1 if last is None else last)).drop("batch")


def start(stream: DataFrame, work: Work, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Run ``work`` per batch: every ``period``, or over what is there and then stop."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)).start()
