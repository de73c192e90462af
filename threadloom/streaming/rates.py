"""Posts per track term and period: live and in batch, with totals and stalls."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom.operators import filters as P
from threadloom.operators.distributions import bounded_sequence
from threadloom.session import materialise
from threadloom.sources.writers import write_batch
from threadloom.streaming.batches import latest, start

REPORT_PERIOD = "600 seconds"


def rates(posts: DataFrame, every: str = REPORT_PERIOD) -> DataFrame:
    """Posts per (period, query). Counted in the map tasks first, so a busy query is no hot key."""
    return posts.groupBy(F.window("created_at", every).alias("w"), "query").agg(F.count(F.lit(1)).alias("n"))


def flat(counted: DataFrame) -> DataFrame:
    return counted.select(
        F.col("w.start").cast("timestamp_ntz").alias("period_start"),
        F.col("w.end").cast("timestamp_ntz").alias("period_end"),
        *[c for c in counted.columns if c != "w"],
    )


def live_rates(stream: DataFrame, every: str = REPORT_PERIOD, delay: str = "10 minutes") -> DataFrame:
    """The same over a stream; a period is given out once the watermark has passed its end."""
    timed = stream.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return flat(rates(timed.withWatermark("created_at", delay), every))


def report(counted: DataFrame) -> DataFrame:
    """Per query and period the new posts, the posts before, and the total so far."""
    w = Window.partitionBy("query").orderBy("period_start")
    total = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("total", total).withColumn("before", F.col("total") - F.col("n"))


def period_totals(posts: DataFrame, every: str = REPORT_PERIOD) -> DataFrame:
    """Per period: each query and, as the row without a query, all of them."""
    timed = posts.select(F.window("created_at", every).alias("w"), "query")
    per_query = timed.groupBy("w", "query").agg(F.count(F.lit(1)).alias("n"))
    # The second level adds up the first: the posts are shuffled once.
    whole = per_query.groupBy("w").agg(F.sum("n").alias("n")).withColumn("query", F.lit(None).cast("string"))
    return flat(per_query.unionByName(whole))


def _interval(every: str):
    return F.expr(f"INTERVAL '{every.split()[0]}' {every.split()[1].rstrip('s')}")


def _slots(first: Column, last: Column, every: str) -> Column:
    """The periods from ``first`` to ``last``; more than ``GRID_LIMIT`` are taken for a wrong time and fail."""
    seconds = pd.Timedelta(every).total_seconds()
    steps = (F.unix_seconds(last.cast("timestamp")) - F.unix_seconds(first.cast("timestamp"))) / seconds
    return F.explode(bounded_sequence(first, last, _interval(every), steps))


def in_range(counted: DataFrame, within: tuple[dt.datetime, dt.datetime] | None) -> DataFrame:
    """The periods that start in a stated range, both ends included; all of them without one."""
    if within is None:
        return counted
    return counted.where(F.col("period_start").between(*[F.lit(w).cast("timestamp_ntz") for w in within]))


def grid(spark: SparkSession, tracks: Sequence[str] | DataFrame, first: Column, last: Column, every: str) -> DataFrame:
    """Every track in every period from ``first`` to ``last``."""
    tracks = tracks if isinstance(tracks, DataFrame) else spark.createDataFrame([(t,) for t in dict.fromkeys(tracks)], "query string")
    return tracks.select("query").withColumn("period_start", _slots(first, last, every))


def with_silence(
    counted: DataFrame, tracks: Sequence[str] | None = None, every: str = REPORT_PERIOD, within: tuple[dt.datetime, dt.datetime] | None = None
) -> DataFrame:
    """A row for every track and period between the first and last one seen, 0 where there was no post.

    Without ``tracks`` those that occur count. Periods outside of ``within`` are left out. The counts are written first: ends and grid read them again.
    """
    counted = materialise(in_range(counted, within).select("query", "period_start", "n"), "rates")
    first, last = _ends(counted)
    slots = grid(counted.sparkSession, counted.select("query").distinct() if tracks is None else tracks, first, last, every)
    full = slots.join(counted, ["query", "period_start"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    return full.withColumn("period_end", F.col("period_start") + _interval(every))


def _ends(counted: DataFrame) -> tuple[Column, Column]:
    ends = counted.agg(F.min("period_start").alias("a"), F.max("period_start").alias("b"))
    return ends.select("a").scalar(), ends.select("b").scalar()


def stalls(
    counted: DataFrame, every: str = REPORT_PERIOD, tracks: Sequence[str] | None = None, within: tuple[dt.datetime, dt.datetime] | None = None
) -> DataFrame:
    """Periods between the first and last one seen in which a track had no post at all.

    Without ``tracks`` those that occur are watched. Periods outside of ``within`` are left out. The counts are written first: ends, tracks and gaps all
    read them, and the posts are scanned once.
    """
    counted = materialise(in_range(counted, within).select("query", "period_start"), "rates")
    first, last = _ends(counted)
    slots = grid(counted.sparkSession, counted.select("query").distinct() if tracks is None else tracks, first, last, every)
    return slots.join(counted, ["query", "period_start"], "left_anti")


WATCHED = T.StructType([T.StructField("query", T.StringType()), T.StructField("last", T.TimestampNTZType()), T.StructField("first", T.TimestampNTZType())])


def watch(
    counted: DataFrame,
    folder: str,
    checkpoint: str,
    every: str = REPORT_PERIOD,
    period: str | None = None,
    tracks: Sequence[str] | None = None,
) -> StreamingQuery:
    """Live rates and stalls: adds closed periods to ``rates`` and, with them, the silent ones to ``stalls``.

    A period is closed for all queries at once, so what is missing in it when it comes is missing for
    good. The tracks given are watched from the first period on; without a list a query is watched once it
    shows up, the periods before that included. What a batch needs of the past is one row per track, kept
    in ``watched``: the history of counts is not read again.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        write_batch(batch, f"{folder}/rates", number)
        batch = spark.read.schema(batch.schema).parquet(f"{folder}/rates/batch={number}").select("query", "period_start")
        before = materialise(latest(spark, f"{folder}/watched", WATCHED, number), "watched")
        new = batch.groupBy("query").agg(F.min("period_start").alias("first"), F.max("period_start").alias("last"))
        known = before.unionByName(new)
        if tracks is not None:
            listed = spark.createDataFrame([(t, None, None) for t in dict.fromkeys(tracks)], WATCHED)
            known = P.only_keys(known, listed, "query").unionByName(listed)
        ends = before.unionByName(new).agg(F.max("last").alias("last"), F.min("first").alias("first"))
        state = known.groupBy("query").agg(F.max("last").alias("own")).select("query", ends.select("last").scalar().alias("last"), ends.select("first").scalar().alias("first"))
        write_batch(state, f"{folder}/watched", number)
        old = before.select("query", F.col("last").alias("_old")).groupBy("query").agg(F.max("_old").alias("_old"))
        # A track that was watched before goes on after the last closed period, a new one starts with the first.
        since = state.join(old, "query", "left").where(F.col("last").isNotNull())
        from_ = F.coalesce(F.col("_old") + _interval(every), F.col("first"))
        slots = since.where(from_ <= F.col("last")).select("query", _slots(from_, F.col("last"), every).alias("period_start"))
        write_batch(slots.join(batch, ["query", "period_start"], "left_anti"), f"{folder}/stalls", number)

    return start(counted, work, checkpoint, period)
