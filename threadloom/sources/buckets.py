"""Tables kept in buckets of keys, one folder each: a batch meets, and an update rewrites, only the buckets of its own keys.

Ids grow with time, but the posts that a lookup finds are years older than those that ask for them, so the range of
a batch's ids says nothing. The hash of an id does: a batch of n ids has at most n buckets, however old they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import materialise
from threadloom.sources.writers import absent_rows, updated

BUCKETS = 1_024
BUCKET = "bucket"


def bucket_of(key: Column | str, buckets: int) -> Column:
    """Bucket of a key; rows without a key share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass
class BucketStore:
    """A table under ``path`` in folders ``bucket=<b>``; ``schema`` is that of its rows, without the bucket."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str = "id"
    buckets: int = BUCKETS

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.fieldNames(), bucket_of(self.key, self.buckets).alias(BUCKET))

    def read(self) -> DataFrame:
        """All rows, with their bucket; a table that has not been written yet is empty."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def touched(self, keys: DataFrame, key: str | None = None) -> list[int]:
        """The buckets of some keys: at most ``buckets`` numbers."""
        numbers = keys.select(bucket_of(key or self.key, self.buckets).alias(BUCKET)).distinct()
        return sorted(r[0] for r in numbers.collect())

    def near(self, keys: DataFrame, key: str | None = None) -> DataFrame:
        """The rows in the buckets of ``keys``; other folders are neither listed for reading nor opened."""
        return self.read().where(F.col(BUCKET).isin(self.touched(keys, key)))

    def create(self, rows: DataFrame) -> None:
        """Replace the whole table; ``rows`` must not be read from it."""
        dealt = self.bucketed(rows).repartition(BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def insert(self, new: DataFrame, order: Sequence[Column]) -> None:
        """Add the first copy, by ``order``, of every key that is not there yet; rows without a key are left out.

        Done again after a failure it adds what is still missing and nothing else, so a stream may call it
        for a batch any number of times.
        """
        new = new.select(*self.schema.fieldNames())
        rows = self.bucketed(absent_rows(new, self.near(new).drop(BUCKET), self.key, order))
        rows.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        """Add rows as they are, keys that are there included."""
        self.bucketed(rows).repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def _replace(self, rows: DataFrame, name: str) -> None:
        """Put ``rows`` in place of all rows of their buckets. They are written to the work folder first: a loss while
        folders are exchanged leaves a whole copy there."""
        staged = materialise(rows, name)
        dealt = staged.repartition(BUCKET)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def update(self, changes: DataFrame, columns: Sequence[str]) -> None:
        """Set ``columns`` of the rows whose key is in ``changes`` (unique by key). Buckets without such a row keep their files."""
        found = self.near(changes)
        held = found.join(changes.select(F.col(self.key).alias("_changed")), F.col(self.key) == F.col("_changed"), "left_semi")
        # A bucket may have been asked for by a key that is not in the table.
        due = sorted(r[0] for r in held.select(BUCKET).distinct().collect())
        if due:
            self._replace(updated(self.read().where(F.col(BUCKET).isin(due)), changes, self.key, columns), "updated-buckets")

    def compact(self, files: int = 8) -> list[int]:
        """Merge the files of every bucket that has more than ``files``; returns these buckets. Readers see the same rows."""
        counted = self.read().select(BUCKET, F.input_file_name().alias("file")).distinct().groupBy(BUCKET).count()
        due = sorted(r[0] for r in counted.where(F.col("count") > files).select(BUCKET).collect())
        if due:
            self._replace(self.read().where(F.col(BUCKET).isin(due)), "merged-buckets")
        return due
