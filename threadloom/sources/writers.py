"""Sinks: insert if absent, update by key, snapshots, and release files.

Nothing overwrites a path that is being read. A snapshot or a batch goes to a folder of its own, so a
job that is run again after a loss replaces only what it had written itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import scalars as X
from threadloom.model import RELEASE_FIELDS
from threadloom.operators.groups import first_wins


def absent_rows(new: DataFrame, stored: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The rows to insert: first copy per key, keys in the store left out, rows without a key left out.

    The store is never shuffled for a small batch: it is narrowed to the batch's keys by a semi join
    (a broadcast once adaptive execution has measured the batch), and what is left is no longer than
    the batch.
    """
    fresh = first_wins(new.where(F.col(key).isNotNull()), [key], order)
    keys = new.select(F.col(key).alias("_wanted")).distinct()
    seen = stored.select(F.col(key).alias("_seen")).join(keys, F.col("_seen") == F.col("_wanted"), "left_semi")
    return fresh.join(seen, F.col(key) == F.col("_seen"), "left_anti")


def narrowed(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The store between the smallest and largest key of ``new``.

    Ids grow with time, so this bound on two literals lets the Parquet reader skip nearly all row
    groups of the store; it drops no key that could be equal to one of ``new``.
    """
    ends = new.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return stored.where(F.col(key).between(ends.lo, ends.hi)) if ends.lo is not None else stored.limit(0)


def absent_errors(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Errors to insert: those with a code, the first per post, posts with an error left out."""
    coded = new.where(F.col("api_code").isNotNull())
    return absent_rows(coded, stored, "tweet_id", [F.col("api_code"), F.col("message")])


def updated(rows: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` replaced where ``changes``, unique by key, has the key; others untouched."""
    renamed = changes.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows.join(renamed, F.col(key) == F.col("_key"), "left")
    changed = F.col("_key").isNotNull()
    new = {c: F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(new).select(*rows.columns)


def write_batch(rows: DataFrame, table: str, batch: int, by: Sequence[str] = ()) -> None:
    """One batch of an append-only table, in its own folder; writing it again replaces it."""
    writer = rows.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{table}/batch={batch}")


def write_snapshot(rows: DataFrame, table: str, version: int) -> DataFrame:
    """A whole table as one version; returns it as read back."""
    path = f"{table}/version={version}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Drop and rebuild; ``rows`` must not be read from ``path``."""
    rows.write.mode("overwrite").parquet(path)


def release_rows(articles: DataFrame) -> DataFrame:
    """The fields of a release file, dates wrapped; ``part`` tells the rows of one large article apart."""
    return articles.select(*RELEASE_FIELDS, "part").withColumn("created_at", X.wrap_date("created_at"))


def write_release(articles: DataFrame, path: str) -> None:
    """A release as JSON, one record per line, one file per task."""
    release_rows(articles).write.mode("overwrite").json(path)


def write_arrays(articles: DataFrame, path: str, key: str, records: int = 10_000) -> None:
    """Files of one JSON array each, printed over lines, dates wrapped. Rows are dealt by hash of ``key``, about ``records`` to a file."""
    files = articles.count() // records + 1
    rows = articles.withColumn("created_at", X.wrap_date("created_at"))
    dealt = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(files)).alias("part")).agg(F.collect_list(F.struct(*rows.columns)).alias("all"))
    dealt.select("part", F.to_json("all", {"pretty": "true"}).alias("value")).write.mode("overwrite").partitionBy("part").text(path)


def dated_rows(articles: DataFrame, drop: Sequence[str] = ("_id",)) -> DataFrame:
    """Without the internal id, dates spelled out."""
    return articles.drop(*drop).withColumn("created_at", X.long_date("created_at"))


def write_dated(articles: DataFrame, path: str) -> None:
    dated_rows(articles).write.mode("overwrite").json(path)


def dump(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A table or query result as it is, in Parquet or JSON."""
    rows.write.mode("overwrite").format(fmt).save(path)


def write_parquet(rows: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Convert once: what is read from a single JSON array is written as splittable Parquet."""
    writer = rows.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
