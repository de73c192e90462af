"""Scans: store tables, releases, id lists, annotations, landed responses and pages, live posts."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import model
from threadloom.functions import scalars as X
from threadloom.functions import text as TX
from threadloom.operators import filters as P
from threadloom.sources.arrays import array_records

BROKEN = "_corrupt_record"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A store table. Giving the schema spares the look into file footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool) -> DataFrame:
    """JSON records; broken ones keep their text in ``_corrupt_record`` instead of vanishing.

    ``array`` reads files of one array each, printed over lines or not, by a task per split (:func:`array_records`); of a file
    that does not balance every piece is broken. Without it, one record per line, split over tasks.
    """
    with_broken = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    if not array:
        return spark.read.schema(with_broken).options(**options).json(path)
    parsed = F.from_json("record", with_broken, options)
    unsound = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("record").alias(BROKEN))
    return array_records(spark, path).select(F.when(F.col("sound"), parsed).otherwise(unsound).alias("r")).select("r.*")


def _whole(key: str) -> Column:
    """A record that parsed and has its key. (Spark does not let a query use the broken text alone.)"""
    return F.col(BROKEN).isNull() & F.col(key).isNotNull()


def read_release(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Articles of a release with real timestamps; the rest is in :func:`broken_records`."""
    good = read_json(spark, path, model.RELEASE_FILE, array).where(_whole("tweet_id")).drop(BROKEN)
    return good.withColumns(
        {"created_at": X.unwrap_date(F.col("created_at")), "part": F.coalesce("part", F.lit(0).cast("long"))}
    )


def release_tables(release: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nested rows as read: the articles, one row each, and their comments, flat, with the block they stood in."""
    articles = release.drop("comments", "part").dropDuplicates(["tweet_id"])
    comments = release.select(F.col("tweet_id").alias("article_id"), "part", F.posexplode("comments").alias("place", "c"))
    return articles, comments.select("article_id", "part", "place", "c.*")


def broken_records(spark: SparkSession, path: str, schema: T.StructType, array: bool = False, key: str = "tweet_id") -> DataFrame:
    """Records that do not parse, with their text, and those without a key."""
    return read_json(spark, path, schema, array).where(~_whole(key))


def read_annotations(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    return read_json(spark, path, model.ANNOTATION, array).where(_whole("tweet_id")).drop(BROKEN)


def read_id_csv(spark: SparkSession, path: str, column: str = "ID_OT") -> DataFrame:
    """Ids of a Latin-1 CSV with a header, as (tweet_id); entries that are no integers give null."""
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return raw.select(X.to_id(F.col(column)).alias("tweet_id"))


def payloads(responses: DataFrame, schema: T.StructType = model.POST) -> DataFrame:
    """Posts out of landed JSON payloads."""
    got = responses.where(F.col("payload").isNotNull())
    return got.select(F.from_json("payload", schema).alias("post")).select("post.*")


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 64, **options: str
) -> DataFrame:
    """Live posts: files landing in a folder, a bounded number per batch."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(folder)


@dataclass(frozen=True)
class QuerySpec:
    """What a release holds. Every part is optional; parts left out do not restrict."""

    users: list[str] | None = None
    min_date: str | None = None
    search_terms: list[str] | None = None

    @classmethod
    def load(cls, path: str) -> QuerySpec:
        with open(path, encoding="utf-8") as f:
            return cls.of(json.load(f))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> QuerySpec:
        """From a file on any storage that Spark reads."""
        return cls.of(json.loads(spark.read.text(path, wholetext=True).first()[0]))

    @classmethod
    def of(cls, spec: dict) -> QuerySpec:
        return cls(spec.get("users"), spec.get("min_date"), spec.get("search_terms"))

    def predicate(self, text: Column | None = None) -> Column:
        """The spec as one column: users, then date (inclusive), then terms, all of which must hold."""
        keep = F.lit(True)
        if self.users is not None:
            keep = keep & P.by_users(self.users)
        if self.min_date is not None:
            moment = dt.datetime.strptime(self.min_date, "%Y-%m-%dT%H:%M:%SZ")
            keep = keep & P.since(moment)
        if self.search_terms is not None:
            text = TX.searched_text("title", "text", "body") if text is None else text
            keep = keep & TX.matches(text, " ".join(self.search_terms))
        return keep
