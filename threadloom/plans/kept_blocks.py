"""Nested replies kept up to date: a batch fills the last open block of its parents; a late reply renumbers from its place on.

Blocks are written once per batch that changes them, with the batch's number, and the newest one counts. What a
batch reads of the past are sizes and ends of its parents' blocks, and the replies of those it changes.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.groups import BLOCK_ROWS, HOT_ROWS, number_within
from threadloom.session import materialise
from threadloom.sources.buckets import BUCKET, BUCKETS, bucket_of
from threadloom.sources.writers import write_batch

LATEST = 1 << 62
COMMENT_ORDER = ["created_at", "tweet_id", "text", "hateful_value"]


@dataclass
class KeptBlocks:
    """Replies of each ``parent`` in ``order`` (plain columns of the replies, the same kinds in every batch) in arrays of ``block_rows``.

    All blocks but a parent's last are full. Any cut of the replies into batches, in any order, gives the blocks of
    ``nest_in_parts`` over all of them; a batch that runs again replaces its own folder. Replies without a parent are
    left out; repeated ones are kept. A block holds each column once, whether it orders the replies, is given out, or both.
    """

    spark: SparkSession
    folder: str
    replies: T.StructType
    parent: str
    order: Sequence[str]
    fields: Sequence[str]
    block_rows: int = BLOCK_ROWS
    hot_rows: int = HOT_ROWS
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        kinds = {f.name: f.dataType for f in self.replies.fields}
        self.columns = list(dict.fromkeys([*self.order, *self.fields]))
        # The end of a block is known by the order up to the first text: with equal ends it is written again, to the same rows.
        plain = list(itertools.takewhile(lambda c: not isinstance(kinds[c], T.StringType | T.BinaryType), self.order))
        self.ends = plain or list(self.order[:1])
        self.block = T.StructType(
            [
                T.StructField("owner", kinds[self.parent]),
                T.StructField("part", T.LongType()),
                T.StructField("size", T.IntegerType()),
                T.StructField("last", T.StructType([T.StructField(c, kinds[c]) for c in self.ends])),
                T.StructField("items", T.ArrayType(T.StructType([T.StructField(c, kinds[c]) for c in self.columns]))),
                T.StructField("batch", T.LongType()),
                T.StructField(BUCKET, T.IntegerType()),
            ]
        )

    def _stored(self, before: int) -> DataFrame:
        try:
            return self.spark.read.schema(self.block).parquet(self.folder).where(F.col("batch") < before)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.block)

    @staticmethod
    def _newest(blocks: DataFrame, *more: str) -> DataFrame:
        """owner, part, size, last, batch and ``more`` of the blocks that count; the replies are not read."""
        newest = F.max_by(F.struct("size", "last", "batch", *more), "batch").alias("b")
        return blocks.groupBy("owner", "part").agg(newest).select("owner", "part", "b.*")

    def add(self, replies: DataFrame, number: int) -> None:
        owned = replies.where(F.col(self.parent).isNotNull())
        # Column names of the replies may be those of a block's.
        named = [F.col(c).alias(f"_{i}") for i, c in enumerate(self.columns)]
        new = materialise(owned.select(F.col(self.parent).alias("owner"), *named), "new-replies")
        end = F.struct(*[F.col(f"_{self.columns.index(c)}").alias(c) for c in self.ends])
        owners = materialise(new.groupBy("owner").agg(F.min(end).alias("earliest"), F.count("*").alias("_n")), "owners")
        touched = [r[0] for r in owners.select(bucket_of("owner", self.buckets)).distinct().collect()]
        near = self._stored(number).where(F.col(BUCKET).isin(touched))
        # Whole blocks that end before the earliest new reply stay as they are; all that follow the first of the others change.
        held = self._newest(near.join(owners.select("owner", "earliest"), "owner"), "earliest")
        changes = (F.col("size") < self.block_rows) | (F.col("last") >= F.col("earliest"))
        held = materialise(held.select("owner", "part", "batch", "size", changes.alias("changes")), "held-blocks")
        starts = held.groupBy("owner").agg(F.count_if(~F.col("changes")).alias("start"))
        due = held.where("changes").select(*[F.col(c).alias(f"_{c}") for c in ("owner", "part", "batch")])
        due_here = (F.col("owner") == F.col("_owner")) & (F.col("part") == F.col("_part")) & (F.col("batch") == F.col("_batch"))
        old = near.join(due, due_here, "left_semi").select("owner", F.explode("items").alias("r"))
        rows = old.select("owner", *[F.col("r")[c].alias(f"_{i}") for i, c in enumerate(self.columns)]).unionByName(new)
        # The sizes are known from the blocks: the replies need not be put together twice to count them.
        known = owners.select("owner", "_n").unionByName(held.where("changes").select("owner", F.col("size").cast("long").alias("_n")))
        sizes = known.groupBy("owner").agg(F.sum("_n").alias("_n"))
        by = [f"_{self.columns.index(c)}" for c in self.order]
        numbered = number_within(rows, ["owner"], by, "_number", self.hot_rows, sizes)
        item = F.struct(*[F.col(f"_{i}").alias(c) for i, c in enumerate(self.columns)])
        placed = numbered.join(starts, "owner", "left").select(
            "owner",
            (F.coalesce("start", F.lit(0)) + F.floor((F.col("_number") - 1) / self.block_rows)).cast("long").alias("part"),
            F.struct("_number", item.alias("r")).alias("x"),
        )
        # Numbered by owner, the replies are packed where they are, and written from there.
        packed = placed.groupBy("owner", "part").agg(F.array_sort(F.collect_list("x")).alias("x"))
        last = F.element_at("x", -1)["r"]
        packed = packed.select("owner", "part", F.size("x").alias("size"), F.struct(*[last[c].alias(c) for c in self.ends]).alias("last"), F.col("x.r").alias("items"))
        write_batch(packed.withColumn(BUCKET, bucket_of("owner", self.buckets)), self.folder, number, [BUCKET])

    def _given(self) -> Column:
        return F.transform("items", lambda x: F.struct(*[x[c].alias(c) for c in self.fields])).alias("items")

    def read(self) -> DataFrame:
        """owner, part and ``items`` of the blocks that count. Older versions, a short list, are taken out; blocks are not moved."""
        blocks = self._stored(LATEST)
        newest = F.max("batch").over(Window.partitionBy("owner", "part"))
        old = blocks.select("owner", "part", "batch").withColumn("newest", newest).where("batch < newest")
        old = materialise(old.select(*[F.col(c).alias(f"_{c}") for c in ("owner", "part", "batch")]), "old-blocks")
        there = (F.col("owner") == F.col("_owner")) & (F.col("part") == F.col("_part"))
        rows = blocks.join(old, there & (F.col("batch") == F.col("_batch")), "left_anti")
        return rows.select("owner", "part", self._given())

    def nested(self, parents: DataFrame, key: str, into: str = "comments") -> DataFrame:
        """Every parent with its blocks, one row each; without replies an empty part 0.

        Blocks are dealt by owner once: older versions are taken out where the blocks meet their parents.
        """
        dealt = self._stored(LATEST).select("owner", "part", "batch", self._given()).repartition("owner")
        newest = F.row_number().over(Window.partitionBy("owner", "part").orderBy(F.desc("batch")))
        blocks = dealt.withColumn("_version", newest).where("_version = 1").drop("_version", "batch")
        joined = parents.join(blocks.hint("merge"), F.col(key) == F.col("owner"), "left")
        filled = {into: F.coalesce("items", F.array()), "part": F.coalesce("part", F.lit(0).cast("long"))}
        return joined.withColumns(filled).drop("owner", "items")


def kept_blocks(spark: SparkSession, folder: str, comments: T.StructType, block_rows: int = BLOCK_ROWS, **more) -> KeptBlocks:
    """The comments of articles, flat as in ``comments_of``: nested as ``with_comments`` nests them."""
    return KeptBlocks(spark, folder, comments, "article_id", COMMENT_ORDER, ["tweet_id", "text", "hateful_value"], block_rows, **more)
