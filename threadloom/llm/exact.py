"""Exact duplicates: one 128-bit hash per text, groups checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialise

SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without the six ASCII white-space characters; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", content_hash: Callable[[Column], Column] = hash128
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their normalised texts are the same bytes. The row with the most code points in
    the original text stays, then the one with the smallest id. The hash only proposes groups: inside a
    hash that several rows share the texts themselves are compared, and a hash that stands for several
    texts is replaced by the text. Copies are folded in every map task, so the copies of one text never
    meet in one task; the table of groups holds groups of two rows and more only, and the rows that look
    it up are on the side that adaptive execution splits.

    Null text: empty. Empty texts: one group. Ties: the smallest id; a null id comes after all others.
    A row that is there twice, id included, counts twice, and both copies say ``kept``. An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    keyed = keyed.select("doc_id", F.char_length("_text").alias("_n"), normalised(F.col("_text")).alias("_norm"))
    keyed = keyed.withColumn("_hash", content_hash(F.col("_norm")))
    light = keyed.select("doc_id", "_n", F.sha2(F.encode("_norm", "UTF-8"), 256).alias("text_sha256"), "_hash")

    shared = materialise(light.groupBy("_hash").count().where("count > 1").select("_hash"), "shared-hashes")
    texts = keyed.join(shared, "_hash", "left_semi").groupBy("_hash", "_norm").count()
    clashing = materialise(
        texts.groupBy("_hash").agg(F.count("*").alias("_texts")).where("_texts > 1").select("_hash", F.lit(True).alias("_clash")),
        "clashing-hashes",
    )
    if not clashing.isEmpty():
        keyed = keyed.join(clashing, "_hash", "left")
        own = F.when(F.col("_clash"), F.concat(F.lit(b"\x01"), F.encode("_norm", "UTF-8")))
        light = keyed.select(
            "doc_id", "_n", F.sha2(F.encode("_norm", "UTF-8"), 256).alias("text_sha256"),
            F.coalesce(own, F.concat(F.lit(b"\x00"), F.col("_hash"))).alias("_hash"),
        )
    best = F.struct(F.col("_n").alias("n"), F.col("doc_id").isNotNull().alias("known"), F.bitwise_not(F.col("doc_id")).alias("id"))
    groups = light.groupBy("_hash").agg(F.count("*").alias("_size"), F.max(best).alias("_best")).where("_size > 1")
    groups = materialise(groups.select("_hash", "_size", F.bitwise_not(F.col("_best.id")).alias("_keep"), F.col("_best.n").alias("_most")), "copies")
    found = light.join(groups, "_hash", "left")
    alone = F.col("_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_n") == F.col("_most")))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ids must be unique here."""
    gone = exact_groups(docs, doc_id, text).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti")
