"""Labelled rows for a classifier: a bounded sample, chosen by hash, with whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialise


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, limits: dict[int, int], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``spread``, ``text`` (binary) and ``label`` of at most ``limits[l]`` documents of each label ``l``.

    ``learn`` is a condition on the labels' ids. Of several labels of one document the largest counts; nulls
    don't. The sample is the first by hash of the id, so it doesn't depend on how rows are dealt. Its size
    is bounded by ``limits``, so its ids are sent to all tasks and the texts of other documents stay put.
    """
    known = labels.where(learn & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.withColumn("spread", F.xxhash64("doc_id"))
    parts = [known.where(F.col("label") == value).orderBy("spread", "doc_id").limit(n) for value, n in limits.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    chosen = F.broadcast(materialise(chosen, "sample-ids"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return texts.join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("spread", "text", "label")
