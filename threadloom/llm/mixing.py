"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.lines import sent_if_small
from threadloom.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, PERCENT, EPOCHS, SEED = (3, 1, 2), 150, 2, 13
# Hex digits of the random key that one round decides: at most 4,096 rows for each source.
DIGITS, KEY_DIGITS = 3, 32


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """A document's place in the random order of its source: 32 hex digits from its id, or from its text if that is null."""
    known = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), known))


def weighed_sources(sized: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """source, total (sum of sizes) and weight of every source; ``weights`` repeat over the sources by code point, null last.

    The sources are numbered by one sort over all tasks: each is written with its place in its slice, and the
    sizes of the slices before are added from a table of one row per slice.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("total"))
    placed = totals.orderBy(F.col("source").isNull(), "source")
    placed = materialise(placed.withColumns({"slice": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "mix-sources")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("slice").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    starts = starts.select("slice", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    number = F.col("place") - F.col("least") + F.col("before")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = placed.join(starts, "slice").select("source", "total", F.get(cycle, F.pmod(number, F.lit(len(weights))).cast("int")).alias("weight"))
    return materialise(weighed, "mix-weights")


def _whole(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def filled(weighed: DataFrame, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``weighed`` with ``target``: ``percent`` hundredths of all sizes shared by weight, none above ``epochs`` times its source's total.

    Capped water-filling: the level (words for a weight of one) is what the sources at their cap leave, divided
    by the weights of the others. Sources above their cap at that level are clamped, which raises the level, until a
    round clamps no further one. All sums are whole numbers; a round is one sum over the table of sources.
    """
    cap = F.col("total") * epochs
    everything = weighed.agg(F.sum("total"), F.sum("weight")).first()
    words, clamped_words, open_weight, n_clamped = int(everything[0] or 0), 0, int(everything[1] or 0), 0
    over = F.lit(False)
    while open_weight:
        level, unit = percent * words - 100 * clamped_words, 100 * open_weight
        over = F.col("weight") * _whole(level) > cap * _whole(unit)
        found = weighed.agg(
            F.sum(F.when(over, cap)).alias("words"), F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count(F.when(over, 1)).alias("n")
        ).first()
        if found.n == n_clamped:
            break
        clamped_words, open_weight, n_clamped = int(found.words or 0), int(found.weight or 0), found.n
    if not open_weight:  # even all epochs of all sources are too few
        return weighed.withColumn("target", cap.cast("double"))
    share = (F.col("weight") * _whole(level)).cast("double") / F.lit(float(unit))
    return weighed.withColumn("target", F.when(over, cap.cast("double")).otherwise(share))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def plan_mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: total, target, ``whole`` repetitions of every document, and which take one more.

    ``sized`` has source, size and key. The documents of a source are taken once more in the order of their keys,
    up to the key at which their words come nearest to what is left of the target (``last_key``, itself
    included if ``with_last``). That key is found digit by digit: words are added up by source and the next
    ``DIGITS`` digits, and only the documents under the digits at which the rest runs out are looked at again.
    So no task holds or sorts a source, and there are as many rounds as it takes to tell the keys apart.
    """
    targets = filled(weighed_sources(sized, weights), percent, epochs)
    whole = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = materialise(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("total")), "mix-targets")

    found = targets.select("source", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    decided = None
    for depth in range(DIGITS, KEY_DIGITS + DIGITS, DIGITS):
        near = sent_if_small(found.withColumnsRenamed({"source": "of"}))
        # The prefix is part of the key: beyond the first round most rows of a large source stay out of the sum.
        rows = sized.join(near, F.col("source").eqNullSafe(F.col("of")) & (F.substring("key", 1, depth - DIGITS) == F.col("prefix")))
        sums = rows.groupBy("source", F.substring("key", 1, depth).alias("digits")).agg(
            F.sum("size").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.min("rest").alias("rest"), F.min("before").alias("before")
        )
        until = F.sum("n").over(Window.partitionBy("source").orderBy("digits"))
        crossing = sums.withColumn("until", F.col("before") + until).withColumn("before", F.col("until") - F.col("n"))
        crossing = crossing.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("until")))
        crossing = materialise(crossing.select("source", "rest", "before", "n", "low", "high", "digits"), "mix-keys")
        told = crossing.where("low = high").select(
            "source", F.col("low").alias("last_key"), (2 * (F.col("rest") - F.col("before")) >= F.col("n")).alias("with_last")
        )
        decided = told if decided is None else decided.unionByName(told)
        found = crossing.where("low < high").select("source", "rest", F.col("digits").alias("prefix"), "before")
        if found.isEmpty():
            break
    left, right = targets, decided.withColumnRenamed("source", "of")
    joined = left.join(right, left["source"].eqNullSafe(right["of"]), "left")
    return materialise(joined.select("source", "total", "target", "whole", "last_key", "with_last"), "mix-plan")


def repeated(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with source_size, target and ``repeats`` of every row."""
    plan = sent_if_small(plan.select(F.struct("*").alias("_plan")))
    more = F.coalesce((F.col("key") < F.col("_plan.last_key")) | ((F.col("key") == F.col("_plan.last_key")) & F.col("_plan.with_last")), F.lit(False))
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("_plan.source")))
    return joined.withColumns(
        {"source_size": F.col("_plan.total"), "target": F.col("_plan.target"), "repeats": F.col("_plan.whole") + more.cast("long")}
    ).drop("_plan")


def sized_rows(docs: DataFrame, *kept: Column, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """``kept``, source, size and key of every document."""
    key = random_key(F.col(doc_id), F.col(text), seed).alias("key")
    return docs.select(*kept, F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), key)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target, ``repeats`` and ``taken`` (repeats times size) of every document.

    Sizes are words. Sources, by code point and null last, have ``weights``, repeating, and share ``percent``
    hundredths of all words; no source takes more than ``epochs`` times its own (:func:`filled`). Every document of a
    source is repeated as often as fits into the target, and a seeded part of them once more, so that the words
    taken are as near to the target as whole documents in that order allow (:func:`plan_mix`).

    Null and empty texts have no words: they are repeated like others and take nothing. A null source is a
    source. Rows with the same id, or with a null id and the same text, have one place in the order and are taken
    alike. An empty table gives no rows; a table without words has targets of 0. Runs with the same seed give
    the same rows however they are dealt. Other columns are not read, whatever their names.
    """
    sized = sized_rows(docs, F.col(doc_id).alias("doc_id"), doc_id=doc_id, text=text, source=source, seed=seed)
    sized = materialise(sized, "mix-sizes")
    out = repeated(sized, plan_mix(sized, weights, percent, epochs)).drop("key")
    return out.withColumn("taken", F.col("size") * F.col("repeats"))


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: every row of ``docs`` as a struct ``row`` as often as :func:`mix` takes it, with ``epoch`` from 1."""
    names = {"doc_id": doc_id, "text": text, "source": source, "seed": seed}
    sized = materialise(sized_rows(docs, **names), "mix-sizes")
    rows = repeated(sized_rows(docs, F.struct("*").alias("row"), **names), plan_mix(sized, weights, percent, epochs))
    return rows.where("repeats > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("epoch"))
