"""Histograms and date densities: counts first, then a small dense grid."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame, value: Column, bins: int, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Counts in equal bins over [lo, hi], the last closed on the right; values outside are dropped.

    Without a range the data's own is used, in a scan of that one column. Empty bins give 0.
    """
    spark = df.sparkSession
    values = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    if lo is None or hi is None:
        ends = values.agg(F.min("v").alias("a"), F.max("v").alias("b")).first()
        if ends.a is None:
            lo, hi = 0.0, 1.0
        else:
            lo, hi = (ends.a, ends.b) if ends.a < ends.b else (ends.a - 0.5, ends.b + 0.5)
    lo, hi = float(lo), float(hi)
    # Multiply before dividing: the other way round puts edge values into another bin.
    place = F.floor(F.lit(float(bins)) * (F.col("v") - lo) / F.lit(hi - lo)) + 1
    counted = (
        values.where((F.col("v") >= lo) & (F.col("v") <= hi))
        .groupBy(F.least(place, F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edge = lambda i: F.lit(lo) + (i * F.lit(hi - lo)) / F.lit(float(bins))
    grid = spark.range(1, bins + 1, numPartitions=1).withColumnRenamed("id", "bin")
    return grid.join(counted, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("from_value"),
        edge(F.col("bin")).alias("to_value"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


GRID_LIMIT = 1_000_000


def bounded_sequence(first: Column, last: Column, step: Column, steps: Column, limit: int = GRID_LIMIT) -> Column:
    """``sequence``, but the query fails, and says why, where it would have more than ``limit`` entries: a wrong date, not a long time."""
    told = F.concat(F.lit(f"more than {limit} steps from "), first.cast("string"), F.lit(" to "), last.cast("string"), F.lit("; state a range with within="))
    return F.when(steps > limit, F.raise_error(told)).otherwise(F.sequence(first, last, step))


def date_density(
    articles: DataFrame,
    key: str = "user",
    bandwidth: float | None = None,
    step_days: int = 1,
    margin_days: int = 0,
    within: tuple[dt.date, dt.date] | None = None,
    limit: int = 36_525,
) -> DataFrame:
    """Gaussian density of publication days per key on a grid of days.

    Rows are first counted per (key, day); each of these meets the grid days of its own key, so the
    work is days x grid per key whatever the number of articles. Bandwidth in days; by default Scott's rule.
    Dates outside of ``within`` (both ends included) are left out. A grid of more than ``limit`` days for a key fails.
    """
    if within is not None:
        articles = articles.where(F.to_date("created_at").between(*within))
    day = F.unix_date(F.to_date("created_at"))
    days = articles.groupBy(key, day.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    # Doubles around a day in the middle of the data's era: sums of squares neither overflow nor cancel.
    off = (F.col("d") - F.lit(18262)).cast("double")
    square = F.sum(F.col("n") * off * off) - F.pow(F.sum(F.col("n") * off), F.lit(2)) / total
    spread = F.sqrt(F.greatest(F.lit(0.0), square) / F.nullif(total - 1, F.lit(0)))
    shape = days.groupBy(key).agg(
        total.alias("total"),
        F.min("d").alias("d0"),
        F.max("d").alias("d1"),
        (F.lit(bandwidth) if bandwidth is not None else spread * F.pow(total, F.lit(-0.2))).alias("h"),
    )
    # A key with a single day has no spread: one day then serves as bandwidth.
    shape = shape.withColumn("h", F.when(F.col("h") > 0, F.col("h")).otherwise(F.lit(1.0)))
    first, last = F.col("d0") - margin_days, F.col("d1") + margin_days
    grid = bounded_sequence(first, last, F.lit(step_days), (last - first) / step_days, limit)
    kernel = F.col("n") * F.exp(-0.5 * F.pow((F.col("g") - F.col("d")) / F.col("h"), F.lit(2)))
    return (
        days.join(shape, key)
        .withColumn("g", F.explode(grid))
        .groupBy(key, "g")
        .agg(F.sum(kernel).alias("k"), F.first("total").alias("total"), F.first("h").alias("h"))
        .select(
            key,
            F.date_from_unix_date("g").alias("day"),
            (F.col("k") / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
        )
    )
