"""Per-parent work that stays bounded when one parent holds a third of all rows."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

BLOCK_ROWS = 50_000
HOT_ROWS = 5_000_000


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The limit on the rank lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a key with a flood of copies sends one row per task, not all of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def newest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key with their rank; bounded before the shuffle like :func:`first_wins`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def nest_in_parts(
    parents: DataFrame,
    key: str,
    children: DataFrame,
    parent: str,
    element: Column,
    order: Sequence[str],
    into: str = "comments",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every parent row with its children as arrays of ``block_rows``, one row per array.

    The children of a parent are numbered exactly by ``order``, plain columns of ``children``; numbers 1 to
    ``block_rows`` are ``part`` 0, the next as many part 1, and so on, each array in that order. All parts
    but a parent's last are full, so a child's number is ``part * block_rows`` plus its place. A parent
    without children has an empty part 0. The shape is the same at every size, and no row or task gathers
    more than a block. ``parents`` must be unique by ``key``; children without a parent are left out.
    """
    numbered = number_within(children.where(F.col(parent).isNotNull()), [parent], order, "_number", hot_rows)
    placed = numbered.select(
        F.col(parent).alias("_owner"),
        F.floor((F.col("_number") - 1) / block_rows).cast("long").alias("_part"),
        F.struct("_number", element.alias("item")).alias("_item"),
    )
    packed = placed.groupBy("_owner", "_part").agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    # Lists look small next to the compressed files they come from; merging never has to hold them all.
    joined = parents.join(packed.hint("merge"), F.col(key) == F.col("_owner"), "left")
    joined = joined.withColumns({into: F.coalesce(F.col("_items.item"), F.array()), "part": F.coalesce("_part", F.lit(0).cast("long"))})
    return joined.drop("_owner", "_part", "_items")


def block_totals(nested: DataFrame, key: str, **totals: Column) -> DataFrame:
    """One row per ``key`` of nested rows: ``totals`` over all its blocks. Blocks are added up, none is picked."""
    return nested.groupBy(key).agg(*[c.alias(n) for n, c in totals.items()])


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    into: str = "position",
    hot_rows: int = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """1-based position of each row within its group, by a total order of plain columns.

    A null key is a group like any other. Groups up to ``hot_rows`` take a window. The rows of larger ones are sorted by (group, order)
    across all tasks, written with their place in their slice, and the places before each slice are
    added up from a table of one row per (slice, group): exact, and no task sees a whole hot group.
    ``sizes``, a row per group with its ``_n``, saves counting where they are known.
    """
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialise(sizes.where(F.col("_n") > hot_rows).select(*keys), "hot-groups")
    window = Window.partitionBy(*keys).orderBy(*order)
    if hot.isEmpty():
        return df.withColumn(into, F.row_number().over(window).cast("long"))
    same = functools.reduce(lambda x, y: x & y, [df[k].eqNullSafe(hot[k]) for k in keys])
    cold = df.join(hot, same, "left_anti").withColumn(into, F.row_number().over(window).cast("long"))
    spread = df.join(hot, same, "left_semi").orderBy(*keys, *order)
    spread = materialise(
        spread.withColumns({"_slice": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "hot-rows",
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy("_slice", *keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    starts = starts.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)}).withColumnRenamed("_slice", "_of")
    mine = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    numbered = (
        spread.join(starts, (F.col("_slice") == F.col("_of")) & mine)
        .withColumn(into, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .drop("_slice", "_place", "_first", "_before")
    )
    return cold.unionByName(numbered.select(*cold.columns))
