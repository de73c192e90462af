"""Nested blocks kept over batches equal the blocks of all replies at once."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.groups import nest_in_parts
from threadloom.plans import kept_blocks as B
from threadloom.plans.kept_blocks import KeptBlocks

REPLIES = "parent long, at int, id long, text string"


def table(spark, folder, **more):
    return KeptBlocks(spark, str(folder), spark.createDataFrame([], REPLIES).schema, "parent", ["at", "id"], ["id", "text"], 4, buckets=4, **more)


def parents(spark):
    return spark.createDataFrame([(p,) for p in range(6)], "key long")


def whole(spark, rows):
    replies = spark.createDataFrame(rows, REPLIES).withColumn("_id", F.col("id"))
    nested = nest_in_parts(parents(spark), "key", replies, "parent", F.struct(F.col("_id").alias("id"), "text"), ["at", "_id"], "items", 4)
    return tell(nested, "items")


def tell(rows, into):
    return sorted((r.key, r.part, [i.id for i in r[into]]) for r in rows.collect())


def got(kept, spark):
    return tell(kept.nested(parents(spark), "key", "kept"), "kept")


# Parent 1 has most replies, 2 exactly two blocks, 3 ties and an unknown time, 4 none; None is no parent.
ROWS = [(1, i, 100 + i, "a") for i in range(23)] + [(2, i, 200 + i, "b") for i in range(8)] + [(3, 5, 301, None), (3, 5, 300, ""), (3, None, 302, "c"), (None, 1, 400, "d")]


@pytest.mark.parametrize("hot_rows", [1000, 6])
def test_three_batches_in_any_order(spark, tmp_path, hot_rows):
    rows = ROWS[:]
    random.Random(hot_rows).shuffle(rows)
    kept = table(spark, tmp_path / "t", hot_rows=hot_rows)
    for number, part in enumerate([rows[:15], rows[15:20], rows[20:]]):
        kept.add(spark.createDataFrame(part, REPLIES), number)
    assert got(kept, spark) == whole(spark, rows)
    kept.add(spark.createDataFrame(rows[20:], REPLIES), 2)
    assert got(kept, spark) == whole(spark, rows)


def test_replies_in_order_fill_the_last_block_only(spark, tmp_path):
    kept = table(spark, tmp_path / "t")
    kept.add(spark.createDataFrame(ROWS, REPLIES), 0)
    later = [(1, 50, 150, "x"), (1, 51, 151, "y"), (2, 50, 250, "z")]
    kept.add(spark.createDataFrame(later, REPLIES), 1)
    written = sorted((r.owner, r.part, r.size) for r in kept._stored(9).where("batch = 1").collect())
    assert written == [(1, 5, 4), (1, 6, 1), (2, 2, 1)]
    # One that comes late changes the blocks from its place on, of its parent alone.
    late = [(1, 17, 99, "l")]
    kept.add(spark.createDataFrame(late, REPLIES), 2)
    assert sorted((r.owner, r.part) for r in kept._stored(9).where("batch = 2").collect()) == [(1, 4), (1, 5), (1, 6)]
    assert got(kept, spark) == whole(spark, ROWS + later + late)


def test_nothing(spark, tmp_path):
    kept = table(spark, tmp_path / "t")
    kept.add(spark.createDataFrame([], REPLIES), 0)
    assert got(kept, spark) == [(p, 0, []) for p in range(6)]


def test_replies_are_dealt_once_and_held_once(spark, tmp_path, monkeypatch):
    """A batch deals its replies once, by parent, and writes them from there; a column that orders and is given out stands once in a block."""
    frames = []
    write = B.write_batch
    monkeypatch.setattr(B, "write_batch", lambda df, *more: (frames.append(df), write(df, *more))[1])
    kept = KeptBlocks(spark, str(tmp_path / "t"), spark.createDataFrame([], REPLIES).schema, "parent", ["at", "id", "text"], ["id", "text"], 4, buckets=4)
    kept.add(spark.createDataFrame(ROWS, REPLIES), 0)
    kept.add(spark.createDataFrame([(1, 50, 150, "x"), (2, 3, 250, "z")], REPLIES), 1)
    assert kept.block["items"].dataType.elementType.fieldNames() == ["at", "id", "text"]
    assert kept.block["last"].dataType.fieldNames() == ["at", "id"]
    assert not any("REPARTITION" in f._jdf.queryExecution().executedPlan().toString() for f in frames)
    numbered = [r for r in got(kept, spark) if r[0] == 2]
    assert numbered == [(2, 0, [200, 201, 202, 203]), (2, 1, [250, 204, 205, 206]), (2, 2, [207])]


def test_equal_ends_and_unknown_times(spark, tmp_path):
    """Replies equal up to the first text, over several batches and blocks."""
    rows = [(1, t, 7, x) for t in (5, None) for x in "fbdacehg"] + [(1, 5, 7, "b"), (1, 5, 7, None)]
    kept = KeptBlocks(spark, str(tmp_path / "t"), spark.createDataFrame([], REPLIES).schema, "parent", ["at", "id", "text"], ["text"], 4, buckets=4)
    for number in range(3):
        kept.add(spark.createDataFrame(rows[number::3], REPLIES), number)
    texts = [x.text for r in sorted(kept.read().collect(), key=lambda r: r.part) for x in r["items"]]
    assert texts == list("abcdefgh") + [None] + list("abbcdefgh")
