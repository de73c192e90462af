"""Hot parents: split, numbered and counted without gathering them in one task."""

import pytest
from pyspark.sql import functions as F

from threadloom.operators.aggregates import reply_counts
from threadloom.operators.groups import first_wins, nest_in_parts, newest_per, number_within


@pytest.fixture(scope="module")
def replies(spark):
    """30,000 replies, two thirds of them to parent 1, many at the same moment."""
    df = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 500 + 2).alias("parent"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id % 7 as int))").alias("created_at"),
    )
    return df.repartition(8).cache()


@pytest.mark.parametrize("part_rows", [100, 1000, 50_000])
def test_parts_hold_every_child_once(spark, replies, part_rows):
    parents = spark.range(1, 510).withColumnRenamed("id", "pid")
    nested = nest_in_parts(parents, "pid", replies, "parent", F.struct("created_at", "id"), ["created_at", "id"], "kids", part_rows).cache()
    assert nested.select(F.sum(F.size("kids"))).first()[0] == 30_000
    assert nested.where("part = 0").count() == 509
    assert nested.groupBy("pid", "part").count().where("count > 1").isEmpty()
    flat = nested.select("pid", F.explode("kids.id").alias("id"))
    assert flat.exceptAll(replies.select("parent", "id")).isEmpty()
    parts = nested.where("pid = 1").count()
    assert parts == -(-20_000 // part_rows)
    if part_rows < 20_000:
        assert nested.where("pid = 1").agg(F.max(F.size("kids"))).first()[0] == part_rows
    assert nested.where("kids <> array_sort(kids)").isEmpty()
    assert nested.where("pid = 509").first().kids == []


def test_blocks_follow_each_other(spark, replies):
    parents = spark.range(1, 510).withColumnRenamed("id", "pid")
    for hot_rows in (1000, 10**9):
        nested = nest_in_parts(parents, "pid", replies, "parent", F.struct("created_at", "id"), ["created_at", "id"], "kids", 700, hot_rows)
        rows = nested.where("pid = 1").orderBy("part").collect()
        kids = [tuple(k) for r in rows for k in r.kids]
        assert kids == sorted(kids) and [len(r.kids) for r in rows[:-1]] == [700] * (len(rows) - 1)


def test_null_groups_are_split_too(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).alias("parent"))
    numbered = number_within(df, ["parent"], ["id"], hot_rows=10)
    got = {(r.parent, r.n, r.last) for r in numbered.groupBy("parent").agg(F.count("*").alias("n"), F.max("position").alias("last")).collect()}
    assert got == {(1, 1000, 1000), (None, 2000, 2000)}
    assert numbered.groupBy("parent", "position").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("hot_rows", [50, 5000, 10**9])
def test_numbers_are_exact(replies, hot_rows):
    numbered = number_within(replies, ["parent"], ["created_at", "id"], hot_rows=hot_rows)
    plain = number_within(replies, ["parent"], ["created_at", "id"], hot_rows=10**9)
    assert numbered.select("parent", "id", "position").exceptAll(plain.select("parent", "id", "position")).isEmpty()
    assert numbered.count() == 30_000


def test_counts(replies):
    assert {r.parent_id: r.n_replies for r in reply_counts(replies, "parent").collect()}[1] == 20_000


def test_counts_leave_out_no_parent(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 5), (4, 5)], "id long, parent long")
    assert [tuple(r) for r in reply_counts(df, "parent").collect()] == [(5, 2)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_copy_is_chosen_before_the_shuffle(replies):
    df = first_wins(replies, ["parent"], [F.col("created_at"), F.col("id")])
    plan = plan_of(df)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert df.where("parent = 1").first().id == 0


def test_newest(replies):
    df = newest_per(replies, ["parent"], [F.desc("created_at"), F.col("id")], 3)
    assert df.where("parent = 1").orderBy("rank").select("rank", "id").collect() == [(1, 6), (2, 13), (3, 27)]
    assert "WindowGroupLimit" in plan_of(df)
