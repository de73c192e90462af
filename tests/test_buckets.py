"""Tables in buckets of keys."""

import os

import pytest
from pyspark.sql import functions as F

from threadloom.sources.buckets import BUCKET, BucketStore

ROWS = "id long, v string"


def store_of(spark, path, n=200, buckets=8):
    rows = spark.range(n).select("id", F.lit("old").alias("v"))
    store = BucketStore(spark, str(path / "t"), rows.schema, "id", buckets)
    store.create(rows)
    return store


def files(store):
    return {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(store.path) for f in names if f.startswith("part-")}


def folders(store):
    return {d.rsplit("=", 1)[1]: {f for f in names if f.startswith("part-")} for d, _, names in os.walk(store.path) if "bucket=" in d}


def test_insert_adds_first_copies_of_new_keys(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), spark.createDataFrame([], ROWS).schema, "id", 4)
    assert store.read().count() == 0
    new = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (2, None), (2, None)], ROWS)
    for _ in range(2):
        store.insert(new, [F.col("v")])
    store.insert(spark.createDataFrame([(2, "late"), (3, "c")], ROWS), [F.col("v")])
    assert sorted(map(tuple, store.read().select("id", "v").collect())) == [(1, "a"), (2, None), (3, "c")]
    store.insert(new.limit(0), [F.col("v")])
    assert store.read().count() == 3


def test_a_batch_meets_the_buckets_of_its_ids_only(spark, tmp_path):
    """One old id among new ones: its bucket is read, nothing between."""
    store = store_of(spark, tmp_path, n=1000, buckets=64)
    batch = spark.createDataFrame([(3, "again"), (5_000, "new")], ROWS)
    met = store.near(batch)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and len(store.touched(batch)) == 2
    assert {str(r[0]) for r in met.select(BUCKET).distinct().collect()} <= {str(b) for b in store.touched(batch)}
    assert met.count() < 100 and met.where("id = 3").count() == 1


def test_update_rewrites_touched_buckets_only(spark, tmp_path):
    store = store_of(spark, tmp_path)
    before, held = files(store), folders(store)
    changes = spark.createDataFrame([(7, "new"), (11, None), (9_999, "nobody")], ROWS)
    store.update(changes, ["v"])
    due = {str(b) for b in store.touched(spark.createDataFrame([(7,), (11,)], "id long"))}
    after = folders(store)
    assert {b for b in held if held[b] != after[b]} == due and len(due) < 8
    kept = files(store)
    assert all(kept[f] == before[f] for b in held if b not in due for f in held[b])
    got = {r.id: r.v for r in store.read().collect()}
    assert len(got) == 200 and got[7] == "new" and got[11] is None and got[12] == "old"
    store.update(changes.where("id = 9999"), ["v"])
    assert folders(store) == after


def test_merging_files_keeps_the_rows(spark, tmp_path):
    store = store_of(spark, tmp_path, n=20, buckets=2)
    for i in range(4):
        store.insert(spark.createDataFrame([(100 + 10 * i + k, str(i)) for k in range(6)], ROWS), [F.col("v")])
    rows = sorted(map(tuple, store.read().select("id", "v").collect()))
    assert store.compact(files=2) == [0, 1] and store.compact(files=2) == []
    assert all(len(f) == 1 for f in folders(store).values())
    assert sorted(map(tuple, store.read().select("id", "v").collect())) == rows


@pytest.mark.parametrize("kind", ["string", "decimal(20,0)"])
def test_other_keys(spark, tmp_path, kind):
    rows = spark.range(30).select(F.col("id").cast(kind).alias("id"), F.lit("x").alias("v"))
    store = BucketStore(spark, str(tmp_path / "t"), rows.schema, "id", 4)
    store.insert(rows, [F.col("v")])
    store.insert(rows, [F.col("v")])
    assert store.read().count() == 30
