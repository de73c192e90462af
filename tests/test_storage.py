"""Readers and writers on hand-made files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from threadloom import model
from threadloom.plans import audit
from threadloom.plans.release import cut_release
from threadloom.session import work_root
from threadloom.sources import readers, writers

RELEASE = [
    {
        "tweet_id": 1, "text": "t", "slug": "s", "title": "T", "url": "u", "user": "LANACION", "body": "b",
        "created_at": {"$date": "2020-03-01T10:20:30Z"}, "comments": [{"tweet_id": 5, "text": "c"}, {"tweet_id": 6, "text": "d", "hateful_value": 0.7}],
        "unknown": {"x": 1},
    },
    {"tweet_id": 2, "user": "infobae", "created_at": {"$date": "2020-03-02T00:00:00Z"}, "comments": []},
]


def test_pretty_array(spark, tmp_path):
    path = tmp_path / "release.json"
    path.write_text(json.dumps(RELEASE, indent=2), encoding="utf-8")
    got = readers.read_release(spark, str(path), array=True).orderBy("tweet_id").collect()
    assert [r.tweet_id for r in got] == [1, 2]
    assert got[0].created_at == dt.datetime(2020, 3, 1, 10, 20, 30)
    assert [c.hateful_value for c in got[0].comments] == [None, 0.7] and got[1].comments == []


def test_broken_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "lines.json"
    lines = [json.dumps(RELEASE[0]), '{"tweet_id": 3, "user": ', '{"user": "no key"}', json.dumps(RELEASE[1])]
    path.write_text("\n".join(lines), encoding="utf-8")
    release = readers.read_release(spark, str(path))
    assert sorted(r.tweet_id for r in release.collect()) == [1, 2] and release.count() == 2
    broken = readers.broken_records(spark, str(path), model.RELEASE_FILE)
    assert sorted(str(r[readers.BROKEN])[:14] for r in broken.collect()) == ["None", '{"tweet_id": 3'] and broken.count() == 2


def test_schema_check(spark):
    assert model.missing_fields(model.RELEASE_FILE, model.RELEASE_FILE) == []
    df = spark.createDataFrame([(1, [("a",)])], "tweet_id int, comments array<struct<text:string>>")
    lacking = dict(model.missing_fields(df.schema, model.RELEASE_FILE))
    assert lacking["tweet_id"] == "bigint" and lacking["comments[].tweet_id"] == "bigint" and "comments[].text" not in lacking
    assert ("comments[].text", "string") in model.schema_paths(df.schema)


def test_id_csv(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_bytes("ID_OT,nota\n12,año\nx,ñ\n12,\n7,é\n".encode("latin-1"))
    ids = readers.read_id_csv(spark, str(path))
    assert sorted((r.tweet_id for r in ids.collect()), key=str) == [12, 12, 7, None]
    release = spark.createDataFrame([(12,), (99,)], "tweet_id long")
    assert tuple(audit.membership(ids, release).first()) == (3, 2, 1)
    assert tuple(audit.membership(ids.limit(0), release).first()) == (0, 0, 0)


def articles_and_comments(spark):
    articles = spark.createDataFrame(
        [(i, "t", "s", f"title {i}", "u", "A", "b", dt.datetime(2020, 1, i)) for i in (1, 2, 3)],
        "tweet_id long, text string, slug string, title string, url string, user string, body string, created_at timestamp_ntz",
    )
    comments = spark.range(100).select(
        F.when(F.col("id") < 95, 1).otherwise(2).cast("long").alias("article_id"),
        F.col("id").alias("tweet_id"),
        F.lit("c").alias("text"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("created_at"),
        F.lit(0.5).alias("hateful_value"),
    )
    return articles, comments


@pytest.mark.parametrize("part_rows", [10, 1000])
def test_release_roundtrip(spark, tmp_path, part_rows):
    articles, comments = articles_and_comments(spark)
    release = cut_release(articles, comments, block_rows=part_rows)
    writers.write_release(release, str(tmp_path / "out"))
    back = readers.read_release(spark, str(tmp_path / "out"))
    assert model.missing_fields(back.schema, release.schema) == []
    sizes = {r.tweet_id: r.n for r in back.groupBy("tweet_id").agg(F.sum(F.size("comments")).alias("n")).collect()}
    assert sizes == {1: 95, 2: 5, 3: 0}
    whole, flat = readers.release_tables(back)
    assert whole.count() == 3 and flat.count() == 100
    assert flat.where(f"article_id = 1 and place >= {part_rows}").isEmpty()
    line = json.loads(next(x for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines()))
    assert set(line) == set(model.RELEASE_FIELDS) | {"part"} and "$date" in line["created_at"]


def test_selection_equals_filter(spark):
    articles, comments = articles_and_comments(spark)
    spec = readers.QuerySpec(min_date="2020-01-02T00:00:00Z", search_terms=["title"])
    got = {r.tweet_id: len(r.comments) for r in cut_release(articles, comments, spec).collect()}
    assert got == {2: 5, 3: 0}


def test_inserting_twice_changes_nothing(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "id long, v string"
    new = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (None, "n")], schema)
    empty = spark.createDataFrame([], schema)
    writers.write_batch(writers.absent_rows(new, empty, "id", [F.col("v")]), table, 0)
    once = sorted(tuple(r) for r in spark.read.parquet(table).select("id", "v").collect())
    assert once == [(1, "a"), (2, "x")]
    stored = spark.read.parquet(table)
    writers.write_batch(writers.absent_rows(new, writers.narrowed(stored, new, "id"), "id", [F.col("v")]), table, 1)
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("id", "v").collect()) == once


def test_narrowing_is_pushed_to_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "s"))
    new = spark.createDataFrame([(10,), (20,)], "id long")
    store = writers.narrowed(spark.read.parquet(str(tmp_path / "s")), new, "id")
    plan = store._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThanOrEqual(id,20)" in plan
    assert writers.narrowed(store, new.limit(0), "id").count() == 0


def test_errors_without_code_are_not_saved(spark):
    new = spark.createDataFrame([("m", None, 1), ("m", 34, 2), ("n", 34, 2), ("m", 1, 3)], model.API_ERROR)
    stored = spark.createDataFrame([("m", 1, 3)], model.API_ERROR)
    assert [tuple(r) for r in writers.absent_errors(new, stored).collect()] == [("m", 34, 2)]


def test_update_can_set_null(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, w int")
    changes = spark.createDataFrame([(1, None), (9, "z")], "id long, v string")
    got = sorted(tuple(r) for r in writers.updated(df, changes, "id", ["v"]).collect())
    assert got == [(1, None, 1), (2, "b", 2)]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snap")
    first = writers.write_snapshot(spark.range(3), path, 1)
    second = writers.write_snapshot(first.where("id > 0"), path, 2)
    assert (first.count(), second.count()) == (3, 2)


def test_work_root(spark):
    root = work_root(spark)
    assert root == work_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert root == named.rstrip("/") if named else root == spark.sparkContext.getCheckpointDir()


def test_work_root_of_a_cluster_has_to_be_named():
    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(Bare)
