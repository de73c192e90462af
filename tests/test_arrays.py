"""Arrays of JSON records, cut into splits at any byte."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.sources import arrays
from threadloom.sources.readers import BROKEN, broken_records, read_json, read_release
from threadloom import model

ODD = ['a}b{', 'say "{" \\', "\\\\", "}},{", "línea\nnueva", "[]", "", "😀}"]


@pytest.fixture()
def small_splits(spark):
    """Splits of ``n`` bytes: no record fits into one."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]

    def cut(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield cut
    for k in keys:
        spark.conf.unset(k)


def records(n):
    return [{"tweet_id": i, "text": ODD[i % len(ODD)], "comments": [{"tweet_id": j, "text": ODD[j % 8]} for j in range(i % 4)]} for i in range(n)]


def texts(spark, path):
    return [r.record for r in arrays.array_records(spark, str(path)).collect()]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [61, 1000, 10**7])
def test_records_over_splits(spark, tmp_path, small_splits, indent, size):
    small_splits(size)
    made = {f"f{k}.json": records(n) for k, n in enumerate([25, 0, 3])}
    for name, rows in made.items():
        (tmp_path / name).write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
    assert size > 61 or arrays.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    got = sorted(texts(spark, tmp_path))
    assert [json.loads(g) for g in got] and sorted(map(repr, map(json.loads, got))) == sorted(repr(r) for rows in made.values() for r in rows)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.dictionaries(st.text('{}"\\ax', max_size=3), st.text('{}[],"\\\n: x', max_size=12), max_size=3), max_size=12), size=st.integers(3, 40))
def test_any_texts(spark, tmp_path_factory, small_splits, rows, size):
    small_splits(size)
    path = tmp_path_factory.mktemp("any") / "a.json"
    path.write_text(json.dumps(rows), encoding="utf-8")
    assert sorted(repr(json.loads(t)) for t in texts(spark, path)) == sorted(map(repr, rows))


def test_release_of_many_splits(spark, tmp_path, small_splits):
    rows = [r | {"created_at": {"$date": "2020-03-01T10:00:00Z"}} for r in records(30)]
    (tmp_path / "r.json").write_text(json.dumps(rows, indent=4, ensure_ascii=False), encoding="utf-8")
    small_splits(300)
    got = {r.tweet_id: r for r in read_release(spark, str(tmp_path), array=True).collect()}
    assert len(got) == 30 and all(got[r["tweet_id"]].text == r["text"] and len(got[r["tweet_id"]].comments) == len(r["comments"]) for r in rows)
    assert all(r.created_at.year == 2020 for r in got.values())


def test_broken_parts_keep_their_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"tweet_id": 1}, 7, {"tweet_id": 2}, {"tweet_id": x}, {"tweet_id": 3}]')
    (tmp_path / "open.json").write_text('[{"tweet_id": 4}, {"tweet_id": 5, "comments": [{"tweet_id": 6}], {"tweet_id": 8}]')
    assert sorted(r.tweet_id for r in read_release(spark, str(tmp_path), array=True).collect()) == [1, 3]
    broken = broken_records(spark, str(tmp_path), model.RELEASE_FILE, array=True).collect()
    assert any("7" in r[BROKEN] for r in broken) and any("x" in r[BROKEN] for r in broken)
    assert sum("tweet_id" in r[BROKEN] for r in broken) == 5


@pytest.mark.parametrize("text", ["", "[]", "[\n]\n", " "])
def test_nothing_in_it(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert texts(spark, tmp_path) == []


def test_a_single_object_and_a_mark_in_front(spark, tmp_path):
    (tmp_path / "a.json").write_text('﻿{"tweet_id": 1}', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"tweet_id": 2}\n', encoding="utf-8")
    assert sorted(r.tweet_id for r in read_json(spark, str(tmp_path), model.RELEASE_FILE, True).where(F.col("tweet_id").isNotNull()).collect()) == [1, 2]
