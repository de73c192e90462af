"""Null rules and the worker's truth table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadloom.operators import filters as P
from threadloom.sources.readers import QuerySpec


@pytest.mark.parametrize(
    "only_replies, parent, kept", [(False, None, True), (False, 123, True), (True, None, False), (True, 123, True), (True, 0, False)]
)
def test_worker(spark, only_replies, parent, kept):
    df = spark.createDataFrame([(1, parent)], "id long, in_reply_to_status_id long")
    assert (df.where(P.kept_by_worker(only_replies)).count() == 1) is kept


def test_roots(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, 0, None), (3, 1, None), (4, None, "x")], "id long, in_reply_to_status_id long, retweeted_status string"
    )
    assert [r.id for r in df.where(P.is_root()).orderBy("id").collect()] == [1, 2]
    assert [r.id for r in df.where(P.parent_of().isNotNull()).collect()] == [3]


def test_flags_need_a_stored_value(spark):
    df = spark.createDataFrame([(1, False, False), (2, None, False), (3, True, False)], "id int, checked boolean, interesting boolean")
    assert [r.id for r in df.where(P.unlabelled()).collect()] == [1]
    assert [r.id for r in df.where(P.flag_is("checked", True)).collect()] == [3]


def test_arrays(spark):
    df = spark.createDataFrame([(1, []), (2, [1]), (3, None)], "id int, xs array<int>")
    assert [r.id for r in df.where(P.has_none("xs")).collect()] == [1]
    assert [r.id for r in df.where(P.has_more_than("xs", 0)).collect()] == [2]
    assert [r.id for r in df.where(P.absent("xs")).collect()] == [3]


def test_unscored(spark):
    df = spark.createDataFrame(
        [(1, [(None,), (None,)]), (2, [(0.1,), (None,)]), (3, []), (4, None)], "id int, comments array<struct<hateful_value:double>>"
    )
    assert [r.id for r in df.where(P.unscored()).orderBy("id").collect()] == [1, 3, 4]


def test_newspapers(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "user string")
    names = lambda c: [r.user for r in df.where(c).orderBy("user").collect()]
    assert names(P.newspapers()) == ["a", "b", "c"]
    assert names(P.newspapers(["a", "b"], ["b"])) == ["a"]
    assert names(P.newspapers(barred=["b"])) == ["a", "c"]


def test_null_keys_do_no_harm(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    keys = spark.createDataFrame([(1,), (None,)], "k long")
    assert sorted((r.id for r in P.without_keys(df, keys, "id", "k").collect()), key=str) == [2, None]
    assert [r.id for r in P.only_keys(df, keys, "id", "k").collect()] == [1]


ARTICLES = [
    (1, "A", "Covid en la ciudad", "", "cuerpo", dt.datetime(2020, 2, 10)),
    (2, "A", "", "", "la fase 19", dt.datetime(2020, 2, 9, 23, 59, 59)),
    (3, "a", "covid", "", "", dt.datetime(2021, 1, 1)),
    (4, "B", "", "post covid", None, dt.datetime(2021, 1, 1)),
]


@pytest.mark.parametrize(
    "spec, ids",
    [
        ({}, [1, 2, 3, 4]),
        ({"users": ["A", "B"]}, [1, 2, 4]),
        ({"min_date": "2020-02-10T00:00:00Z"}, [1, 3, 4]),
        ({"search_terms": ["covid-19", "x "]}, [1, 2, 3, 4]),
        ({"search_terms": ["covid "]}, [1, 3, 4]),
        ({"search_terms": ["-covid"]}, []),
        ({"search_terms": []}, []),
        ({"users": []}, []),
        ({"users": ["A"], "min_date": "2020-02-10T00:00:00Z", "search_terms": ["COVID", "fase"]}, [1]),
    ],
)
def test_query_spec(spark, spec, ids):
    df = spark.createDataFrame(ARTICLES, "tweet_id long, user string, title string, text string, body string, created_at timestamp_ntz")
    assert [r.tweet_id for r in df.where(QuerySpec.of(spec).predicate()).orderBy("tweet_id").collect()] == ids


def test_spec_file(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text('{"users": ["A"], "search_terms": ["síntomas", "aislamiento "]}', encoding="utf-8")
    assert QuerySpec.load(str(path)) == QuerySpec(["A"], None, ["síntomas", "aislamiento "])


def test_mean_limit(spark):
    df = spark.createDataFrame([(0.3,), (0.35,)], "mean_value double")
    assert df.where(P.mean_at_least(0.3, strict=True)).count() == 1
    assert df.where(P.mean_at_least(0.35)).count() == 1
    assert df.where(F.lit(True)).count() == 2
