"""The search table against the search on the texts themselves."""

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as TX
from threadloom.plans import search_index as S

TEXTS = [
    (1, "Síntomas de covid-19 en casa"),
    (2, "sin sintomas; la casa, la CASA"),
    (3, "a b a b a c"),
    (4, "b a c a b"),
    (5, ""),
    (6, None),
    (7, " ... "),
    (8, "de la casa en la que"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string").repartition(3)


@pytest.fixture(scope="module")
def index(texts, tmp_path_factory):
    return S.build_index(texts, "id", "text", str(tmp_path_factory.mktemp("search")), buckets=8, shards=2)


SEARCHES = ["sintomas", "casa -que", '"la casa"', '"a b a" -"b a c"', '"a b" "a c"', "-casa", '-"la casa"', "nowhere", '"casa la casa"', "19 que", '"a a"', "covid-19"]


@pytest.mark.parametrize("search", SEARCHES)
def test_same_as_the_texts(search, texts, index):
    wanted = {r.id for r in texts.where(TX.matches("text", search)).collect()}
    got = [r.doc_id for r in index.search(search).collect()]
    assert sorted(got) == sorted(wanted)


def test_several_searches_and_a_set_of_ids(texts, index):
    some = texts.where("id < 5").select(F.col("id").alias("doc_id"))
    got = [r.doc_id for r in index.search('"la casa"', "covid", "-a", within=some).collect()]
    assert sorted(got) == [1, 2]
    assert index.search("-a", "").count() == 0


def test_places(texts):
    got = {(r.doc_id, r.term): r.places for r in S.word_postings(S.placed_words(texts, "id", "text")).collect()}
    assert got[(3, "a")] == [0, 2, 4] and got[(2, "casa")] == [3, 5] and got[(1, "sintomas")] == [0]
    assert {i for i, _ in got} == {1, 2, 3, 4, 8}


def test_every_id_is_kept(index):
    assert sorted(r.doc_id for r in index.ids().collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_counts_and_yield(spark, texts, index):
    from threadloom.operators import aggregates as A

    terms = ["casa", "covid-19", "zzz", "a", "sintomas", ""]
    assert sorted(index.term_counts(terms).collect()) == sorted(A.term_counts(texts, "text", terms).collect())
    mine, plain = index.term_yield(terms, over=1), A.term_yield(texts, "text", terms, over=1)
    assert sorted(mine.select(sorted(mine.columns)).collect()) == sorted(plain.select(sorted(plain.columns)).collect())


def test_only_the_words_buckets_are_read(index):
    """The scan is pruned to the buckets of the words asked for, and the words reach the Parquet reader."""
    found = index.search("casa covid")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(term" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_long_texts_take_one_shuffle(spark, tmp_path, texts):
    long = spark.createDataFrame([(1, " ".join(f"w{i % 5000}" for i in range(60_000)))], "id long, text string")
    index = S.build_index(long, "id", "text", str(tmp_path), buckets=4, shards=2)
    assert index.search('"w4999 w0 w1"').count() == 1 and index.search('"w1 w0"').count() == 0
    words = S.placed_words(texts, "id", "text").withColumn("b", F.length("term")).repartition("b")
    plan = S.word_postings(words, "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
