"""Reply chains with all their oddities, and lookup rounds."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from threadloom import model
from threadloom.operators import threads as G
from threadloom.plans import upstream
from threadloom.sources.adapters import as_posts

NOW = "timestamp_ntz'2024-01-01 00:00:00'"


def posts_of(spark, rows):
    """Posts from (id, parent)."""
    df = spark.createDataFrame(rows, "i long, p long")
    parent = F.col("p")
    return as_posts(
        df, id=F.col("i"), in_reply_to_status_id=parent, text=F.lit("t"), look_for_upstream=F.coalesce(parent != 0, F.lit(False)), created_at=F.expr(NOW)
    )


def roots(df):
    return {r.id: (r.root_id, r.depth) for r in G.thread_roots(df).collect()}


def test_long_chain(spark):
    assert roots(posts_of(spark, [(i, i - 1 if i > 1 else None) for i in range(1, 41)])) == {i: (1, i - 1) for i in range(1, 41)}


def test_orphans_zero_parents_and_cycles(spark):
    edges = [(1, None), (2, 1), (3, 99), (4, 3), (5, 0), (6, 5), (7, 8), (8, 7), (9, 8), (10, 2), (11, 11)]
    got = roots(posts_of(spark, edges))
    assert got == {
        1: (1, 0), 2: (1, 1), 3: (3, 0), 4: (3, 1), 5: (5, 0), 6: (5, 1), 7: (None, None),
        8: (None, None), 9: (None, None), 10: (1, 2), 11: (None, None),
    }


def test_hot_root(spark):
    n = 20_000
    df = as_posts(spark.range(1, n + 1), id=F.col("id"), in_reply_to_status_id=F.when(F.col("id") > 1, F.lit(1)))
    got = G.thread_roots(df).groupBy("root_id", "depth").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1), (1, 1, n - 1)]


def responses_of(spark, found, failed):
    payload = lambda i, p: json.dumps({"id": i, "in_reply_to_status_id": p, "text": f"post {i}"})
    rows = [(i, payload(i, p), None, None) for i, p in found] + [(i, None, c, "gone") for i, c in failed]
    return spark.createDataFrame(rows, model.RESPONSE)


def errors_of(spark, rows):
    return spark.createDataFrame(rows, model.API_ERROR)


def state(df):
    return {r.id: r.look_for_upstream for r in df.select("id", "look_for_upstream").collect()}


def test_rounds_close_the_chain(spark):
    posts = posts_of(spark, [(10, 9), (11, 9), (20, 19), (30, 29), (40, 39), (50, None), (60, 50)])
    errors = errors_of(spark, [("old", 50, 29)])
    responses = responses_of(spark, [(9, 8), (8, 7), (7, None), (29, None), (50, None)], [(19, 422), (39, None)])
    closed, failed, summaries = upstream.resolve_upstream(posts, errors, responses)
    assert state(closed) == {
        10: False, 11: False, 9: False, 8: False, 7: False,  # found upwards to the root
        20: False,  # failed with a code: settled
        30: True,  # its parent failed before: not asked for again
        40: True,  # failed without a code: not saved, still waiting
        50: False, 60: True,  # a parent that is stored already is refused, the reply keeps waiting
    }
    assert sorted((r.tweet_id, r.api_code) for r in failed.collect()) == [(19, 422), (29, 50)]
    assert summaries[0] == {"new_tweets": 1, "new_errors": 1} and summaries[-1] == {"new_tweets": 0, "new_errors": 0}
    again, _, more = upstream.resolve_upstream(closed, failed, responses)
    assert state(again) == state(closed) and len(more) == 1


def test_a_chain_of_300_levels_closes(spark):
    posts = posts_of(spark, [(1000, 999)])
    responses = responses_of(spark, [(i, i - 1 if i > 700 else None) for i in range(700, 1000)], [])
    closed, failed, summaries = upstream.resolve_upstream(posts, errors_of(spark, []), responses)
    assert state(closed) == {i: False for i in range(700, 1001)} and failed.isEmpty() and len(summaries) == 301


def test_repeated_ids_give_one_root(spark):
    edges = [(i, i - 1 if i > 1 else None) for i in range(1, 8)] * 3
    assert G.thread_roots(posts_of(spark, edges)).count() == 7


def test_one_answer_counts(spark):
    posts = posts_of(spark, [(2, 1)])
    responses = responses_of(spark, [(1, None), (1, None)], [(1, 422)])
    step = upstream.lookup_round(posts, errors_of(spark, []), None, responses)
    assert step.found.count() == 1 and step.errors.isEmpty()
    assert G.epoch_summary(step.outcomes).first().asDict() == {"new_tweets": 1, "new_errors": 0}


def test_counts_of_frontier(spark):
    posts = posts_of(spark, [(10, 9), (11, 9), (20, 19), (30, 0), (40, None)])
    assert tuple(G.frontier_counts(posts, errors_of(spark, [("m", 1, 19), ("m", 2, 19)])).first()) == (2, 1)


def test_recheck(spark):
    posts = posts_of(spark, [(1, None), (2, None), (3, None), (4, None)])
    errors = errors_of(spark, [("old", 422, 4)])
    responses = responses_of(spark, [(1, None), (4, None)], [(2, 34), (2, 422), (3, None)])
    stamped, all_errors = upstream.check_removed(posts, errors, responses, F.expr(NOW))
    moments = {r.id: r.last_checked_for_errors for r in stamped.collect()}
    assert moments == {1: dt.datetime(2024, 1, 1), 2: None, 3: None, 4: None}
    assert sorted((r.tweet_id, r.api_code) for r in all_errors.collect()) == [(2, 34), (4, 422)]


def test_last_label_wins(spark):
    posts = posts_of(spark, [(1, None), (2, None), (3, None)])
    labels = spark.createDataFrame([(1, True, 1), (1, False, 2), (2, True, 5)], "id long, interesting boolean, at int")
    got = {r.id: (r.interesting, r.checked) for r in upstream.apply_labels(posts, labels, [F.desc("at")]).collect()}
    assert got == {1: (False, True), 2: (True, True), 3: (None, None)}


def test_accused(spark):
    rows = [
        (1, None, "a plain post", 0, None), (2, 1, "sos machista", 0, 1), (3, None, "with a link", 1, None),
        (4, 3, "machista!", 0, 3), (5, 1, "machista " * 30, 0, 1), (6, None, "never accused", 0, None), (7, None, "machista", 0, None),
    ]
    df = spark.createDataFrame(rows, "i long, p long, t string, links int, u long")
    urls = F.array_repeat(F.struct(F.lit("http://x").alias("expanded_url")), F.col("links"))
    posts = as_posts(
        df, id=F.col("i"), text=F.col("t"), in_reply_to_status_id=F.col("p"), in_reply_to_user_id=F.col("u"),
        entities=F.struct(urls.alias("urls"), F.lit(None).cast("array<struct<media_url:string>>").alias("media")),
    )
    assert [r.id for r in G.accused_posts(posts, "machista misogino", 100).collect()] == [1]


@pytest.mark.parametrize("n", [0, 3])
def test_sample_is_reproducible(spark, n):
    from threadloom.operators.samples import random_rows, random_share

    df = spark.range(1000)
    first = [r.id for r in random_rows(df, "id", n, 5).collect()]
    assert first == [r.id for r in random_rows(df.repartition(7), "id", n, 5).collect()] and len(first) == n
    assert random_share(df, 0.5, 1).count() == random_share(df, 0.5, 1).count()
