"""The composite jobs, and the places where users put in their own code."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as TX
from threadloom.model import RELEASE_FIELDS
from threadloom.operators.extraction import extract_pages
from threadloom.plans import audit
from threadloom.plans.articles import comments_of
from threadloom.plans.release import export_release
from threadloom.sources.adapters import Tables, as_posts
from threadloom.sources.readers import QuerySpec
from threadloom.sources.writers import write_dated


@pytest.fixture(scope="module")
def t(spark, folder):
    return Tables(spark, folder)


def test_audit(t):
    old, new = t.docs.where("tweet_id < 150"), t.docs.where("tweet_id >= 50")
    tables = audit.audit_release(new, t.comment_counts, old, barred=["src1"])
    totals = {r.user: r.n_articles for r in tables["totals"].collect()}
    assert totals[None] == new.count() == sum(n for u, n in totals.items() if u)
    assert tables["lost_ids"].count() == 50
    diff = {r.user: r for r in tables["diff"].collect()}
    assert sum(r.n_new - r.n_old for r in diff.values()) == new.count() - old.count()
    assert tables["dates"].where("user = 'src1'").isEmpty()
    assert tables["quality"].first().n_articles == new.count()
    mass = tables["density"].groupBy("user").agg(F.sum("density").alias("m")).collect()
    assert all(0 < r.m < 1.001 for r in mass)
    assert {r.user: r.lost for r in tables["lost_counts"].collect()} == {u: -r.diff for u, r in diff.items() if r.diff < 0}


def test_ratio_of_a_new_newspaper_is_null(spark):
    from threadloom.operators.aggregates import release_diff

    new, old = (spark.createDataFrame([(u,) for u in users], "user string") for users in ("aab", "ac"))
    got = {r.user: (r.n_new, r.n_old, r.diff, r.ratio) for r in release_diff(new, old).collect()}
    assert got == {"a": (2, 1, 1, 200.0), "b": (1, 0, 1, None), "c": (0, 1, -1, 0.0)}


def test_titles(t):
    tables = audit.audit_titles(t.docs, t.comment_counts)
    assert tables["counts"].agg(F.sum("n_articles")).first()[0] == t.docs.count()
    assert tables["repeats"].where("verdict = 'too much' and n < 20").isEmpty()


def test_too_much_and_spread(spark):
    from threadloom.operators.aggregates import title_repeats

    rows = [(i, "u", "often", "2020-01-01 00:00:00") for i in range(20)]
    rows += [(100, "u", "three days", "2020-01-01 00:00:00"), (101, "u", "three days", "2020-01-04 00:00:00")]
    rows += [(102, "u", "almost", "2020-01-01 00:00:00"), (103, "u", "almost", "2020-01-03 23:59:59")]
    df = spark.createDataFrame(rows, "tweet_id long, user string, title string, at string")
    counts = spark.createDataFrame([(100, 4), (101, 5)], "tweet_id long, n_comments long")
    got = title_repeats(df.withColumn("created_at", F.col("at").cast("timestamp_ntz")).drop("at"), counts)
    assert sorted((r.title, r.n, r.n_comments, r.verdict) for r in got.collect()) == [
        ("often", 20, 0, "too much"),
        ("three days", 2, 9, "report"),
    ]


def test_export(t, tmp_path):
    articles = t.docs.withColumns({"text": F.lit(""), "slug": F.lit(""), "url": F.lit("")})
    export_release(articles, t.comments, str(tmp_path / "r"), QuerySpec(users=["src1", "src2"]))
    lines = [json.loads(x) for f in (tmp_path / "r").glob("part-*") for x in f.read_text(encoding="utf-8").splitlines()]
    assert {x["user"] for x in lines} == {"src1", "src2"} and len(lines) == t.docs.where("user in ('src1', 'src2')").count()
    assert set(lines[0]) <= {*RELEASE_FIELDS, "part"}


def test_dated_export(t, tmp_path):
    write_dated(t.articles.limit(1).withColumn("_id", F.lit(1)), str(tmp_path / "d"))
    line = json.loads(next(x for f in (tmp_path / "d").glob("part-*") for x in f.read_text().splitlines()))
    assert "_id" not in line and line["created_at"].endswith("(00:00:00)")


def test_own_body_rule(spark):
    df = spark.createDataFrame([("<title>t</title><h1>Big</h1><p>small</p>",)], "html string")
    rules = {"heading": lambda page: next(n.text() for n in page.walk() if n.tag == "h1")}
    assert extract_pages(df, F.lit("heading"), functions=rules).first().body == "Big"


def test_own_scorer(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 1, "bad word")], "i long, p long, t string")
    posts = as_posts(df, id=F.col("i"), in_reply_to_status_id=F.col("p"), text=F.col("t"))
    articles = spark.createDataFrame([(1,)], "tweet_id long")
    assert comments_of(posts, articles).first().hateful_value is None
    scored = comments_of(posts, articles, lambda text: F.when(TX.matches(text, "bad"), 0.9).otherwise(0.0))
    assert [(r.tweet_id, r.hateful_value) for r in scored.collect()] == [(2, 0.9)]


def test_vocabulary():
    assert TX.vocabulary(["a", "b"], ["b", "c"], without=["a"]) == ["b", "c"]


def test_pages_are_dealt_once(spark, t, capsys):
    """One exchange carries HTML: the choice of the address, the rules, the reading and the posts share it."""
    from threadloom.plans.articles import build_articles

    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        build_articles(t.linked, t.pages, accounts=t.linked.select("user_name").distinct()).explain("formatted")
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    plan = capsys.readouterr().out
    nodes = [part for part in plan.split("\n\n") if part.lstrip().startswith("(") and ") Exchange" in part.split("\n")[0] + part[:40]]
    assert sum("html#" in part for part in nodes) == 1


def test_posts_read_the_buckets_of_their_links(spark, t, tmp_path):
    from threadloom.plans.articles import build_articles, page_store, pages_near, stored_pages

    store = page_store(spark, str(tmp_path / "pages"), buckets=64)
    store.create(stored_pages(t.pages))
    few = t.linked.where("id in (3, 5)")
    near = pages_near(store, few)
    assert "PartitionFilters: [bucket" in near._jdf.queryExecution().executedPlan().toString()
    assert 2 <= near.count() < t.pages.count() / 4
    accounts = t.linked.select("user_name").distinct()
    columns = ["tweet_id", "title", "url", "body"]
    got, whole = (build_articles(few, p, accounts=accounts).select(*columns).collect() for p in (near, t.pages))
    assert sorted(got) == sorted(whole) and len(got) == 2
    assert pages_near(store, few.limit(0)).count() == 0
