"""Body rules on pages written by hand."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.functions import html as H
from threadloom.operators import extraction as E
from threadloom.operators.extraction import extract_pages, repaired_bodies, rule_for
from threadloom.plans.articles import repair_bodies

ARTICLE = """<html><head><title> A  title </title></head><body><nav><p>menu</p></nav>
<article><h1>x</h1><p> one <b>two</b> </p><div><p>nested</p></div><p>three &amp; four</p><p></p></article>
<article><p>second article</p></article></body></html>"""
OLD = """<div id="article-content"><meta name="a"><p>first</p><script>var t="</p>";</script><h2>head</h2>
<div><p>see <a href="/x">x</a></p></div><p><a href="/y">y</a></p></div>"""
LINKS = '<div id="article-content"><p><a href="/x">x</a></p></div>'
BROKEN = '<article><p><b>One.<br><p>Two.</p><p>Three<p>Four <i>five</p></article>'


@pytest.mark.parametrize(
    "page, body",
    [
        (ARTICLE, "one two\n\nthree & four\n\n"),
        (OLD, "first\n\nhead"),
        (LINKS, ""),
        ("<p>nothing to go by</p>", None),
        ("<article></article>", ""),
        (BROKEN, "One.\n\nTwo.\n\nThree\n\nFour five"),
        ('<article><script>var t="</p>";</script><p>a</p></article>', "a"),
    ],
)
def test_article_rule(page, body):
    assert H.article_body(H.outline(page)) == body


def test_default_rule():
    assert H.default_body(H.outline(ARTICLE)) == "one two\n\nnested\n\nthree & four"
    assert H.default_body(H.outline("<body><p>a</p><div><p>b</p></div></body>")) == "a\n\nb"
    assert H.default_body(H.outline("")) == ""
    assert H.title_of(H.outline(ARTICLE)) == "A title"


def test_deep_pages():
    page = "<article>" + "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000 + "</article>"
    assert H.default_body(H.outline(page)) == "deep"
    assert H.article_body(H.outline(page)) == ""


def test_extract_pages(spark):
    data = [(1, "infobae", OLD), (2, "other", OLD), (3, "infobae", "<p>plain</p>"), (4, "infobae", LINKS), (5, "other", None)]
    df = spark.createDataFrame(data, "id int, user string, html string")
    got = {r.id: r.body for r in extract_pages(df, rule_for("user")).collect()}
    # A rule that does not apply keeps the default body; an empty body counts as none.
    assert got == {1: "first\n\nhead", 2: "first\n\nsee x\n\ny", 3: "plain", 4: None, 5: None}


def test_repair(spark):
    data = [(1, "infobae", OLD, "bad"), (2, "infobae", "<p>no rule</p>", "kept"), (3, "other", OLD, "kept"), (4, "infobae", None, "kept")]
    df = spark.createDataFrame(data, "tweet_id long, user string, html string, body string")
    assert [r.tweet_id for r in repaired_bodies(df).collect()] == [1]
    got = {r.tweet_id: r.body for r in repair_bodies(df).collect()}
    assert got == {1: "first\n\nhead", 2: "kept", 3: "kept", 4: "kept"}
    again = repair_bodies(repair_bodies(df))
    assert {r.tweet_id: r.body for r in again.collect()} == got


def test_python_runs_only_here(spark):
    df = spark.createDataFrame([("<p>a</p>",)], "html string")
    plan = extract_pages(df, F.lit(None).cast("string"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


@pytest.mark.parametrize("failure", [IndexError, AttributeError, ValueError, ZeroDivisionError])
def test_a_failing_rule_keeps_the_default_body(spark, failure):
    def rule(page):
        if "bad" in H.title_of(page):
            raise failure("odd page")
        return "by rule"

    rows = [(1, "<title>good</title><article><p>a</p></article>"), (2, "<title>bad</title><article><p>b</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = extract_pages(df, F.lit("mine"), functions={"mine": rule}).select("page_id", "title", "body").collect()
    assert sorted(tuple(r) for r in got) == [(1, "good", "by rule"), (2, "bad", "b")]
    stored = df.select(F.col("page_id").alias("tweet_id"), F.lit("paper").alias("user"), "html")
    fixed = repaired_bodies(stored, {"paper": "mine"}, {"mine": rule}).collect()
    assert [tuple(r) for r in fixed] == [(1, "by rule")]


def test_results_are_handed_back_in_slices():
    """A batch of any length gives results of a slice at a time, and a page is read when its slice is due."""
    seen = []

    def rule(page):
        seen.append(page)
        return None if len(seen) % 2 else f"body {len(seen)}"

    pages, rules = pa.array(["<p>a</p>"] * 4 + [None]), pa.array(["r", "r", "r", "r", None])
    whole = E._whole_pages({"r": rule}, 2).func(iter([(pages, rules)]))
    first = next(whole)
    assert (len(first), len(seen)) == (2, 2)
    assert [x for part in [first, *whole] for x in part.field("body").to_pylist()] == ["a", "body 2", "a", "body 4", None]
    seen.clear()
    parts = [p.to_pylist() for p in E._bodies_by_rule({"r": rule}, 3).func(iter([(pages.slice(0, 4), rules.slice(0, 4))]))]
    assert parts == [[None, "body 2", None], ["body 4"]]
