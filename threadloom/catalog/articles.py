"""Releases: cutting, writing, nesting, pages and bodies."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.catalog.registry import query, sql_tokens, sql_unescape
from threadloom.functions import html as H
from threadloom.functions import scalars as X
from threadloom.operators import extraction as E
from threadloom.operators import filters as P
from threadloom.operators.groups import nest_in_parts
from threadloom.plans import articles as build
from threadloom.plans import release as R
from threadloom.plans.kept_blocks import COMMENT_ORDER, kept_blocks
from threadloom.plans.scoring import exploded_comments, numbered_comments
from threadloom.session import run_dir
from threadloom.sources import readers, writers
from threadloom.sources.adapters import Tables

SPEC = readers.QuerySpec(
    users=["1-URGENT", "2-HIGH", "5-LOW"],
    min_date="1996-03-01T00:00:00Z",
    search_terms=["für", "étre", "que ", "ción", "ther-ble"],
)
SPEC_WORDS = "['fur', 'etre', 'que', 'cion', 'ther', 'ble']"
SPEC_WHERE = f"""
    "user" IN ('1-URGENT', '2-HIGH', '5-LOW') AND created_at >= TIMESTAMP '1996-03-01'
    AND list_has_any({sql_tokens("title || ' ' || body")}, {SPEC_WORDS})"""
LIST = "coalesce(string_agg(c.text, ',' ORDER BY c.created_at, c.tweet_id, c.text), '')"

# Small, so that the test tables have articles with several blocks; the oracles count by the same number.
BLOCK = 5
IN_BLOCKS = "(SELECT *, (row_number() OVER (PARTITION BY article_id ORDER BY created_at, tweet_id, text) - 1) // 5 AS part FROM comments)"


def comment_texts(rows: DataFrame) -> DataFrame:
    """Nested comments as one string and a number, comparable across engines."""
    return rows.withColumns(
        {
            "n_comments": F.size("comments").cast("long"),
            "comment_list": F.array_join(F.transform("comments", lambda c: c["text"]), ","),
        }
    ).drop("comments")


def worded(t: Tables) -> DataFrame:
    return t.news.withColumns(
        {"text": F.lit(""), "slug": X.slug("title"), "url": F.lit(None).cast("string"), "html": F.lit(None).cast("string")}
    )


def released(t: Tables, spec: readers.QuerySpec | None = SPEC) -> DataFrame:
    return R.cut_release(worded(t), t.comments, spec, BLOCK)


@query(
    "release_cut",
    f"""
    SELECT n.tweet_id, n."user", n.title, n.body, n.created_at, coalesce(c.part, 0) AS part,
           count(c.text) AS n_comments, {LIST} AS comment_list
    FROM (SELECT * FROM news WHERE {SPEC_WHERE}) n LEFT JOIN {IN_BLOCKS} c ON c.article_id = n.tweet_id
    GROUP BY ALL""",
)
def release_cut(t):
    return comment_texts(released(t)).select(
        "tweet_id", "user", "title", "body", "created_at", "part", "n_comments", "comment_list"
    )


@query("release_counts", f'SELECT "user", count(*) AS n FROM news WHERE {SPEC_WHERE} GROUP BY 1')
def release_counts(t):
    return R.release_counts(worded(t), SPEC)


@query("release_counts_of_file", f'SELECT "user", count(*) AS n FROM news WHERE {SPEC_WHERE} GROUP BY 1')
def release_counts_of_file(t):
    """The same with the spec out of a file."""
    path = run_dir(t.spark, "spec")
    t.spark.createDataFrame([(json.dumps(asdict(SPEC), indent=2),)], "value string").coalesce(1).write.text(path)
    return R.release_counts(worded(t), readers.QuerySpec.read(t.spark, path))


@query("release_whole", 'SELECT "user", count(*) AS n FROM news GROUP BY 1')
def release_whole(t):
    return R.release_counts(worded(t), readers.QuerySpec.of({}))


@query(
    "release_roundtrip",
    f"""
    SELECT n.tweet_id, n."user", n.created_at, n.body, count(c.text) AS n_comments,
           round(coalesce(sum(c.score * 10), 0), 6) AS score_sum
    FROM (SELECT * FROM news WHERE {SPEC_WHERE}) n LEFT JOIN comments c ON c.article_id = n.tweet_id
    GROUP BY ALL""",
)
def release_roundtrip(t):
    path = run_dir(t.spark, "release")
    writers.write_release(released(t), path)
    back = readers.read_release(t.spark, path)
    scores = F.aggregate("comments", F.lit(0.0), lambda a, c: a + c["hateful_value"])
    # Blocks of an article add up to one row again.
    return back.groupBy("tweet_id", "user", "created_at", "body").agg(
        F.sum(F.size("comments")).cast("long").alias("n_comments"), F.round(F.sum(scores), 6).alias("score_sum")
    )


@query("release_arrays", 'SELECT tweet_id, "user", title, body, created_at FROM news')
def release_arrays(t):
    """Read from files that hold one array each, printed over many lines."""
    path = run_dir(t.spark, "arrays")
    writers.write_arrays(t.news.select("tweet_id", "user", "title", "body", "created_at"), path, "tweet_id")
    return readers.read_release(t.spark, path, array=True).select("tweet_id", "user", "title", "body", "created_at")


@query(
    "dated_export",
    "SELECT tweet_id, strftime(created_at, '%d-%b-%Y (%H:%M:%S)') AS created_at, title FROM news",
)
def dated_export(t):
    path = run_dir(t.spark, "dated")
    writers.write_dated(t.news.withColumn("_id", F.col("tweet_id")), path)
    return t.spark.read.schema("tweet_id long, created_at string, title string").json(path)


@query("table_dump", 'SELECT tweet_id, "user", created_at FROM articles')
def table_dump(t):
    path = run_dir(t.spark, "dump")
    writers.dump(t.articles, path)
    return readers.read_table(t.spark, path, t.articles.schema)


@query("rebuilt_table", 'SELECT tweet_id, "user" FROM articles')
def rebuilt_table(t):
    """Replace a table: what stood there before is gone."""
    path = run_dir(t.spark, "rebuilt")
    writers.replace_table(t.articles.select("tweet_id", "user").withColumn("user", F.lit("old")), path)
    writers.replace_table(t.articles.select("tweet_id", "user"), path)
    return t.spark.read.parquet(path)


NESTED_SQL = f"""
    SELECT a.tweet_id, coalesce(c.part, 0) AS part, count(c.text) AS n_comments,
           {LIST} AS comment_list
    FROM articles a LEFT JOIN {IN_BLOCKS} c ON c.article_id = a.tweet_id GROUP BY ALL"""


@query("nested_comments", NESTED_SQL)
def nested_comments(t):
    rows = build.with_comments(t.articles, t.comments, BLOCK)
    return comment_texts(rows).select("tweet_id", "part", "n_comments", "comment_list")


@query("nested_kept", NESTED_SQL)
def nested_kept(t):
    """The same out of three batches: two in the order of time, then late ones from all times."""
    comments = t.comments.select("article_id", *COMMENT_ORDER)
    table = kept_blocks(t.spark, run_dir(t.spark, "blocks"), comments.schema, BLOCK, buckets=8)
    late = F.pmod(F.xxhash64("text"), F.lit(7)) == 0
    recent = F.col("created_at") >= F.lit("1996-01-01").cast("timestamp_ntz")
    for number, part in enumerate([~late & ~recent, ~late & recent, late]):
        table.add(comments.where(part), number)
    return comment_texts(table.nested(t.articles, "tweet_id")).select("tweet_id", "part", "n_comments", "comment_list")


@query(
    "reply_lists",
    """
    SELECT parent_id, part, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT l_orderkey AS parent_id, l_partkey AS id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1) // 5 AS part
          FROM lineitem)
    GROUP BY 1, 2""",
)
def reply_lists(t):
    """Reply ids grouped by parent, in blocks."""
    parents = t.comment_posts.select(F.col("in_reply_to_status_id").alias("parent_id")).distinct()
    rows = nest_in_parts(parents, "parent_id", t.comment_posts, "in_reply_to_status_id", F.col("id"), ["id", "text"], "ids", BLOCK)
    return rows.select("parent_id", "part", F.size("ids").cast("long").alias("n"), F.array_join("ids", ",").alias("ids"))


@query(
    "comments_exploded",
    """
    SELECT article_id, text, score > 0.05 AS over,
           row_number() OVER (PARTITION BY article_id ORDER BY created_at, tweet_id, text) AS position
    FROM comments""",
)
def comments_exploded(t):
    rows = numbered_comments(t.comments, "article_id", ["created_at", "tweet_id", "text"], F.col("score"), 0.05)
    return rows.select("article_id", "text", "over", "position")


@query(
    "comments_unnested",
    """
    SELECT article_id, (position - 1) // 5 AS part, text, position
    FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY created_at, tweet_id, text) AS position FROM comments)
    WHERE article_id IN (SELECT tweet_id FROM news)""",
)
def comments_unnested(t):
    return exploded_comments(released(t, None), block_rows=BLOCK).select("article_id", "part", "text", "position")


# ---- pages and bodies


@query(
    "article_pages",
    r"""
    SELECT l.id, l.link, p.url AS page_url,
           lower(regexp_extract(p.url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1)) AS host
    FROM linked l LEFT JOIN page_keys p ON p.key = l.link_key""",
)
def article_pages(t):
    return build.with_pages(t.linked, t.pages.drop("page_id")).select("id", "link", "page_url", X.host("page_url").alias("host"))


@query("first_links", "SELECT id, link FROM linked")
def first_links(t):
    return t.linked.select("id", X.first_link("entities.urls").alias("link"))


@query("page_bodies", "SELECT page_id, title, body FROM page_parts WHERE length(body) > 0")
def page_bodies(t):
    """The rule for newspapers with an article element: its direct paragraphs."""
    read = E.extract_pages(t.pages, F.lit("article"))
    return read.where(P.not_empty("body")).select("page_id", "title", "body")


@query(
    "page_default_bodies",
    r"""
    SELECT page_id, array_to_string([x FOR x IN string_split(body, chr(10) || chr(10)) IF x <> ''], chr(10) || chr(10)) AS body
    FROM page_parts""",
)
def page_default_bodies(t):
    return E.extract_pages(t.pages, F.lit(None).cast("string")).select("page_id", "body")


def _moody(page):
    """A rule that fails on every page whose title has an odd number of characters."""
    title = H.title_of(page)
    if len(title) % 2:
        return [][0]
    return f"by rule: {title}"


@query(
    "failing_rules",
    r"""
    SELECT page_id, CASE WHEN length(title) % 2 = 0 THEN 'by rule: ' || title
      ELSE array_to_string([x FOR x IN string_split(body, chr(10) || chr(10)) IF x <> ''], chr(10) || chr(10)) END AS body
    FROM page_parts""",
)
def failing_rules(t):
    """Where the rule fails the default body stands, elsewhere what the rule gives."""
    return E.extract_pages(t.pages, F.lit("moody"), functions={"moody": _moody}).select("page_id", "body")


@query(
    "content_bodies",
    rf"""
    SELECT q.page_id, trim(regexp_replace({sql_unescape("regexp_extract(p.html, '(?s)<h1>(.*?)</h1>', 1)")}, '<[^>]*>', '', 'g')) || chr(10) || chr(10) || q.body AS body
    FROM pages p JOIN page_parts q ON q.page_id = p.page_id""",
)
def content_bodies(t):
    """Pages whose text stands in a content block instead of an article element."""
    html = F.replace(F.replace("html", F.lit("<article>"), F.lit('<div id="article-content">')), F.lit("</article>"), F.lit("</div>"))
    return E.extract_pages(t.pages.withColumn("html", html), F.lit("article")).select("page_id", "body")


# Every source of the test tables follows the article rule.
ALL_SOURCES = {f"src{i}": "article" for i in range(20)}


@query(
    "articles_built",
    """
    SELECT l.id AS tweet_id, l.text, l.screen_name AS "user", l.created_at, p.url, p.title, p.body
    FROM linked l LEFT JOIN page_keys p ON p.key = l.link_key
    WHERE l.id NOT IN (SELECT tweet_id FROM errors)""",
)
def articles_built(t):
    """Posts of all accounts that are not built yet, with their pages; error ids stand for built articles."""
    rows = build.build_articles(t.linked, t.pages.drop("page_id"), t.errors.select("tweet_id"), rules=ALL_SOURCES)
    return rows.select("tweet_id", "text", "user", "created_at", "url", "title", "body")


@query(
    "articles_with_page",
    """
    SELECT l.id AS tweet_id, p.url, p.title
    FROM linked l JOIN page_keys p ON p.key = l.link_key WHERE l.flagged""",
)
def articles_with_page(t):
    """Flagged posts only, posts without a page left out."""
    rows = build.build_articles(t.linked, t.pages.drop("page_id"), keep_without_page=False, flagged_only=True)
    return rows.select("tweet_id", "url", "title")


@query(
    "body_repair",
    """
    SELECT page_id AS tweet_id, CASE WHEN url LIKE 'https%' THEN body ELSE 'as it was' END AS body FROM page_parts""",
)
def body_repair(t):
    """Stored articles with a wrong body: those of newspapers with a rule are read again, others stay."""
    newspaper = F.when(F.col("url").startswith("https"), "infobae").otherwise("other")
    stored = t.pages.select(
        F.col("page_id").alias("tweet_id"), newspaper.alias("user"), "html", F.lit("as it was").alias("body")
    )
    return build.repair_bodies(stored).select("tweet_id", "body")


@query("unbuilt_posts", 'SELECT id FROM linked WHERE id NOT IN (SELECT tweet_id FROM errors)')
def unbuilt_posts(t):
    return P.without_keys(build.news_posts(t.linked), t.errors, "id", "tweet_id").select("id")
