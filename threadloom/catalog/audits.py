"""Counts, comparisons, titles, scores, histograms, votes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from threadloom.catalog.registry import query
from threadloom.functions import scalars as X
from threadloom.model import CATEGORIES
from threadloom.operators import aggregates as A
from threadloom.operators import distributions as D
from threadloom.operators import filters as P
from threadloom.operators import samples as S
from threadloom.operators.groups import newest_per
from threadloom.plans import audit, scoring
from threadloom.plans.articles import with_comments
from threadloom.session import run_dir
from threadloom.sources import readers, writers

CUT = dt.datetime(2000, 1, 1)
# Two releases of the articles: the old one up to the cut, the new one from 1997 on.
OLD = "SELECT * FROM articles WHERE created_at < TIMESTAMP '2000-01-01'"
NEW = "SELECT * FROM articles WHERE created_at >= TIMESTAMP '1997-01-01'"


def old_new(t):
    return t.articles.where(P.before(CUT)), t.articles.where(P.since(dt.datetime(1997, 1, 1)))


# Small, so that the test tables have articles with several blocks; the oracles count by the same number.
BLOCK = 5


@query("articles_by_user", 'SELECT "user", count(*) AS n FROM articles GROUP BY 1 ORDER BY 1')
def articles_by_user(t):
    return A.count_by(t.articles, "user").orderBy("user")


@query("distinct_users", 'SELECT count(DISTINCT "user") AS n_users, count(DISTINCT tweet_id) AS n_ids FROM articles')
def distinct_users(t):
    return t.articles.agg(F.countDistinct("user").alias("n_users"), F.countDistinct("tweet_id").alias("n_ids"))


@query("date_range", "SELECT min(created_at) AS first_at, max(created_at) AS last_at FROM articles")
def date_range(t):
    return A.date_range(t.articles)


@query("date_range_by_user", 'SELECT "user", min(created_at) AS first_at, max(created_at) AS last_at FROM articles GROUP BY 1')
def date_range_by_user(t):
    return A.date_range(t.articles, "user")


@query("dates_by_user", 'SELECT "user", CAST(created_at AS DATE) AS day, count(*) AS n FROM articles GROUP BY 1, 2')
def dates_by_user(t):
    return A.dates_by_user(t.articles)


@query(
    "release_rollup",
    """
    SELECT a."user", count(*) AS n_articles, CAST(coalesce(sum(c.n_comments), 0) AS BIGINT) AS n_comments,
           CAST(grouping(a."user") AS BIGINT) AS is_total
    FROM articles a LEFT JOIN comment_counts c ON c.tweet_id = a.tweet_id GROUP BY ROLLUP (a."user")""",
)
def release_rollup(t):
    return A.comment_totals(t.articles, t.comment_counts)


@query("total_comments", "SELECT count(*) AS n FROM comments c JOIN articles a ON a.tweet_id = c.article_id")
def total_comments(t):
    kept = P.only_keys(t.comments, t.articles, "article_id", "tweet_id")
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query(
    "release_diff",
    f"""
    SELECT coalesce(n."user", o."user") AS "user", coalesce(n.c, 0) AS n_new, coalesce(o.c, 0) AS n_old,
           coalesce(n.c, 0) - coalesce(o.c, 0) AS diff, round(100.0 * coalesce(n.c, 0) / nullif(o.c, 0), 2) AS ratio
    FROM (SELECT "user", count(*) AS c FROM ({NEW}) GROUP BY 1) n
    FULL JOIN (SELECT "user", count(*) AS c FROM ({OLD}) GROUP BY 1) o ON n."user" = o."user" """,
)
def release_diff(t):
    old, new = old_new(t)
    return A.release_diff(new, old)


@query(
    "release_lost_counts",
    """
    SELECT o."user", o.c - coalesce(n.c, 0) AS lost
    FROM (SELECT "user", count(*) AS c FROM articles GROUP BY 1) o
    LEFT JOIN (SELECT "user", count(*) AS c FROM articles
               WHERE created_at >= TIMESTAMP '1997-01-01' AND "user" <> '5-LOW' GROUP BY 1) n ON n."user" = o."user"
    WHERE o.c > coalesce(n.c, 0)""",
)
def release_lost_counts(t):
    _, new = old_new(t)
    return A.lost_counts(new.where(P.newspapers(barred=["5-LOW"])), t.articles)


@query("lost_ids", "SELECT tweet_id FROM articles WHERE \"user\" = '2-HIGH' AND created_at < TIMESTAMP '1997-01-01'")
def lost_ids(t):
    old, new = old_new(t)
    return audit.lost_ids(new, old, "2-HIGH")


@query(
    "lost_in_store",
    """
    SELECT a.tweet_id, a.created_at FROM articles a
    WHERE a."user" = '2-HIGH' AND a.created_at < TIMESTAMP '1997-01-01' ORDER BY created_at, tweet_id""",
)
def lost_in_store(t):
    """The lost articles as the store has them, oldest first."""
    old, new = old_new(t)
    lost = P.only_keys(t.articles, audit.lost_ids(new, old, "2-HIGH"), "tweet_id")
    return lost.select("tweet_id", "created_at").orderBy("created_at", "tweet_id")


@query("kept_ids", f"SELECT tweet_id FROM ({OLD}) WHERE tweet_id IN (SELECT tweet_id FROM ({NEW}))")
def kept_ids(t):
    old, new = old_new(t)
    return audit.kept_ids(new, old)


@query(
    "releases_overlaid",
    f"""
    SELECT release, CAST(created_at AS DATE) AS day, count(*) AS n
    FROM (SELECT 'new' AS release, created_at FROM ({NEW}) UNION ALL SELECT 'old', created_at FROM ({OLD})) GROUP BY 1, 2""",
)
def releases_overlaid(t):
    old, new = old_new(t)
    both = audit.side_by_side(new, old, "new", "old")
    return both.groupBy("release", F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "id_membership",
    f"""
    SELECT count(*) AS n_ids, count(*) FILTER (held) AS n_held, count(*) FILTER (NOT held) AS n_missing
    FROM (SELECT tweet_id IN (SELECT tweet_id FROM ({NEW})) AS held FROM errors)""",
)
def id_membership(t):
    """An id list written as Latin-1 CSV, read back, compared with a release."""
    path = run_dir(t.spark, "ids")
    ids = t.errors.select(F.col("tweet_id").cast("string").alias("ID_OT"), F.lit("señal").alias("note"))
    noise = t.errors.limit(1).select(F.lit("sin número").alias("ID_OT"), F.lit("").alias("note"))
    ids.unionByName(noise).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    _, new = old_new(t)
    return audit.membership(readers.read_id_csv(t.spark, path), new)


@query(
    "title_counts",
    'SELECT "user", count(DISTINCT title) AS n_titles, count(*) AS n_articles FROM docs GROUP BY 1',
)
def title_counts(t):
    return A.title_counts(t.docs)


@query(
    "title_repeats",
    """
    SELECT * FROM (
      SELECT "user", title, count(*) AS n, CAST(coalesce(sum(n_comments), 0) AS BIGINT) AS n_comments,
             CAST(floor(epoch(max(created_at) - min(created_at)) / 86400) AS BIGINT) AS days,
             CASE WHEN count(*) >= 20 THEN 'too much'
                  WHEN count(*) >= 2 AND floor(epoch(max(created_at) - min(created_at)) / 86400) > 2 THEN 'report' END AS verdict
      FROM (SELECT lang AS "user", title, created_at, tweet_id FROM docs) d LEFT JOIN comment_counts c ON c.tweet_id = d.tweet_id
      GROUP BY 1, 2) WHERE verdict IS NOT NULL""",
)
def title_repeats(t):
    return A.title_repeats(t.docs.drop("user").withColumnRenamed("lang", "user"), t.comment_counts)


SCORES = """
    SELECT article_id AS tweet_id, count(*) AS n_comments, count(*) FILTER (score > 0.05) AS n_over, avg(score) AS mean_value
    FROM comments GROUP BY 1"""


@query(
    "score_articles",
    f"""
    SELECT a.tweet_id, a."user", s.n_comments, s.n_over, round(s.mean_value, 8) AS mean_value
    FROM articles a JOIN ({SCORES}) s ON s.tweet_id = a.tweet_id WHERE s.n_comments >= 6 AND round(s.mean_value, 8) >= 0.05""",
)
def score_articles(t):
    rows = scoring.score_articles(t.articles, t.comments, F.col("score"), min_comments=6, threshold=0.05)
    rows = rows.withColumn("mean_value", F.round("mean_value", 8)).where(P.mean_at_least(0.05))
    return rows.select("tweet_id", "user", "n_comments", "n_over", "mean_value")


@query(
    "score_strict",
    f"SELECT tweet_id, n_over FROM (SELECT * FROM ({SCORES}) WHERE n_comments >= 6 AND round(mean_value, 8) > 0.06)",
)
def score_strict(t):
    scores = A.article_scores(t.comments, "article_id", F.col("score"), 0.05).withColumn("mean_value", F.round("mean_value", 8))
    return scores.where((F.col("n_comments") >= 6) & P.mean_at_least(0.06, strict=True)).select("tweet_id", "n_over")


@query(
    "scores_nested",
    """
    SELECT a.tweet_id, count(c.text) AS n_comments, count(*) FILTER (c.score * 10 > 0.5) AS n_over,
           round(avg(c.score * 10), 6) AS mean_value
    FROM articles a LEFT JOIN comments c ON c.article_id = a.tweet_id GROUP BY 1""",
)
def scores_nested(t):
    rows = A.nested_scores(with_comments(t.articles, t.comments, BLOCK))
    return rows.withColumn("mean_value", F.round("mean_value", 6))


@query(
    "toxic_by_source",
    """
    SELECT d.source AS "user", count(*) AS n, count(*) FILTER (l.toxic > 0) AS n_over, round(avg(l.toxic), 8) AS mean_value
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""",
)
def toxic_by_source(t):
    rows = t.table("labels").join(t.table("documents").select("doc_id", F.col("source").alias("user")), "doc_id")
    return rows.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") > 0).alias("n_over"), F.round(F.avg("toxic"), 8).alias("mean_value")
    )


def _histogram_sql(values: str, bins: int, lo: str, hi: str) -> str:
    return f"""
    WITH vals AS ({values}), ends AS (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM vals),
    counted AS (SELECT least(floor({bins}::DOUBLE * (v - lo) / (hi - lo)) + 1, {bins})::BIGINT AS bin, count(*) AS n
                FROM vals, ends WHERE v >= lo AND v <= hi GROUP BY 1)
    SELECT g.bin, round(lo + ((g.bin - 1) * (hi - lo)) / {bins}::DOUBLE, 6) AS from_value,
           round(lo + (g.bin * (hi - lo)) / {bins}::DOUBLE, 6) AS to_value, coalesce(c.n, 0) AS n
    FROM (SELECT unnest(range(1, {bins + 1})) AS bin) g CROSS JOIN ends LEFT JOIN counted c ON c.bin = g.bin"""


def _edges(rows):
    return rows.withColumns({c: F.round(c, 6) for c in ("from_value", "to_value")})


@query("histogram_hateful", _histogram_sql(f"SELECT CAST(n_over AS DOUBLE) AS v FROM ({SCORES})", 25, "any_value(0)", "any_value(50)"))
def histogram_hateful(t):
    scores = A.article_scores(t.comments, "article_id", F.col("score"), 0.05)
    return _edges(D.histogram(scores, F.col("n_over"), 25, 0, 50))


@query("histogram_mean", _histogram_sql(f"SELECT round(mean_value, 6) AS v FROM ({SCORES})", 25, "any_value(0)", "any_value(0.1)"))
def histogram_mean(t):
    scores = A.article_scores(t.comments, "article_id", F.col("score"))
    return _edges(D.histogram(scores, F.round("mean_value", 6), 25, 0, 0.1))


@query("histogram_dates", _histogram_sql("SELECT CAST(date_diff('day', DATE '1970-01-01', created_at) AS DOUBLE) AS v FROM articles", 100, "min(v)", "max(v)"))
def histogram_dates(t):
    return _edges(D.histogram(t.articles, X.day_number("created_at"), 100))


@query("histogram_replies", _histogram_sql("SELECT CAST(n_comments AS DOUBLE) AS v FROM comment_counts", 9, "min(v)", "max(v)"))
def histogram_replies(t):
    return _edges(D.histogram(t.comment_counts, F.col("n_comments"), 9))


@query(
    "date_density",
    """
    WITH days AS (SELECT "user", date_diff('day', DATE '1970-01-01', created_at) AS d, count(*) AS n FROM articles GROUP BY 1, 2),
    shape AS (SELECT "user", count(*) AS total, min(d) AS d0, max(d) AS d1, stddev_samp(d) * pow(count(*), -0.2) AS h
              FROM (SELECT "user", date_diff('day', DATE '1970-01-01', created_at) AS d FROM articles) GROUP BY 1),
    grid AS (SELECT "user", total, h, unnest(generate_series(d0, d1, 7)) AS g FROM shape)
    SELECT g."user", CAST(DATE '1970-01-01' + CAST(g.g AS INTEGER) AS DATE) AS day,
           round(sum(d.n * exp(-0.5 * pow((g.g - d.d) / g.h, 2))) / (any_value(g.total) * any_value(g.h) * sqrt(2 * pi())), 8) AS density
    FROM grid g JOIN days d ON d."user" = g."user" GROUP BY 1, 2""",
)
def date_density(t):
    return D.date_density(t.articles, step_days=7).withColumn("density", F.round("density", 8))


@query(
    "votes_majority",
    """
    WITH voted AS (SELECT *, greatest(women, lgbti, racism, class, politics, disabled, appearance, criminal) AS m FROM annotations)
    SELECT tweet_id, CAST(m AS BIGINT) AS max_votes, concat_ws(',',
      CASE WHEN women = m THEN 'WOMEN' END, CASE WHEN lgbti = m THEN 'LGBTI' END, CASE WHEN racism = m THEN 'RACISM' END,
      CASE WHEN class = m THEN 'CLASS' END, CASE WHEN politics = m THEN 'POLITICS' END, CASE WHEN disabled = m THEN 'DISABLED' END,
      CASE WHEN appearance = m THEN 'APPEARANCE' END, CASE WHEN criminal = m THEN 'CRIMINAL' END) AS most_voted
    FROM voted WHERE hate >= 2""",
)
def votes_majority(t):
    rows = t.annotations.where(P.votes_at_least(2)).withColumns(A.most_voted())
    return rows.select("tweet_id", "max_votes", F.array_join("most_voted", ",").alias("most_voted"))


@query("annotations_roundtrip", "SELECT tweet_id, article_id, text, CAST(hate AS BIGINT) AS hate, CAST(racism AS BIGINT) AS racism FROM annotations")
def annotations_roundtrip(t):
    path = run_dir(t.spark, "annotations")
    writers.dump(t.annotations, path, "json")
    back = readers.read_annotations(t.spark, path)
    return back.select(
        "tweet_id", "article_id", "text", F.size("HATE").cast("long").alias("hate"), F.size(CATEGORIES[2]).cast("long").alias("racism")
    )


@query(
    "annotated_replies",
    """
    SELECT a.tweet_id, n.title AS article_title, c.part, count(*) AS n_replies,
           string_agg(c.text, ',' ORDER BY c.tweet_id, c.text) AS replies
    FROM annotations a
    JOIN (SELECT *, (row_number() OVER (PARTITION BY article_id ORDER BY tweet_id, text) - 1) // 5 AS part FROM comments) c
      ON c.article_id = a.tweet_id
    JOIN docs n ON n.tweet_id = a.article_id
    WHERE a.hate >= 2 GROUP BY 1, 2, 3""",
)
def annotated_replies(t):
    rows = scoring.annotated_replies(t.annotations, t.comment_posts, t.docs, block_rows=BLOCK)
    return rows.select(
        "tweet_id",
        "article_title",
        "part",
        F.size("replies").cast("long").alias("n_replies"),
        F.array_join(F.transform("replies", lambda r: r["text"]), ",").alias("replies"),
    )


@query("unmatched_annotations", "SELECT count(*) AS n_unmatched FROM annotations WHERE article_id NOT IN (SELECT tweet_id FROM articles)")
def unmatched_annotations(t):
    return scoring.unmatched_annotations(t.annotations, t.articles)


@query(
    "quality_counts",
    """
    SELECT count(*) AS n_articles, count(*) FILTER (body = '') AS empty_bodies, count(*) FILTER (body IS NULL) AS no_bodies,
           count(*) FILTER (title = '') AS empty_titles, count(*) FILTER (length(body) > 0) AS with_body
    FROM (SELECT a.tweet_id, d.body, d.title FROM articles a LEFT JOIN docs d ON d.tweet_id = a.tweet_id)""",
)
def quality_counts(t):
    return audit.quality_counts(t.articles.join(t.docs.select("tweet_id", "body", "title"), "tweet_id", "left"))


@query(
    "audit_release",
    f"""
    WITH new AS (SELECT a.*, d.body, d.title FROM ({NEW}) a LEFT JOIN docs d ON d.tweet_id = a.tweet_id)
    SELECT 'articles' AS name, count(*) AS n FROM new
    UNION ALL SELECT 'no_bodies', count(*) FILTER (body IS NULL) FROM new
    UNION ALL SELECT 'with_body', count(*) FILTER (length(body) > 0) FROM new
    UNION ALL SELECT 'lost', count(*) FROM ({OLD}) WHERE tweet_id NOT IN (SELECT tweet_id FROM new)""",
)
def audit_release(t):
    """Two of the tables of a whole audit, as names and numbers."""
    old, new = old_new(t)
    new = new.join(t.docs.select("tweet_id", "body", "title"), "tweet_id", "left")
    tables = audit.audit_release(new, t.comment_counts, old)
    lost = tables["lost_ids"].agg(F.lit("lost").alias("name"), F.count(F.lit(1)).alias("n"))
    numbers = F.expr("stack(3, 'articles', n_articles, 'no_bodies', no_bodies, 'with_body', with_body) AS (name, n)")
    return tables["quality"].select(numbers).unionByName(lost)


@query(
    "audit_titles",
    """
    WITH d AS (SELECT lang AS "user", title, created_at FROM docs)
    SELECT 'counts' AS name, "user", count(DISTINCT title) AS n FROM d GROUP BY 2
    UNION ALL
    SELECT 'repeats', "user", count(*) FROM (
      SELECT "user", title FROM d GROUP BY 1, 2
      HAVING count(*) >= 20 OR (count(*) >= 2 AND floor(epoch(max(created_at) - min(created_at)) / 86400) > 2)) GROUP BY 2""",
)
def audit_titles(t):
    tables = audit.audit_titles(t.docs.drop("user").withColumnRenamed("lang", "user"), t.comment_counts)
    counts = tables["counts"].select(F.lit("counts").alias("name"), "user", F.col("n_titles").alias("n"))
    return counts.unionByName(tables["repeats"].groupBy("user").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit("repeats")))


@query(
    "field_presence",
    """
    SELECT count(*) AS n, count(d.body) AS body, count(d.title) AS title, count(p.url) AS url, count(l.toxic) AS toxic
    FROM docs d LEFT JOIN pages p ON p.page_id = d.tweet_id LEFT JOIN labels l ON l.doc_id = d.tweet_id""",
)
def field_presence(t):
    """How many records carry each field."""
    rows = (
        t.docs.join(t.pages.drop("html"), F.col("tweet_id") == F.col("page_id"), "left")
        .join(t.table("labels"), F.col("tweet_id") == F.col("doc_id"), "left")
    )
    return rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in ("body", "title", "url", "toxic")])


@query(
    "newspaper_lists",
    """SELECT "user", count(*) AS n FROM articles WHERE "user" IN ('1-URGENT', '2-HIGH') AND "user" NOT IN ('2-HIGH') GROUP BY 1""",
)
def newspaper_lists(t):
    return A.count_by(t.articles.where(P.newspapers(["1-URGENT", "2-HIGH"], ["2-HIGH"])), "user")


@query(
    "newspapers_barred",
    """SELECT "user", count(*) AS n FROM articles WHERE "user" NOT IN ('2-HIGH') GROUP BY 1""",
)
def newspapers_barred(t):
    return A.count_by(t.articles.where(P.newspapers(barred=["2-HIGH"])), "user")


@query(
    "old_notes",
    "SELECT tweet_id, created_at FROM articles WHERE created_at < TIMESTAMP '1996-01-01' ORDER BY created_at, tweet_id",
)
def old_notes(t):
    return t.articles.where(P.before(dt.datetime(1996, 1, 1))).select("tweet_id", "created_at").orderBy("created_at", "tweet_id")


@query(
    "recent_of_users",
    """SELECT tweet_id, "user" FROM articles WHERE "user" IN ('1-URGENT', '3-MEDIUM') AND created_at >= TIMESTAMP '2001-01-01'""",
)
def recent_of_users(t):
    keep = P.by_users(["1-URGENT", "3-MEDIUM"]) & P.since(dt.datetime(2001, 1, 1))
    return t.articles.where(keep).select("tweet_id", "user").orderBy("tweet_id")


@query("user_and_title", "SELECT tweet_id FROM docs WHERE \"user\" = 'src3' AND title <> '' ORDER BY created_at, tweet_id")
def user_and_title(t):
    return t.docs.where((F.col("user") == "src3") & ~P.is_empty("title")).orderBy("created_at", "tweet_id").select("tweet_id")


@query(
    "user_title_lookup",
    """
    SELECT tweet_id, title FROM docs WHERE "user" = 'src3'
      AND title = (SELECT title FROM docs WHERE "user" = 'src3' ORDER BY created_at, tweet_id LIMIT 1)""",
)
def user_title_lookup(t):
    """All posts of a newspaper that have the title of its oldest one."""
    oldest = t.docs.where(F.col("user") == "src3").orderBy("created_at", "tweet_id").limit(1).select("title").scalar()
    return t.docs.where(P.titled("src3", oldest)).select("tweet_id", "title")


@query(
    "newest_per_user",
    """
    SELECT "user", tweet_id, created_at, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY created_at DESC, tweet_id) AS rank FROM articles) WHERE rank <= 30""",
)
def newest_per_user(t):
    return newest_per(t.articles, ["user"], [F.desc("created_at"), F.col("tweet_id")], 30).select("user", "tweet_id", "created_at", "rank")


@query("newest_n", "SELECT tweet_id, created_at FROM articles ORDER BY created_at DESC, tweet_id LIMIT 50")
def newest_n(t):
    return S.newest(t.articles.select("tweet_id", "created_at"), 50, "tweet_id")


@query("oldest_first", "SELECT tweet_id, created_at FROM articles ORDER BY created_at, tweet_id LIMIT 1")
def oldest_first(t):
    return S.oldest(t.articles.select("tweet_id", "created_at"), 1, "tweet_id")


@query(
    "shuffled_of_users",
    """
    SELECT tweet_id FROM articles WHERE "user" IN ('2-HIGH', '5-LOW') ORDER BY md5(concat(CAST(tweet_id AS VARCHAR), '7')), tweet_id LIMIT 100""",
)
def shuffled_of_users(t):
    return S.random_rows(t.articles.where(P.by_users(["2-HIGH", "5-LOW"])).select("tweet_id"), "tweet_id", 100, 7)
