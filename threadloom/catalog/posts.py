"""Posts, errors, replies and the thread graph."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from threadloom.operators.groups import block_totals
from threadloom.catalog.registry import query, sql_tokens
from threadloom.operators import filters as P
from threadloom.operators import threads as G
from threadloom.operators.aggregates import reply_counts
from threadloom.operators.groups import first_wins
from threadloom.plans import audit, upstream
from threadloom.plans.articles import comments_of, with_comments
from threadloom.plans.kept_roots import RootTable
from threadloom.session import run_dir
from threadloom.sources import writers
from threadloom.sources.buckets import BucketStore


@query("replies_only", "SELECT user_name, count(*) AS n FROM threads WHERE parent IS NOT NULL GROUP BY 1")
def replies_only(t):
    return t.threads.where(P.kept_by_worker(True)).groupBy("user_name").agg(F.count(F.lit(1)).alias("n"))


@query("all_kept", "SELECT user_name, count(*) AS n FROM threads GROUP BY 1")
def all_kept(t):
    return t.threads.where(P.kept_by_worker(False)).groupBy("user_name").agg(F.count(F.lit(1)).alias("n"))


@query("root_posts", "SELECT id, user_name FROM threads WHERE parent IS NULL")
def root_posts(t):
    return t.threads.where(P.is_root()).select("id", "user_name")


@query("flags_false", "SELECT id FROM threads WHERE user_name <> 'assistant'")
def flags_false(t):
    return t.threads.where(P.unlabelled()).select("id")


@query("flagged_roots", "SELECT id FROM linked WHERE flagged")
def flagged_roots(t):
    return t.linked.where(P.is_root() & P.hate_flagged()).select("id")


@query(
    "array_sizes",
    """
    SELECT count(*) FILTER (n = 0) AS none, count(*) FILTER (n > 5) AS more_than_5, count(*) FILTER (n >= 11) AS has_eleventh
    FROM (SELECT a.tweet_id, count(c.text) AS n FROM articles a LEFT JOIN comments c ON c.article_id = a.tweet_id GROUP BY 1)""",
)
def array_sizes(t):
    rows = with_comments(t.articles, t.comments, 5)
    rows = block_totals(rows, "tweet_id", n=F.sum(F.size("comments")))
    return rows.agg(F.count_if(F.col("n") == 0).alias("none"), F.count_if(F.col("n") > 5).alias("more_than_5"), F.count_if(F.col("n") > 10).alias("has_eleventh"))


@query(
    "unscored_articles",
    """
    SELECT a.tweet_id FROM articles a WHERE NOT EXISTS (
      SELECT 1 FROM comments c WHERE c.article_id = a.tweet_id AND c.score > 0)""",
)
def unscored_articles(t):
    """Articles none of whose comments has a score; a discount of 0 stands for no score."""
    comments = t.comments.withColumn("hateful_value", F.when(F.col("score") > 0, F.col("hateful_value")))
    blocks = with_comments(t.articles, comments, 5)
    return block_totals(blocks, "tweet_id", unscored=F.bool_and(P.unscored())).where("unscored").select("tweet_id")


@query("point_lookup", "SELECT tweet_id, \"user\" FROM articles WHERE tweet_id IN (SELECT tweet_id FROM errors)")
def point_lookup(t):
    return P.only_keys(t.articles, t.errors, "tweet_id").select("tweet_id", "user")


@query("screen_names", """SELECT DISTINCT lower(query[2:]) AS user_name FROM live WHERE query IS NOT NULL""")
def screen_names(t):
    return G.screen_names(t.live)


@query(
    "replies_gt5",
    """
    SELECT o_orderkey + 1 AS id, n_comments AS n_replies FROM orders
    JOIN comment_counts ON tweet_id = o_orderkey WHERE n_comments > 5""",
)
def replies_gt5(t):
    roots = t.store.where(P.is_root())
    return G.with_many_replies(t.store, 5, roots).select("id", "n_replies")


@query(
    "with_replies",
    "SELECT tweet_id FROM articles WHERE tweet_id IN (SELECT article_id FROM comments) AND tweet_id <> 0",
)
def with_replies(t):
    return P.only_keys(t.articles, reply_counts(t.comments, "article_id"), "tweet_id", "parent_id").select("tweet_id")


@query("unchecked", "SELECT tweet_id AS id FROM articles WHERE tweet_id NOT IN (SELECT tweet_id FROM errors)")
def unchecked(t):
    return G.without_errors(t.articles.select(F.col("tweet_id").alias("id")), t.errors)


@query(
    "removed_posts",
    """
    SELECT e.tweet_id, e.api_code, a."user" FROM errors e JOIN articles a ON a.tweet_id = e.tweet_id WHERE e.api_code = 42""",
)
def removed_posts(t):
    posts = t.articles.select(F.col("tweet_id").alias("id"), "user")
    return G.removed_posts(posts, t.errors, 42).select("tweet_id", "api_code", "user")


@query("posts_with_code", "SELECT tweet_id AS id FROM articles WHERE tweet_id IN (SELECT tweet_id FROM errors WHERE api_code = 42)")
def posts_with_code(t):
    return G.posts_with_code(t.articles.select(F.col("tweet_id").alias("id")), t.errors, 42)


@query("candidate_errors", "SELECT tweet_id, api_code FROM errors WHERE tweet_id IN (SELECT parent FROM threads WHERE parent IS NOT NULL)")
def candidate_errors(t):
    wanted = G.pending_replies(t.threads)
    return P.only_keys(t.errors, wanted, "tweet_id", P.PARENT).select("tweet_id", "api_code")


FRONTIER = """
    SELECT DISTINCT parent AS id FROM caught WHERE parent IS NOT NULL AND parent NOT IN (SELECT tweet_id FROM errors)"""


@query("upstream_frontier", FRONTIER)
def upstream_frontier(t):
    return G.upstream_frontier(G.pending_replies(t.caught), t.errors)


@query(
    "frontier_counts",
    f"""
    SELECT (SELECT count(DISTINCT parent) FROM caught) AS n_pending, (SELECT count(*) FROM ({FRONTIER})) AS n_without_errors""",
)
def frontier_counts(t):
    return G.frontier_counts(t.caught, t.errors)


@query("parents_known", "SELECT id FROM caught WHERE id IN (SELECT parent FROM threads WHERE parent IS NOT NULL)")
def parents_known(t):
    return P.only_keys(t.caught, t.threads.where(P.is_reply()), "id", P.PARENT).select("id")


OUTCOMES = f"""
    SELECT f.id, CASE WHEN p.user_name = 'system' THEN 'error' WHEN p.user_name = 'user' THEN 'refused' ELSE 'found' END AS outcome
    FROM ({FRONTIER}) f JOIN threads p ON p.id = f.id"""


@query("epoch_outcomes", OUTCOMES)
def epoch_outcomes(t):
    frontier = G.upstream_frontier(G.pending_replies(t.caught), t.errors)
    return G.epoch_outcomes(frontier, t.responses, t.caught).select("id", "outcome")


@query(
    "epoch_summary",
    f"SELECT count(*) FILTER (outcome = 'found') AS new_tweets, count(*) FILTER (outcome = 'error') AS new_errors FROM ({OUTCOMES})",
)
def epoch_summary(t):
    return G.epoch_summary(upstream.lookup_round(t.caught, t.errors, None, t.responses).outcomes)


@query(
    "upstream_epoch",
    f"""
    SELECT id, parent IS NOT NULL AND coalesce(parent NOT IN (SELECT id FROM ({OUTCOMES}) WHERE outcome <> 'refused'), true) AS look_for_upstream
    FROM caught
    UNION ALL SELECT p.id, p.parent IS NOT NULL FROM threads p JOIN ({OUTCOMES}) o ON o.id = p.id WHERE o.outcome = 'found'""",
)
def upstream_epoch(t):
    """The store after one round."""
    step = upstream.lookup_round(t.caught, t.errors, None, t.responses)
    return upstream.settled_posts(t.caught, step.found, step.marked).select("id", "look_for_upstream")


@query(
    "epoch_errors",
    f"""
    SELECT tweet_id, api_code FROM errors
    UNION ALL SELECT id, 422 FROM ({OUTCOMES}) WHERE outcome = 'error'""",
)
def epoch_errors(t):
    step = upstream.lookup_round(t.caught, t.errors, None, t.responses)
    return t.errors.unionByName(step.errors).select("tweet_id", "api_code")


@query(
    "upstream_closed",
    """
    WITH RECURSIVE reached AS (
      SELECT p.id, p.parent FROM threads p JOIN caught c ON c.parent = p.id
      WHERE p.user_name = 'assistant' AND p.id NOT IN (SELECT tweet_id FROM errors)
      UNION
      SELECT p.id, p.parent FROM threads p JOIN reached r ON r.parent = p.id
      WHERE p.user_name = 'assistant' AND p.id NOT IN (SELECT tweet_id FROM errors)),
    final AS (SELECT id, parent FROM caught UNION ALL SELECT id, parent FROM reached),
    settled AS (SELECT id FROM reached UNION ALL
      SELECT id FROM threads WHERE user_name = 'system' AND id NOT IN (SELECT tweet_id FROM errors))
    SELECT id, parent IS NOT NULL AND coalesce(parent NOT IN (SELECT id FROM settled), true) AS look_for_upstream FROM final""",
)
def upstream_closed(t):
    """The store once no round finds anything new."""
    posts, _, _ = upstream.resolve_upstream(t.caught, t.errors, t.responses)
    return posts.select("id", "look_for_upstream")


ROOTS_SQL = """
    WITH RECURSIVE chain AS (
      SELECT id, id AS root_id, CAST(0 AS BIGINT) AS depth FROM threads WHERE parent IS NULL
      UNION ALL
      SELECT c.id, p.root_id, p.depth + 1 FROM threads c JOIN chain p ON c.parent = p.id)
    SELECT id, root_id, depth FROM chain"""


@query("thread_roots", ROOTS_SQL)
def thread_roots(t):
    return G.thread_roots(t.threads)


@query(
    "orphan_roots",
    """
    WITH RECURSIVE chain AS (
      SELECT id, id AS root_id, CAST(0 AS BIGINT) AS depth FROM caught
      WHERE parent IS NULL OR parent NOT IN (SELECT id FROM caught)
      UNION ALL
      SELECT c.id, p.root_id, p.depth + 1 FROM caught c JOIN chain p ON c.parent = p.id)
    SELECT id, root_id, depth FROM chain""",
)
def orphan_roots(t):
    """Only the caught posts: chains whose top is not in the store keep their topmost known post."""
    return G.thread_roots(t.caught)


@query("roots_kept", ROOTS_SQL)
def roots_kept(t):
    """Roots added batch by batch, the ends of the threads first."""
    table = RootTable(t.spark, run_dir(t.spark, "kept-roots"), buckets=8)
    turn = (F.col("id") - 100) % 100
    for number, part in enumerate([turn >= 2, turn < 2]):
        table.add(t.threads.where(part), number)
    return table.read()


@query(
    "scored_replies",
    """
    SELECT parent AS article_id, id AS tweet_id, CAST(length(text) AS DOUBLE) AS hateful_value
    FROM threads WHERE parent IN (SELECT id FROM threads WHERE parent IS NULL)""",
)
def scored_replies(t):
    """Replies to root posts, scored by a function of their text."""
    roots = t.threads.where(F.col(P.PARENT).isNull()).select(F.col("id").alias("tweet_id"))
    return comments_of(t.threads, roots, scorer=F.char_length).select("article_id", "tweet_id", "hateful_value")


@query("direct_replies", "SELECT id, parent FROM threads WHERE parent IN (SELECT id FROM caught)")
def direct_replies(t):
    return G.direct_replies(t.threads, t.caught).select("id", F.col(P.PARENT).alias("parent"))


@query(
    "accused_posts",
    f"""
    SELECT id FROM threads WHERE parent IS NULL AND user_name <> 'system' AND id IN (
      SELECT parent FROM threads WHERE length(text) < 600 AND list_has_any({sql_tokens('text')}, ['de', 'the', 'und']))""",
)
def accused_posts(t):
    official = t.threads.where(F.col("user_name") == "system")
    return G.accused_posts(t.threads, "de the Und", 600, official).select("id")


@query(
    "label_sample",
    """
    SELECT o_orderkey + 1 AS id, n_comments AS n_replies FROM orders JOIN comment_counts ON tweet_id = o_orderkey
    WHERE o_orderstatus = 'O' AND n_comments > 5
      AND lower(o_orderpriority) IN (SELECT lower(o_orderpriority) FROM orders WHERE o_orderstatus = 'P')
    ORDER BY md5(concat(CAST(o_orderkey + 1 AS VARCHAR), '1')), o_orderkey LIMIT 100""",
)
def label_sample(t):
    return G.label_candidates(t.store, G.screen_names(t.store)).select("id", "n_replies")


@query(
    "labels_applied",
    """
    SELECT o.o_orderkey + 1 AS id, coalesce(l.interesting, o.o_orderstatus = 'P') AS interesting,
           CASE WHEN l.id IS NOT NULL THEN true ELSE o.o_orderstatus = 'F' END AS checked
    FROM orders o LEFT JOIN (
      SELECT l_orderkey AS id, l_returnflag = 'R' AS interesting FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) = 1) l
      ON l.id = o.o_orderkey""",
)
def labels_applied(t):
    order = [F.desc("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    posts = t.store.where(P.is_root())
    return upstream.apply_labels(posts, t.labels, order).select("id", "interesting", "checked")


def _lookups(t):
    """Orders as looked up again: open ones are there, finished ones gone, the others fail without a code."""
    status = F.col("text")
    return t.store.where(P.is_root()).select(
        "id",
        F.when(status == "O", F.lit("{}")).alias("payload"),
        F.when(status == "F", 422).alias("api_code"),
        F.when(status != "O", F.lit("gone")).alias("message"),
    )


@query(
    "recheck_stamps",
    """
    SELECT o_orderkey + 1 AS id, CASE WHEN o_orderstatus = 'O' AND o_orderkey + 1 NOT IN (SELECT tweet_id FROM errors)
           THEN TIMESTAMP '2024-02-01' END AS last_checked_for_errors FROM orders""",
)
def recheck_stamps(t):
    now = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    posts, _ = upstream.check_removed(t.store.where(P.is_root()), t.errors, _lookups(t), now)
    return posts.select("id", "last_checked_for_errors")


@query(
    "recheck_errors",
    """
    SELECT tweet_id, api_code FROM errors
    UNION ALL SELECT o_orderkey + 1, 422 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey + 1 NOT IN (SELECT tweet_id FROM errors)""",
)
def recheck_errors(t):
    now = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    _, errors = upstream.check_removed(t.store.where(P.is_root()), t.errors, _lookups(t), now)
    return errors.select("tweet_id", "api_code")


@query(
    "unreleased_roots",
    """
    SELECT id, created_at FROM linked WHERE user_name = 'src7' AND id NOT IN (SELECT tweet_id FROM news WHERE "user" <> '5-LOW')
    ORDER BY created_at DESC, id""",
)
def unreleased_roots(t):
    release = t.news.where(P.newspapers(barred=["5-LOW"]))
    return audit.unreleased_roots(t.linked, release, "src7").select("id", "created_at").orderBy(F.desc("created_at"), "id")


@query(
    "late_replies",
    """
    SELECT a.tweet_id, c.text, date_diff('day', a.created_at, c.created_at) AS days_late
    FROM articles a JOIN comments c ON c.article_id = a.tweet_id
    WHERE a.created_at < TIMESTAMP '1998-01-01' AND date_diff('day', a.created_at, c.created_at) > 365""",
)
def late_replies(t):
    old = t.articles.where(P.before(dt.datetime(1998, 1, 1)))
    rows = G.late_replies(old, t.comments, "article_id", "created_at", 365)
    return rows.select(F.col("article_id").alias("tweet_id"), "text", "days_late")


# ---- sinks


@query(
    "first_wins",
    """
    SELECT l_orderkey AS id, l_shipdate AS created_at, l_linenumber AS number FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""",
)
def first_wins_by_key(t):
    rows = first_wins(t.table("lineitem"), ["l_orderkey"], [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")])
    return rows.select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("created_at"), F.col("l_linenumber").alias("number")
    )


@query("insert_if_absent", "SELECT id, CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS run FROM live")
def insert_if_absent(t):
    """Half of the posts are stored, then all come again: the stored ones stay as they are."""
    order = [F.col("created_at")]
    first = t.live.where(F.col("created_at") < F.expr("timestamp_ntz'2024-01-16 00:00:00'")).withColumn("run", F.lit("first"))
    store = BucketStore(t.spark, run_dir(t.spark, "inserted"), first.schema, "id", buckets=16)
    store.insert(first, order)
    store.insert(t.live.unionByName(t.live).withColumn("run", F.lit("second")), order)
    return store.read().select("id", "run")


@query(
    "insert_errors",
    """
    SELECT tweet_id, api_code, message FROM (
      SELECT event_id AS tweet_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS api_code, event_type AS message FROM events
      WHERE event_type IN ('error', 'view') AND CAST(json_extract_string(props, '$.k') AS INTEGER) > 10)
    WHERE tweet_id NOT IN (SELECT tweet_id FROM errors)""",
)
def insert_errors(t):
    """Error and view events as new errors, numbers up to 10 as a missing code; errors are stored already."""
    code = F.get_json_object("props", "$.k").cast("int")
    new = t.table("events").where(F.col("event_type").isin("error", "view")).select(
        F.col("event_id").alias("tweet_id"), F.when(code > 10, code).alias("api_code"), F.col("event_type").alias("message")
    )
    return writers.absent_errors(new, t.errors).select("tweet_id", "api_code", "message")


@query(
    "update_by_key",
    """
    SELECT a.tweet_id, CASE WHEN e.tweet_id IS NULL THEN a."user" ELSE CAST(e.api_code AS VARCHAR) END AS "user"
    FROM articles a LEFT JOIN errors e ON e.tweet_id = a.tweet_id""",
)
def update_by_key(t):
    changes = t.errors.select("tweet_id", F.col("api_code").cast("string").alias("user"))
    store = BucketStore(t.spark, run_dir(t.spark, "articles"), t.articles.schema, "tweet_id", buckets=16)
    store.create(t.articles)
    store.update(changes, ["user"])
    return store.read().select("tweet_id", "user")
