"""The reply graph: frontier, resolution epochs, roots, and joins between posts, errors and replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import scalars as X
from threadloom.functions import text as TX
from threadloom.operators import filters as P
from threadloom.operators.aggregates import reply_counts
from threadloom.operators.groups import first_wins
from threadloom.operators.samples import random_rows
from threadloom.session import materialise

PARENT = P.PARENT


def screen_names(posts: DataFrame) -> DataFrame:
    """Accounts behind the track terms: distinct queries, at-sign dropped, lower case."""
    return posts.where(F.col("query").isNotNull()).select(X.screen_name("query").alias("user_name")).distinct()


def short_list(accounts: DataFrame) -> DataFrame:
    """Account names, distinct and written.

    A handful of accounts own all posts, so a shuffle of the posts by account would be all skew. Once
    the list is a file Spark knows its size and broadcasts it without moving the posts.
    """
    return materialise(accounts.select("user_name").distinct(), "accounts")


def direct_replies(posts: DataFrame, parents: DataFrame, key: str = "id") -> DataFrame:
    """Posts that answer one of ``parents``."""
    return P.only_keys(posts.where(P.is_reply()), parents, PARENT, key)


def with_many_replies(posts: DataFrame, more_than: int, among: DataFrame | None = None) -> DataFrame:
    """Posts with more than ``more_than`` replies: counted first, joined after, so no parent is hot."""
    counts = reply_counts(posts, PARENT).where(F.col("n_replies") > more_than)
    base = posts if among is None else among
    return base.join(counts, F.col("id") == F.col("parent_id")).drop("parent_id")


def without_errors(posts: DataFrame, errors: DataFrame) -> DataFrame:
    return P.without_keys(posts, errors, "id", "tweet_id")


def removed_posts(posts: DataFrame, errors: DataFrame, code: int = 422) -> DataFrame:
    """Errors of one code with author and text of the post they are about."""
    return errors.where(P.has_code(code)).join(posts, F.col("tweet_id") == F.col("id"))


def posts_with_code(posts: DataFrame, errors: DataFrame, code: int = 422) -> DataFrame:
    return P.only_keys(posts, errors.where(P.has_code(code)), "id", "tweet_id")


def pending_replies(posts: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """Replies whose parent is still to be looked up; ``marked`` holds ids settled since the flag was set."""
    waiting = posts.where(P.pending_upstream() & P.is_reply())
    return waiting if marked is None else P.without_keys(waiting, marked, "id")


def upstream_frontier(pending: DataFrame, errors: DataFrame) -> DataFrame:
    """Parents to look up: distinct parents of the waiting replies, less those that failed before."""
    return P.without_keys(pending.select(F.col(PARENT).alias("id")).distinct(), errors, "id", "tweet_id")


def frontier_counts(posts: DataFrame, errors: DataFrame) -> DataFrame:
    """Parents waiting, and those of them without a recorded error: one row."""
    wanted = pending_replies(posts).select(F.col(PARENT).alias("id")).distinct()
    failed = errors.select(F.col("tweet_id").alias("_key")).distinct()
    marked = wanted.join(failed, F.col("id") == F.col("_key"), "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_pending"), F.count_if(F.col("_key").isNull()).alias("n_without_errors")
    )


def epoch_outcomes(frontier: DataFrame, responses: DataFrame, known: DataFrame) -> DataFrame:
    """What one lookup round gives per parent: ``found``, ``error``, or ``refused`` (stays pending).

    A payload is saved unless the post is in the store already; an error is saved if it has a code.
    Of several answers for one id the first counts: a payload before an error, then by code and message.
    """
    answers = P.only_keys(responses, frontier, "id")
    answers = first_wins(
        answers, ["id"], [F.col("payload").isNull(), F.col("api_code").asc_nulls_last(), F.col("message"), F.col("payload")]
    )
    stored = P.only_keys(known.select("id"), answers, "id").distinct().select(F.col("id").alias("_stored"))
    outcome = (
        F.when(F.col("payload").isNotNull(), F.when(F.col("_stored").isNull(), "found").otherwise("refused"))
        .when(F.col("api_code").isNotNull(), "error")
        .otherwise("refused")
    )
    return answers.join(stored, F.col("id") == F.col("_stored"), "left").withColumn("outcome", outcome).drop("_stored")


def epoch_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count_if(F.col("outcome") == "found").alias("new_tweets"),
        F.count_if(F.col("outcome") == "error").alias("new_errors"),
    )


def resolved_replies(pending: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ids of the waiting replies whose parent was found or failed.

    The outcome side is unique by id and the replies are on the left of a semi join, so the replies of
    one hot parent are split over tasks by the adaptive skew join.
    """
    return P.only_keys(pending, outcomes.where(F.col("outcome").isin("found", "error")), PARENT, "id").select("id")


def answers_upward(frontier: DataFrame, edges: DataFrame, name: str = "reached") -> DataFrame:
    """``id`` and ``level`` of every post asked for when lookups climb from ``frontier`` along ``edges`` (id, up).

    Pointer doubling: with pointers 2^k levels up, everything within 2^k levels of the frontier reaches
    twice as far, so a chain of depth d takes log2(d) rounds; it ends when a round reaches nothing new. Only
    the edges of the answers are joined, never the store.
    """
    reached = materialise(frontier.select("id", F.lit(0).cast("long").alias("level")).distinct(), name)
    jumps = materialise(edges.select("id", "up").distinct(), name)
    step, n = 1, reached.count()
    while True:
        further = reached.join(jumps, "id").select(F.col("up").alias("id"), (F.col("level") + step).alias("level"))
        reached = materialise(reached.unionByName(further).groupBy("id").agg(F.min("level").alias("level")), name)
        now = reached.count()
        if now == n:
            return reached
        n, step = now, 2 * step
        above = jumps.select(F.col("id").alias("up"), F.col("up").alias("_above"))
        jumps = materialise(jumps.join(above, "up").select("id", F.col("_above").alias("up")), name)


def thread_roots(posts: DataFrame, name: str = "roots") -> DataFrame:
    """Topmost known ancestor and depth of every post, as (id, root_id, depth): one row per id.

    Pointer doubling: each round joins the rows still under way with the table of ancestors, so a
    thread of depth d takes log2(d) rounds, and rows that have reached their root leave. Each round
    is written to the shared folder. It ends when nobody is under way but posts on or below a cycle;
    these have no root: null root and depth. Of several rows with one id the first by parent counts.
    """
    posts = first_wins(posts.select("id", PARENT).where(F.col("id").isNotNull()), ["id"], [F.col(PARENT).asc_nulls_last()])
    posts = materialise(posts, name)
    ids = posts.select(F.col("id").alias("_known"))
    replies = posts.where(P.is_reply()).select("id", F.col(PARENT).alias("up"))
    first = posts.where(~F.coalesce(P.is_reply(), F.lit(False))).select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("depth"))
    linked = replies.join(ids, F.col("up") == F.col("_known"), "left")
    orphan = F.col("_known").isNull()
    linked = linked.select(
        "id", F.when(orphan, F.col("id")).otherwise(F.col("up")).alias("up"), F.when(orphan, 0).otherwise(1).cast("long").alias("depth")
    )
    state = materialise(first.unionByName(linked), name)
    finished = state.where("depth = 0")
    moving = state.where("depth > 0")
    while True:
        above = finished.unionByName(moving).select(
            F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_depth")
        )
        stepped = materialise(
            moving.join(above, F.col("up") == F.col("_id")).select(
                "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("_depth") == 0).alias("at_root")
            ),
            name,
        )
        arrived = stepped.where("at_root").drop("at_root")
        moving = stepped.where("not at_root").drop("at_root")
        finished = finished.unionByName(arrived)
        # Chains have no gaps: a round that brings nobody to a root leaves only cycles under way.
        if moving.isEmpty() or arrived.isEmpty():
            break
    resolved = finished.select("id", F.col("up").alias("root_id"), F.col("depth").cast("long").alias("depth"))
    cyclic = moving.select("id", F.lit(None).cast("long").alias("root_id"), F.lit(None).cast("long").alias("depth"))
    return resolved.unionByName(cyclic)


def accused_posts(posts: DataFrame, words: str, max_length: int, official: DataFrame | None = None) -> DataFrame:
    """Posts called out by short replies: root-level, without links or media."""
    accusing = posts.where(P.is_reply() & P.shorter_than("text", max_length) & TX.matches("text", words))
    targets = accusing.select(F.col(PARENT).alias("_target")).distinct()
    plain = posts.where(
        P.has_none("entities.urls") & P.absent("entities.media") & F.col("in_reply_to_user_id").isNull()
    )
    if official is not None:
        plain = P.without_keys(plain, short_list(official), "user_name")
    return plain.join(targets, F.col("id") == F.col("_target"), "left_semi")


def label_candidates(
    posts: DataFrame, accounts: DataFrame, n: int = 100, seed: int | str = 1, more_than: int = 5
) -> DataFrame:
    """Unlabelled root posts of the accounts with more than ``more_than`` replies, ``n`` at random."""
    roots = posts.where(P.unlabelled() & F.col(PARENT).isNull())
    roots = P.only_keys(roots, short_list(accounts), "user_name")
    return random_rows(with_many_replies(posts, more_than, roots), "id", n, seed)


def latest_labels(labels: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The last label per id, as the two flags: interesting or not, checked in both cases."""
    last = first_wins(labels, ["id"], order)
    return last.select("id", F.col("interesting"), F.lit(True).alias("checked"))


def recheck(posts: DataFrame, errors: DataFrame, responses: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Posts without errors are looked up again: (stamps for those still there, errors for the rest)."""
    # The store is narrowed to the few ids that were answered before anything else is done with it.
    asked = P.only_keys(posts.select("id"), responses, "id")
    answers = P.only_keys(responses, without_errors(asked, P.only_keys(errors, responses, "tweet_id", "id")), "id")
    stamps = answers.where(F.col("payload").isNotNull()).select("id", now.alias("last_checked_for_errors")).distinct()
    failed = answers.where(F.col("payload").isNull() & F.col("api_code").isNotNull())
    failed = first_wins(failed, ["id"], [F.col("api_code"), F.col("message")])
    return stamps, failed.select("message", "api_code", F.col("id").alias("tweet_id"))


def late_replies(
    articles: DataFrame, replies: DataFrame, parent: str, arrived: str, after_days: int
) -> DataFrame:
    """Replies that came more than ``after_days`` whole days after their article."""
    heads = articles.select(F.col("tweet_id").alias("_article"), F.col("created_at").alias("article_at"))
    joined = replies.join(heads, F.col(parent) == F.col("_article")).drop("_article")
    return joined.withColumn("days_late", X.whole_days(F.col("article_at"), F.col(arrived))).where(
        F.col("days_late") > after_days
    )
