"""Closing threads upward and checking for removed posts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import model
from threadloom.operators import filters as P
from threadloom.operators import threads as G
from threadloom.session import materialise
from threadloom.sources.readers import payloads
from threadloom.sources.writers import absent_errors, updated


@dataclass
class Round:
    """What one lookup round adds. The store itself is not rewritten: these three tables are as
    small as the round's answers, and the next round reads the store together with them."""

    outcomes: DataFrame
    found: DataFrame
    errors: DataFrame
    marked: DataFrame


def lookup_round(posts: DataFrame, errors: DataFrame, marked: DataFrame | None, responses: DataFrame) -> Round:
    """Look up the parents waiting: save what was found, record what failed, mark the replies of both."""
    pending = G.pending_replies(posts, marked)
    outcomes = materialise(G.epoch_outcomes(G.upstream_frontier(pending, errors), responses, posts), "outcomes")
    found = payloads(outcomes.where("outcome = 'found'"))
    # A parent that is itself a reply waits for its own parent in the next round.
    found = found.withColumn("look_for_upstream", F.coalesce(F.col(G.PARENT) != 0, F.lit(False)))
    # One answer per parent, and no parent with an error was asked for: nothing to look for in the store.
    failed = outcomes.where("outcome = 'error'").select("message", "api_code", F.col("id").alias("tweet_id"))
    return Round(outcomes, found.select(*posts.columns), failed, G.resolved_replies(pending, outcomes))


def settled_posts(posts: DataFrame, found: DataFrame, marked: DataFrame) -> DataFrame:
    """The store with the found posts, the pending flag of marked replies cleared."""
    settled = marked.select("id", F.lit(False).alias("look_for_upstream"))
    return updated(posts.unionByName(found), settled, "id", ["look_for_upstream"])


def close_upward(posts: DataFrame, errors: DataFrame, marked: DataFrame | None, responses: DataFrame) -> Round:
    """All that repeated rounds over ``responses`` would add, whatever the depth; ``outcomes`` has the level of each.

    The answers are judged once against the store. Which of them would be asked for is worked out along
    their own parent edges, by doubling.
    """
    pending = G.pending_replies(posts, marked)
    asked = P.without_keys(responses.select("id").distinct(), errors, "id", "tweet_id")
    judged = materialise(G.epoch_outcomes(asked, responses, posts), "judged")
    up = judged.where("outcome = 'found'").select("id", F.from_json("payload", model.POST)[G.PARENT].alias("up"))
    reached = G.answers_upward(G.upstream_frontier(pending, errors), up.where("up <> 0"))
    outcomes = materialise(judged.join(reached, "id"), "outcomes")
    found = payloads(outcomes.where("outcome = 'found'"))
    found = found.withColumn("look_for_upstream", F.coalesce(F.col(G.PARENT) != 0, F.lit(False))).select(*posts.columns)
    failed = outcomes.where("outcome = 'error'").select("message", "api_code", F.col("id").alias("tweet_id"))
    waiting = pending.select("id", G.PARENT).unionByName(G.pending_replies(found).select("id", G.PARENT))
    return Round(outcomes, found, failed, materialise(G.resolved_replies(waiting, outcomes), "marked"))


@dataclass
class Kept:
    """What earlier batches have left, looked up by key: each function is given the ids it is asked about."""

    known: Callable[[DataFrame], DataFrame]  # ids of posts in the store
    failed: Callable[[DataFrame], DataFrame]  # tweet_id of recorded errors
    settled: Callable[[DataFrame], DataFrame]  # ids found or failed in earlier batches
    answers: Callable[[DataFrame], DataFrame]  # answers nobody has asked for so far
    waiting: Callable[[DataFrame], DataFrame]  # id and parent of replies that wait for one of the ids


def close_by_deltas(pending: DataFrame, answers: DataFrame, kept: Kept) -> tuple[Round, DataFrame]:
    """What one batch adds, met with the rest by its own ids alone; and the replies that wait from now on.

    ``pending`` are the replies (id, parent) that began to wait since the last batch, ``answers`` those that
    landed since. New answers are joined with the replies kept waiting, new replies with the answers kept.
    What is reached along the batch's own answers is worked out by doubling; every parent reached beyond them is
    asked of the answers kept, until a round reaches none.
    """
    new_parents = P.without_keys(pending.select(F.col(G.PARENT).alias("id")).distinct(), kept.failed(pending.select(F.col(G.PARENT).alias("id"))), "id", "tweet_id")
    landed = answers.select("id").distinct()
    awaited = P.only_keys(landed, kept.waiting(landed), "id", G.PARENT)
    active = materialise(new_parents.unionByName(awaited).distinct(), "active")
    seen, n = active, active.count()
    pool = materialise(answers.unionByName(P.only_keys(kept.answers(active), active, "id").select(*answers.columns)), "pool")
    while True:
        ids = materialise(pool.select("id").distinct(), "pool-ids")
        asked = P.without_keys(P.without_keys(ids, kept.settled(ids), "id"), kept.failed(ids), "id", "tweet_id")
        judged = materialise(G.epoch_outcomes(asked, pool, kept.known(ids)), "judged")
        up = judged.where("outcome = 'found'").select("id", F.from_json("payload", model.POST)[G.PARENT].alias("up"))
        reached = materialise(G.answers_upward(active, up.where("up <> 0")).select("id"), "reached")
        now = reached.count()
        if now == n:
            break
        frontier = materialise(P.without_keys(reached, seen, "id"), "frontier")
        more = materialise(P.only_keys(kept.answers(frontier), frontier, "id").select(*pool.columns), "more-answers")
        if more.isEmpty():
            break
        seen, n, pool = reached, now, pool.unionByName(more)
    outcomes = materialise(P.only_keys(judged, reached, "id"), "outcomes")
    found = payloads(outcomes.where("outcome = 'found'"))
    found = found.withColumn("look_for_upstream", F.coalesce(F.col(G.PARENT) != 0, F.lit(False))).select(*[f.name for f in model.POST.fields])
    failed = outcomes.where("outcome = 'error'").select("message", "api_code", F.col("id").alias("tweet_id"))
    waits = materialise(pending.select("id", G.PARENT).unionByName(G.pending_replies(found).select("id", G.PARENT)), "waits")
    before = kept.waiting(outcomes.select("id")).select("id", G.PARENT)
    marked = materialise(G.resolved_replies(before.unionByName(waits), outcomes).distinct(), "marked")
    return Round(outcomes, found, failed, marked), waits


def resolve_upstream(
    posts: DataFrame, errors: DataFrame, responses: DataFrame
) -> tuple[DataFrame, DataFrame, list[dict[str, int]]]:
    """The store and the errors once no round finds or records anything new, and what each round would have added."""
    step = close_upward(posts, errors, None, responses)
    rounds = step.outcomes.groupBy("level").agg(
        F.count_if(F.col("outcome") == "found").alias("new_tweets"), F.count_if(F.col("outcome") == "error").alias("new_errors")
    )
    summaries = [r.asDict() for r in rounds.where("new_tweets + new_errors > 0").orderBy("level").drop("level").collect()]
    summaries.append({"new_tweets": 0, "new_errors": 0})
    return settled_posts(posts, step.found, step.marked), errors.unionByName(step.errors), summaries


def check_removed(posts: DataFrame, errors: DataFrame, responses: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """All posts with their check time, all errors with the new ones."""
    stamps, failed = G.recheck(posts, errors, responses, now)
    return (
        updated(posts, stamps, "id", ["last_checked_for_errors"]),
        errors.unionByName(absent_errors(failed, errors).select(*[f.name for f in model.API_ERROR.fields])),
    )


def apply_labels(posts: DataFrame, labels: DataFrame, order: list[Column]) -> DataFrame:
    """All posts, the flags of the labelled ones set by their last label."""
    return updated(posts, G.latest_labels(labels, order), "id", ["interesting", "checked"])
