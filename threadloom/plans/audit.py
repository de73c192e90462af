"""Auditing a release against the one before and against the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import aggregates as A
from threadloom.operators import distributions as D
from threadloom.operators import filters as P
from threadloom.operators.threads import PARENT


def lost_ids(new: DataFrame, old: DataFrame, user: str | None = None) -> DataFrame:
    """Articles of the old release that the new one lacks."""
    old = old if user is None else old.where(F.col("user") == user)
    return P.without_keys(old.select("tweet_id").distinct(), new, "tweet_id")


def kept_ids(new: DataFrame, old: DataFrame) -> DataFrame:
    return P.only_keys(old.select("tweet_id").distinct(), new, "tweet_id")


def membership(ids: DataFrame, release: DataFrame) -> DataFrame:
    """How many listed ids a release holds and lacks; the list may repeat ids and each entry counts."""
    listed = ids.where(F.col("tweet_id").isNotNull()).groupBy("tweet_id").agg(F.count(F.lit(1)).alias("n"))
    held = release.select(F.col("tweet_id").alias("_held")).distinct()
    marked = listed.join(held, F.col("tweet_id") == F.col("_held"), "left")
    held_n = F.sum(F.when(F.col("_held").isNotNull(), F.col("n")).otherwise(0))
    return marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_ids"),
        F.coalesce(held_n, F.lit(0)).alias("n_held"),
        F.coalesce(F.sum("n") - held_n, F.lit(0)).alias("n_missing"),
    )


def unreleased_roots(posts: DataFrame, release: DataFrame, account: str) -> DataFrame:
    """Root posts of an account that the release lacks, to be listed newest first."""
    roots = posts.where((F.col("user_name") == account) & F.col(PARENT).isNull() & F.col("retweeted_status").isNull())
    return P.without_keys(roots, release, "id", "tweet_id")


def quality_counts(articles: DataFrame) -> DataFrame:
    """Empty and missing bodies and titles, one row."""
    return articles.agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.count_if(P.is_empty("body")).alias("empty_bodies"),
        F.count_if(P.absent("body")).alias("no_bodies"),
        F.count_if(P.is_empty("title")).alias("empty_titles"),
        F.count_if(P.not_empty("body")).alias("with_body"),
    )


def audit_release(
    new: DataFrame, new_counts: DataFrame, old: DataFrame, barred: list[str] | None = None
) -> dict[str, DataFrame]:
    """The tables of a release audit. ``new_counts`` holds (tweet_id, n_comments)."""
    seen = new.where(P.newspapers(barred=barred or []))
    return {
        "totals": A.comment_totals(new, new_counts),
        "range": A.date_range(new),
        "diff": A.release_diff(new, old),
        "lost_counts": A.lost_counts(new, old),
        "lost_ids": lost_ids(new, old),
        "quality": quality_counts(new),
        "dates": A.dates_by_user(seen),
        "density": D.date_density(seen),
    }


def side_by_side(new: DataFrame, old: DataFrame, new_name: str, old_name: str) -> DataFrame:
    """Two releases as one table with their name, for overlaid series."""
    return new.withColumn("release", F.lit(new_name)).unionByName(old.withColumn("release", F.lit(old_name)))


def audit_titles(articles: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
    return {"counts": A.title_counts(articles), "repeats": A.title_repeats(articles, counts)}
