"""Counts, comparisons of releases, titles, scores, votes and term yield.

Every aggregate here has a map-side partial form; nothing collects a group into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as X
from threadloom.functions import text as TX
from threadloom.model import CATEGORIES


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def date_range(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


def dates_by_user(articles: DataFrame) -> DataFrame:
    return articles.groupBy("user", F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def comment_totals(articles: DataFrame, counts: DataFrame) -> DataFrame:
    """Articles and comments per newspaper with a grand total row (``user`` null).

    ``counts`` has (tweet_id, n_comments): comments counted per article beforehand, so that both sides
    of the join are unique by key and no parent is hot.
    """
    joined = articles.select("tweet_id", "user").join(counts, "tweet_id", "left")
    return joined.rollup("user").agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.coalesce(F.sum("n_comments"), F.lit(0)).alias("n_comments"),
        F.grouping("user").cast("long").alias("is_total"),
    )


def reply_counts(replies: DataFrame, parent: str) -> DataFrame:
    """Replies per parent; null and 0 parents are dropped before they can form one huge group."""
    known = replies.where(F.col(parent).isNotNull() & (F.col(parent) != 0))
    return known.groupBy(F.col(parent).alias("parent_id")).agg(F.count(F.lit(1)).alias("n_replies"))


def release_diff(new: DataFrame, old: DataFrame, key: str = "user") -> DataFrame:
    """Count now and before, difference and ratio in percent; the ratio is null for a new key."""
    now = new.groupBy(key).agg(F.count(F.lit(1)).alias("n_new"))
    then = old.groupBy(key).agg(F.count(F.lit(1)).alias("n_old"))
    both = now.join(then, key, "full_outer").select(
        key, F.coalesce("n_new", F.lit(0)).alias("n_new"), F.coalesce("n_old", F.lit(0)).alias("n_old")
    )
    return both.withColumn("diff", F.col("n_new") - F.col("n_old")).withColumn(
        "ratio", X.percent(F.col("n_new"), F.nullif(F.col("n_old"), F.lit(0)))
    )


def lost_counts(new: DataFrame, old: DataFrame, key: str = "user") -> DataFrame:
    """How many fewer each key has now: the positive part of old minus new."""
    return release_diff(new, old, key).where("n_old > n_new").select(key, (-F.col("diff")).alias("lost"))


def title_counts(articles: DataFrame) -> DataFrame:
    """Distinct titles and articles per newspaper."""
    per_title = articles.groupBy("user", "title").agg(F.count(F.lit(1)).alias("n"))
    return per_title.groupBy("user").agg(
        F.count("title").alias("n_titles"), F.sum("n").alias("n_articles")
    )


def title_repeats(
    articles: DataFrame, counts: DataFrame, too_many: int = 20, at_least: int = 2, over_days: int = 2
) -> DataFrame:
    """Repeated titles per newspaper: ``too much`` from ``too_many`` on, else reported when spread over days."""
    joined = articles.select("tweet_id", "user", "title", "created_at").join(counts, "tweet_id", "left")
    grouped = joined.groupBy("user", "title").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.coalesce(F.sum("n_comments"), F.lit(0)).alias("n_comments"),
    )
    days = X.whole_days(F.col("first_at"), F.col("last_at"))
    verdict = F.when(F.col("n") >= too_many, "too much").when(
        (F.col("n") >= at_least) & (F.col("days") > over_days), "report"
    )
    return (
        grouped.withColumn("days", days)
        .withColumn("verdict", verdict)
        .where(F.col("verdict").isNotNull())
        .drop("first_at", "last_at")
    )


def article_scores(comments: DataFrame, parent: str, score: Column, threshold: float = 0.5) -> DataFrame:
    """Per article: comments, those strictly over the threshold, and the mean score."""
    return comments.groupBy(F.col(parent).alias("tweet_id")).agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(score > threshold).alias("n_over"),
        F.avg(score).alias("mean_value"),
    )


def nested_scores(nested: DataFrame, key: str = "tweet_id", comments: str = "comments", threshold: float = 0.5) -> DataFrame:
    """The same three numbers per article from nested blocks, without exploding them: every block is added up."""
    scores = F.filter(F.transform(comments, lambda c: c["hateful_value"]), lambda v: v.isNotNull())
    blocks = nested.select(
        key,
        F.size(comments).cast("long").alias("n_comments"),
        F.size(F.filter(scores, lambda v: v > threshold)).cast("long").alias("n_over"),
        F.size(scores).alias("_scored"),
        F.aggregate(scores, F.lit(0.0), lambda a, v: a + v).alias("_sum"),
    )
    return blocks.groupBy(key).agg(
        F.sum("n_comments").alias("n_comments"),
        F.sum("n_over").alias("n_over"),
        F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("mean_value"),
    )


def most_voted(sizes: dict[str, Column] | None = None) -> dict[str, Column]:
    """Highest vote count and the categories that reach it, ties kept in category order."""
    sizes = sizes or {c: F.size(c) for c in CATEGORIES}
    top = F.greatest(*[n.cast("long") for n in sizes.values()])
    named = F.array(*[F.when(n.cast("long") == top, F.lit(c)) for c, n in sizes.items()])
    return {"max_votes": top, "most_voted": F.array_compact(named)}


def term_counts(docs: DataFrame, text: Column | str, terms: Sequence[str]) -> DataFrame:
    """Documents per search term, zeros included, in one pass over the texts."""
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(enumerate(terms, 1)), "position int, term string")
    hits = docs.select(F.explode(TX.matched_positions(text, terms)).alias("position"))
    counted = hits.groupBy("position").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counted, "position", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def term_yield(docs: DataFrame, text: Column | str, terms: Sequence[str], over: int = 500) -> DataFrame:
    """Documents found by the first i terms, what the i-th adds, and whether that is more than ``over``.

    One pass: every document counts at the first listed term it holds, then a running sum over the
    table of terms. The window has no partition because that table is as long as the term list.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(enumerate(terms, 1)), "position int, term string")
    first = docs.select(TX.first_position(text, terms).alias("position")).where(F.col("position").isNotNull())
    counted = first.groupBy("position").agg(F.count(F.lit(1)).alias("gain"))
    running = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return (
        listed.join(counted, "position", "left")
        .withColumn("gain", F.coalesce("gain", F.lit(0)))
        .withColumn("found", F.sum("gain").over(running))
        .withColumn("changes", (F.abs("gain") > over) & (F.col("position") > 1))
    )
