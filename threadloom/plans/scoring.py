"""Scored comments: article tables, exports, numbered comments, annotated replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as TX
from threadloom.operators import aggregates as A
from threadloom.operators import filters as P
from threadloom.operators.groups import BLOCK_ROWS, nest_in_parts, number_within
from threadloom.session import materialise


def score_articles(
    articles: DataFrame,
    comments: DataFrame,
    score: Column,
    search: str | None = None,
    min_comments: int = 11,
    threshold: float = 0.5,
    min_mean: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """Articles with enough comments, their over-threshold count and mean score."""
    chosen = articles if search is None else articles.where(TX.matches(TX.searched_text("title", "text", "body"), search))
    scores = A.article_scores(comments, "article_id", score, threshold).where(F.col("n_comments") >= min_comments)
    if min_mean is not None:
        scores = scores.where(P.mean_at_least(min_mean, strict))
    return chosen.join(scores, "tweet_id")


def numbered_comments(comments: DataFrame, parent: str, order: list[str], score: Column, threshold: float = 0.5) -> DataFrame:
    """One row per comment with its place under the article and whether it is over the threshold."""
    numbered = number_within(comments, [parent], order)
    return numbered.withColumn("over", score > threshold)


def exploded_comments(release: DataFrame, threshold: float = 0.5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The same from nested comments in blocks of ``block_rows``; positions run through all blocks of an article."""
    return release.select(
        F.col("tweet_id").alias("article_id"), "part", F.posexplode("comments").alias("pos", "comment")
    ).select(
        "article_id",
        "part",
        (F.col("part") * block_rows + F.col("pos") + 1).cast("long").alias("position"),
        "comment.*",
        (F.col("comment.hateful_value") > threshold).alias("over"),
    )


def annotated_replies(
    annotations: DataFrame, posts: DataFrame, articles: DataFrame, min_votes: int = 2, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Comments with enough hate votes that have replies, with these, their article and top categories."""
    # Written, as annotations are few and three steps need these: their replies are pruned by a list of known size.
    hateful = materialise(annotations.where(P.votes_at_least(min_votes)).withColumns(A.most_voted()), "hateful")
    replies = P.only_keys(posts.where(P.is_reply()), hateful, P.PARENT, "tweet_id")
    replies = replies.select(P.PARENT, F.struct(F.col("id").alias("tweet_id"), "text").alias("reply"), "id", "text")
    nested = nest_in_parts(
        hateful, "tweet_id", replies, P.PARENT, F.col("reply"), ["id", "text"], "replies", block_rows
    ).where(F.size("replies") > 0)
    titles = articles.select(F.col("tweet_id").alias("_article"), F.col("title").alias("article_title"))
    return nested.join(titles, F.col("article_id") == F.col("_article")).drop("_article")


def unmatched_annotations(annotations: DataFrame, articles: DataFrame) -> DataFrame:
    """Comments whose article is not there, counted: one row."""
    return P.without_keys(annotations, articles, "article_id", "tweet_id").agg(F.count(F.lit(1)).alias("n_unmatched"))
