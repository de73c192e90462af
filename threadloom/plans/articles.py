"""Building and repairing articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import scalars as X
from threadloom.operators import filters as P
from threadloom.operators.extraction import BODY_RULES, extract_pages, repaired_bodies, rule_for
from threadloom.operators.groups import BLOCK_ROWS, first_wins, nest_in_parts
from threadloom.operators.threads import screen_names, short_list
from threadloom.sources.buckets import BUCKETS, BucketStore
from threadloom.sources.writers import updated


def news_posts(posts: DataFrame, accounts: DataFrame | None = None, flagged_only: bool = False) -> DataFrame:
    """Root posts of the newspapers; by default the newspapers are the accounts behind the track terms."""
    accounts = screen_names(posts) if accounts is None else accounts
    roots = posts.where(P.is_root())
    if flagged_only:
        roots = roots.where(P.hate_flagged())
    return P.only_keys(roots, short_list(accounts), "user_name")


def page_store(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketStore:
    """Landed pages in buckets of the links that lead to them."""
    return BucketStore(spark, path, T.StructType.fromDDL("page_key string, url string, html string"), "page_key", buckets)


def stored_pages(pages: DataFrame) -> DataFrame:
    """Pages as a page store holds them."""
    return pages.select(X.link_key("url").alias("page_key"), "url", "html")


def pages_near(store: BucketStore, posts: DataFrame) -> DataFrame:
    """The pages in the buckets that the first links of ``posts`` lead to: all pages these posts can have, and no folder more."""
    links = posts.select(X.link_key(X.first_link("entities.urls")).alias("page_key")).where(F.col("page_key").isNotNull())
    return store.near(links).select("url", "html")


def with_pages(posts: DataFrame, pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Every post with the landed page its first link points to; with ``rules``, also its title and body.

    Pages no post links to are dropped before any HTML is shuffled; of pages that differ in the
    fragment of their address alone, the first address counts. A page is read once per body rule, not
    once per post that links to it. Posts without a link get a key of their own instead of sharing the
    null key, which would put all of them into one task.
    """
    rule = F.lit(None).cast("string") if rules is None else rule_for("user.screen_name", rules)
    posts = posts.withColumn("link", X.first_link("entities.urls")).withColumn("_rule", F.coalesce(rule, F.lit("")))
    link = X.link_key("link")
    wanted = posts.where(F.col("link").isNotNull()).select(link.alias("_page_key"), "_rule").distinct()
    keyed = P.only_keys(pages.select("url", "html").withColumn("_page_key", X.link_key("url")), wanted, "_page_key")
    keyed = first_wins(keyed, ["_page_key"], [F.col("url"), F.xxhash64("html")])
    key = F.coalesce(link, F.concat(F.lit("no link "), F.col("id").cast("string")))
    found = posts.withColumn("_key", key).join(keyed.withColumnRenamed("url", "page_url"), F.col("_key") == F.col("_page_key"), "left")
    found = found.drop("_page_key")
    if rules is not None:
        # Pages are dealt out once, by their key: the posts meet them there, and what was read of them, which Python
        # hands back without a known order of keys, is dealt again without the page.
        read = extract_pages(keyed.join(wanted, "_page_key"), F.nullif(F.col("_rule"), F.lit("")))
        read = read.select("_page_key", F.col("_rule").alias("_page_rule"), "title", "body")
        # Written as two comparisons, the rule is no join key: with one, the pages would be dealt again by key and rule.
        ruled = (F.col("_rule") >= F.col("_page_rule")) & (F.col("_rule") <= F.col("_page_rule"))
        found = found.join(read, (F.col("_key") == F.col("_page_key")) & ruled, "left").drop("_page_key", "_page_rule")
    return found.drop("_key", "_rule")


def build_articles(
    posts: DataFrame,
    pages: DataFrame,
    articles: DataFrame | None = None,
    accounts: DataFrame | None = None,
    keep_without_page: bool = True,
    flagged_only: bool = False,
    rules: dict[str, str] = BODY_RULES,
) -> DataFrame:
    """New article rows, one per root post of a newspaper that has none yet; comments stay flat."""
    todo = news_posts(posts, accounts, flagged_only)
    if articles is not None:
        todo = P.without_keys(todo, articles, "id", "tweet_id")
    read = with_pages(todo, pages, rules)
    has_page = F.col("body").isNotNull()
    if not keep_without_page:
        read = read.where(has_page)
    return read.select(
        F.col("id").alias("tweet_id"),
        "text",
        F.when(has_page, X.slug("title")).alias("slug"),
        "title",
        F.when(has_page, F.col("page_url")).alias("url"),
        F.col("user.screen_name").alias("user"),
        "body",
        F.when(has_page, F.col("html")).alias("html"),
        "created_at",
    )


def comments_of(posts: DataFrame, articles: DataFrame, scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """The replies to articles, flat: one row per comment.

    The score is what the posts carry, or what ``scorer`` makes of their text, or null.
    """
    replies = P.only_keys(posts.where(P.is_reply()), articles, P.PARENT, "tweet_id")
    if scorer is not None:
        score = scorer(F.col("text"))
    else:
        score = F.col("hateful_value") if "hateful_value" in posts.columns else F.lit(None)
    return replies.select(
        F.col(P.PARENT).alias("article_id"),
        F.col("id").alias("tweet_id"),
        "text",
        "created_at",
        score.cast("double").alias("hateful_value"),
    )


def with_comments(articles: DataFrame, comments: DataFrame, block_rows: int = BLOCK_ROWS, prune: bool = False) -> DataFrame:
    """Articles with nested comments, oldest first, in blocks of ``block_rows`` (column ``part``).

    ``prune`` drops the comments of other articles before they are shuffled: for a selection of articles.
    """
    if prune:
        comments = P.only_keys(comments, articles, "article_id", "tweet_id")
    comments = comments.withColumn("_comment_id", F.col("tweet_id"))
    element = F.struct(F.col("_comment_id").alias("tweet_id"), "text", "hateful_value")
    order = ["created_at", "_comment_id", "text", "hateful_value"]
    return nest_in_parts(articles, "tweet_id", comments, "article_id", element, order, block_rows=block_rows)


def repair_bodies(articles: DataFrame, rules: dict[str, str] = BODY_RULES) -> DataFrame:
    """All articles, bodies re-read from the stored page where the newspaper has a rule that applies."""
    return updated(articles, repaired_bodies(articles, rules), "tweet_id", ["body"])
