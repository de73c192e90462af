"""The driver's tables seen as posts, articles, comments, errors, pages and annotations.

Whole tables, each a projection that Spark pushes down to the columns used. ``catalog.views`` holds the
same definitions in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import model
from threadloom.functions import scalars as X

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def as_posts(df: DataFrame, **columns) -> DataFrame:
    """A frame in the post schema: given columns as given, all others null."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in model.POST.fields]
    )


@dataclass
class Tables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def articles(self) -> DataFrame:
        """Orders as dated articles of five newspapers."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("tweet_id"),
            F.col("o_orderpriority").alias("user"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def comments(self) -> DataFrame:
        """Line items as comments on them."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("article_id"),
            F.col("l_partkey").alias("tweet_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("text"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_discount").alias("score"),
            (F.col("l_discount") * 10).alias("hateful_value"),
        )

    @cached_property
    def comment_counts(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("tweet_id")).agg(
            F.count(F.lit(1)).alias("n_comments")
        )

    @cached_property
    def docs(self) -> DataFrame:
        """Documents as articles with text."""
        return self.table("documents").select(
            F.col("doc_id").alias("tweet_id"),
            F.col("source").alias("user"),
            "lang",
            X.first_line("text").alias("title"),
            F.col("text").alias("body"),
            F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(n_chars as int))").alias("created_at"),
        )

    @cached_property
    def news(self) -> DataFrame:
        """Documents as articles dated and owned by the order of the same number: text and comments."""
        return self.docs.drop("user", "created_at").join(self.articles, "tweet_id")

    @cached_property
    def threads(self) -> DataFrame:
        """Conversations as reply chains; ids start at 100, as 0 means no parent."""
        turn = F.col("turn")
        return as_posts(
            self.table("conversations"),
            id=F.col("conv_id") * 100 + turn + 100,
            text=F.col("text"),
            created_at=F.expr(
                "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(turn as int), 0, conv_id)"
            ),
            user_name=F.col("role"),
            user=F.struct(F.initcap("role").alias("screen_name")),
            entities=F.struct(
                F.transform(
                    F.regexp_extract_all("text", F.lit(r"https?://\S+"), F.lit(0)), lambda u: F.struct(u.alias("expanded_url"))
                ).alias("urls"),
                F.lit(None).cast("array<struct<media_url:string>>").alias("media"),
            ),
            in_reply_to_status_id=F.when(turn > 0, F.col("conv_id") * 100 + turn + 99),
            in_reply_to_user_id=F.when(turn > 0, F.col("conv_id")),
            look_for_upstream=turn > 0,
            checked=F.col("role") == "assistant",
            interesting=F.lit(False),
        )

    @cached_property
    def caught(self) -> DataFrame:
        """The posts the stream has caught: those by users. All others have to be looked up."""
        return self.threads.where(F.col("user_name") == "user")

    @cached_property
    def responses(self) -> DataFrame:
        """Lookups as they land: system posts are gone, all others come as payloads."""
        gone = F.col("user_name") == "system"
        payload = F.to_json(F.struct(*[F.col(f.name) for f in model.POST.fields]))
        return self.threads.select(
            "id",
            F.when(~gone, payload).alias("payload"),
            F.when(gone, 422).alias("api_code"),
            F.when(gone, "gone").alias("message"),
        )

    @cached_property
    def live(self) -> DataFrame:
        """Events as posts that carry the track term that caught them."""
        return self.live_posts(self.table("events"))

    @staticmethod
    def live_posts(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("event_id").alias("id"),
            F.col("ts").alias("created_at"),
            F.concat(F.lit("@"), F.initcap("event_type")).alias("query"),
            F.col("user_id").cast("string").alias("user_name"),
            "value",
        )

    def stream(self, name: str, schema: str) -> DataFrame:
        """A table as a stream, be it one file or a folder: the pattern matches just that name."""
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parque[t]")

    def live_stream(self) -> DataFrame:
        return self.live_posts(self.stream("events", EVENT))

    @cached_property
    def errors(self) -> DataFrame:
        """Error events as lookup errors, their number as code."""
        return self.table("events").where("event_type = 'error'").select(
            F.col("event_type").alias("message"),
            F.get_json_object("props", "$.k").cast("int").alias("api_code"),
            F.col("event_id").alias("tweet_id"),
        )

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages").select("page_id", "url", "html")

    @cached_property
    def linked(self) -> DataFrame:
        """Documents as root posts; those with a page of the same number link to it."""
        pages = self.table("pages").select("page_id", F.col("url").alias("expanded_url"))
        joined = self.table("documents").join(pages, F.col("doc_id") == F.col("page_id"), "left")
        return as_posts(
            joined,
            id=F.col("doc_id"),
            text=X.first_line("text"),
            created_at=F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(n_chars as int))"),
            lang=F.col("lang"),
            user_name=F.lower("source"),
            user=F.struct(F.col("source").alias("screen_name")),
            entities=F.struct(
                F.when(F.col("expanded_url").isNotNull(), F.array(F.struct("expanded_url")))
                .otherwise(F.array().cast("array<struct<expanded_url:string>>"))
                .alias("urls"),
                F.lit(None).cast("array<struct<media_url:string>>").alias("media"),
            ),
            query=F.concat(F.lit("@"), F.initcap("source")),
            possibly_hateful_comments=F.length("text") > 2000,
        )

    @cached_property
    def store(self) -> DataFrame:
        """Orders as root posts with line items as replies, in one table; ids are order numbers plus one."""
        orders = as_posts(
            self.table("orders"),
            id=F.col("o_orderkey") + 1,
            text=F.col("o_orderstatus"),
            created_at=F.col("o_orderdate"),
            user_name=F.lower("o_orderpriority"),
            query=F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("@"), "o_orderpriority")),
            checked=F.col("o_orderstatus") == "F",
            interesting=F.col("o_orderstatus") == "P",
        )
        replies = as_posts(
            self.table("lineitem"),
            id=F.lit(10**12) + F.col("l_orderkey") * 100 + F.col("l_linenumber"),
            text=F.col("l_returnflag"),
            created_at=F.col("l_shipdate"),
            in_reply_to_status_id=F.col("l_orderkey") + 1,
        )
        return orders.unionByName(replies)

    @cached_property
    def annotations(self) -> DataFrame:
        """Documents as annotated comments, vote arrays as long as labels and lengths say."""
        votes = {
            "HATE": "coalesce(toxic, 0) * 2 + coalesce(1 - quality, 0)",
            "WOMEN": "coalesce(toxic, 0) * 2",
            "LGBTI": "n_chars % 3",
            "RACISM": "n_chars % 4",
            "CLASS": "doc_id % 2",
            "POLITICS": "coalesce(quality, 0) * 3",
            "DISABLED": "doc_id % 3",
            "APPEARANCE": "0",
            "CRIMINAL": "n_chars % 2",
        }
        joined = self.table("documents").join(self.table("labels"), "doc_id", "left")
        arrays = [F.expr(f"array_repeat('annotator', cast({n} as int))").alias(c) for c, n in votes.items()]
        return joined.select(
            F.col("doc_id").alias("tweet_id"), F.col("n_chars").alias("article_id"), X.first_line("text").alias("text"), *arrays
        )

    @cached_property
    def comment_posts(self) -> DataFrame:
        """Line items as replies to annotated comments."""
        return self.comments.select(
            F.col("article_id").alias("in_reply_to_status_id"), F.col("tweet_id").alias("id"), "text"
        )

    @cached_property
    def labels(self) -> DataFrame:
        """Line items as labels given one after another to the same post."""
        return self.table("lineitem").select(
            (F.col("l_orderkey") + 1).alias("id"),
            (F.col("l_returnflag") == "R").alias("interesting"),
            "l_shipdate",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
        )


