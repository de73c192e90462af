"""Live ingest: track terms, first copies, replies-only mode, upstream rounds and article building.

Posts go to a table in buckets of ids, where a batch that runs again adds nothing twice. Every other job writes what
a batch adds to a folder named after the batch; run again after a failure it replaces its own folder and does not
look at it. So each row lands exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom import model
from threadloom.functions import text as TX
from threadloom.operators import filters as P
from threadloom.operators.groups import first_wins
from threadloom.plans.articles import build_articles, pages_near
from threadloom.operators.threads import pending_replies
from threadloom.plans.upstream import Kept, close_by_deltas
from threadloom.sources.buckets import BUCKETS, BucketStore
from threadloom.sources.writers import narrowed, write_batch
from threadloom.streaming.batches import Work, start, stored

# The accounts and the accusing words followed by default.
NEWS_TRACKS = [
    "@infobae",
    "@LANACION",
    "@clarincom",
    "@cronica",
    "@perfilcom",
    "@izquierdadiario",
    "@pagina12",
    "@elmundoes",
    "@lavanguardia",
    "@abc_es",
    "@elpaisuy",
    "@latercera",
    "@laderechadiario",
]
ACCUSING_WORDS = ["racista", "misógino", "machista", "machirulo"]

# A table that other jobs add to is given as a function that reads it, called anew for every batch.
Table = DataFrame | Callable[[], DataFrame]


def current(table: Table) -> DataFrame:
    return table if isinstance(table, DataFrame) else table()


def track_matches(posts: DataFrame, tracks: Sequence[str]) -> DataFrame:
    """One row per post and track term it matches."""
    return posts.withColumn("query", F.explode(TX.track_hits("text", tracks)))


def tagged(posts: DataFrame, tracks: Sequence[str]) -> DataFrame:
    """Posts that match, each stamped with the first term of the list it matches."""
    return posts.withColumn("query", F.get(TX.track_hits("text", tracks), F.lit(0))).where(F.col("query").isNotNull())


def save_new(table: str, order: Sequence[str] = ("created_at",), buckets: int = BUCKETS) -> Work:
    """Batch work that adds posts whose id is not in the table yet, the first copy of each.

    The table is kept in buckets of ids (:class:`BucketStore`): a batch meets the buckets of its own ids, be
    they new or years old, and a batch that runs again adds nothing twice.
    """

    def work(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            # The hash settles ties: copies that differ in anything still give the same winner every time.
            by = [*[F.col(c) for c in order], F.xxhash64(*batch.columns)]
            BucketStore(batch.sparkSession, table, batch.schema, "id", buckets).insert(batch, by)
        finally:
            batch.unpersist()

    return work


def selected(
    stream: DataFrame, tracks: Sequence[str] | None, languages: Sequence[str] | None, only_replies: bool
) -> DataFrame:
    posts = stream if languages is None else stream.where(P.in_languages(languages))
    posts = posts.where(P.kept_by_worker(only_replies))
    return posts if tracks is None else tagged(posts, tracks)


def ingest_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    tracks: Sequence[str] | None = NEWS_TRACKS,
    languages: Sequence[str] | None = ("es",),
    only_replies: bool = False,
    work: Work | None = None,
    period: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the first copy of every post in the languages that matches a track term, in a table of ``buckets`` folders.

    ``tracks=None`` takes posts that carry their query already. ``work`` replaces the saving.
    """
    posts = selected(stream, tracks, languages, only_replies)
    return start(posts, work or save_new(table, buckets=buckets), checkpoint, period)


def ingest_replies(
    stream: DataFrame, table: str, checkpoint: str, tracks: Sequence[str] = ACCUSING_WORDS, **more
) -> StreamingQuery:
    """Replies that hold an accusing word."""
    return ingest_stream(stream, table, checkpoint, tracks, only_replies=True, **more)


def drop_replays(stream: DataFrame, key: str = "id", horizon: str = "1 day", spread: int = 0) -> DataFrame:
    """First copies by state instead of by the table: copies further apart than ``horizon`` come through.

    With ``spread`` each key is first reduced within that many shards of the input tasks, for streams
    in which one key may come as a flood of copies.
    """
    timed = stream.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", horizon)
    if spread:
        timed = timed.withColumn("_shard", F.spark_partition_id() % spread)
        timed = timed.dropDuplicatesWithinWatermark([key, "_shard"]).drop("_shard")
    return timed.dropDuplicatesWithinWatermark([key])


def article_stream(
    stream: DataFrame, pages: Table | BucketStore, table: str, checkpoint: str, accounts: Table, period: str | None = None, **more
) -> StreamingQuery:
    """Articles for the root posts of each batch that have none yet.

    Of ``pages`` in a store (:func:`page_store`) a batch reads the buckets its links lead to; a plain table is read whole.

    Comments are not stored with them: they are the replies in the post table, joined when a release
    is cut, so a reply that comes years later needs no second run and no watermark can drop it.
    """
    schema = T.StructType([T.StructField("tweet_id", T.LongType())])

    def work(batch: DataFrame, number: int) -> None:
        # Bounds, links and articles all read the batch: it is computed once.
        batch.persist()
        try:
            before = stored(batch.sparkSession, table, schema, number)
            posts = first_wins(batch, ["id"], [F.col("created_at"), F.xxhash64(*batch.columns)])
            built = narrowed(before, batch.select(F.col("id").alias("tweet_id")), "tweet_id")
            landed = pages_near(pages, batch) if isinstance(pages, BucketStore) else current(pages)
            write_batch(build_articles(posts, landed, built, current(accounts), **more), table, number)
        finally:
            batch.unpersist()

    return start(stream, work, checkpoint, period)


WAITING = T.StructType([T.StructField(n, T.LongType()) for n in ("id", P.PARENT, "batch")])
SETTLED = T.StructType([T.StructField(n, T.LongType()) for n in ("id", "batch")])


def near_ids(table: Table | BucketStore) -> Callable[[DataFrame], DataFrame]:
    """The rows of ``table`` that can have one of the ids asked for: the ids' buckets of a store, a plain table whole."""
    return lambda ids: table.near(ids, "id") if isinstance(table, BucketStore) else current(table)


def upstream_stream(
    responses: DataFrame,
    posts: Table | BucketStore,
    errors: Table | BucketStore,
    folder: str,
    checkpoint: str,
    period: str | None = "300 seconds",
    arrivals: Callable[[int], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Threads closed upward with every answer that has landed so far, batch by batch.

    A batch is met with what there is by its own ids: its answers with the replies kept waiting, new replies
    with the answers kept. The first batch takes the pending replies of all ``posts``; later ones those of
    ``arrivals(number)``, the posts that came since the batch before (none by default). Adds to the tables ``found``,
    ``errors`` and ``marked`` under ``folder``, a folder for each batch; ``answers``, ``waiting`` and ``settled`` are kept there
    in buckets of ids, with the number of the batch, so that a batch that runs again doesn't see its own rows.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        answered = T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])
        answers = BucketStore(spark, f"{folder}/answers", answered, "id", buckets)
        waiting = BucketStore(spark, f"{folder}/waiting", WAITING, P.PARENT, buckets)
        settled = BucketStore(spark, f"{folder}/settled", SETTLED, "id", buckets)
        earlier = F.col("batch") < number
        if number == 0:
            came = posts.read() if isinstance(posts, BucketStore) else current(posts)
        else:
            came = arrivals(number) if arrivals else spark.createDataFrame([], model.POST)
        kept = Kept(
            near_ids(posts),
            near_ids(errors),
            lambda ids: settled.near(ids, "id").where(earlier),
            lambda ids: answers.near(ids, "id").where(earlier),
            lambda ids: waiting.near(ids, "id").where(earlier),
        )
        batch.persist()
        try:
            step, waits = close_by_deltas(pending_replies(came).select("id", P.PARENT), batch, kept)
            for name, rows in (("found", step.found), ("errors", step.errors), ("marked", step.marked)):
                write_batch(rows, f"{folder}/{name}", number)
            mark = F.lit(number).cast("long")
            done = step.outcomes.where("outcome <> 'refused'").select("id")
            for store, rows in ((answers, batch), (waiting, waits), (settled, done)):
                store.append(rows.withColumn("batch", mark))
        finally:
            batch.unpersist()

    return start(responses, work, checkpoint, period)
