"""Streams, run over what is there and then stopped, and their batch counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import model
from threadloom.catalog.registry import query, sql_fold, sql_tokens
from threadloom.operators import filters as P
from threadloom.plans.articles import page_store, stored_pages
from threadloom.session import run_dir
from threadloom.sources.adapters import EVENT
from threadloom.sources.writers import write_batch
from threadloom.streaming import ingest, rates, tracks

RATES = """
    SELECT time_bucket(INTERVAL '600 seconds', created_at, TIMESTAMP '1970-01-01') AS period_start, query, count(*) AS n
    FROM live GROUP BY 1, 2"""


@query(
    "rate_report",
    f"""
    SELECT period_start, period_start + INTERVAL 10 MINUTE AS period_end, query, n,
           CAST(sum(n) OVER (PARTITION BY query ORDER BY period_start) AS BIGINT) AS total,
           CAST(sum(n) OVER (PARTITION BY query ORDER BY period_start) AS BIGINT) - n AS before
    FROM ({RATES})""",
)
def rate_report(t):
    return rates.report(rates.flat(rates.rates(t.live)))


@query(
    "period_totals",
    f"""
    SELECT period_start, period_start + INTERVAL 10 MINUTE AS period_end, query, n FROM ({RATES})
    UNION ALL SELECT period_start, period_start + INTERVAL 10 MINUTE, NULL, CAST(sum(n) AS BIGINT) FROM ({RATES}) GROUP BY 1""",
)
def period_totals(t):
    return rates.period_totals(t.live)


@query(
    "stall_windows",
    f"""
    WITH r AS ({RATES}), ends AS (SELECT min(period_start) AS a, max(period_start) AS b FROM r),
    grid AS (SELECT q.query, p.period_start FROM (SELECT DISTINCT query FROM r) q
             CROSS JOIN (SELECT unnest(generate_series(a, b, INTERVAL 10 MINUTE)) AS period_start FROM ends) p)
    SELECT query, period_start FROM grid ANTI JOIN r USING (query, period_start)""",
)
def stall_windows(t):
    return rates.stalls(rates.flat(rates.rates(t.live)))


def _drain(stream):
    stream.awaitTermination()


@query(
    "rate_stream",
    """
    SELECT date_trunc('day', created_at) AS period_start, date_trunc('day', created_at) + INTERVAL 1 DAY AS period_end,
           query, count(*) AS n
    FROM live WHERE date_trunc('day', created_at) + INTERVAL 1 DAY <= (SELECT max(created_at) - INTERVAL 10 MINUTE FROM live)
    GROUP BY ALL""",
)
def rate_stream(t):
    """Days that the watermark has closed."""
    counted = rates.live_rates(t.live_stream(), "1 day")
    folder = run_dir(t.spark, "rates")
    writer = counted.writeStream.format("parquet").option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/log")
    _drain(writer.outputMode("append").trigger(availableNow=True).start())
    return t.spark.read.schema(counted.schema).parquet(f"{folder}/table")


@query(
    "stall_stream",
    f"""
    WITH r AS (SELECT * FROM ({RATES}) WHERE period_start + INTERVAL 10 MINUTE <= (SELECT max(created_at) - INTERVAL 10 MINUTE FROM live)),
    ends AS (SELECT min(period_start) AS a, max(period_start) AS b FROM r),
    grid AS (SELECT q.query, p.period_start FROM (SELECT DISTINCT query FROM r) q
             CROSS JOIN (SELECT unnest(generate_series(a, b, INTERVAL 10 MINUTE)) AS period_start FROM ends) p)
    SELECT query, period_start FROM grid ANTI JOIN r USING (query, period_start)""",
)
def stall_stream(t):
    """Silent periods among those that the watermark has closed."""
    folder = run_dir(t.spark, "stalls")
    _drain(rates.watch(rates.live_rates(t.live_stream()), folder, f"{folder}/log"))
    return t.spark.read.parquet(f"{folder}/stalls").select("query", "period_start")


@query("ingest_stream", "SELECT id, created_at, query FROM live")
def ingest_stream(t):
    """Every event comes three times; one copy of each is kept."""
    stream = t.live_stream().withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    folder = run_dir(t.spark, "ingest")
    _drain(ingest.ingest_stream(stream, f"{folder}/table", f"{folder}/log", tracks=None, languages=None, buckets=16))
    return t.spark.read.parquet(f"{folder}/table").select("id", "created_at", "query")


@query("ingest_own_work", "SELECT id, query FROM live")
def ingest_own_work(t):
    """Each batch goes to a folder of its own instead of the post table."""
    folder = run_dir(t.spark, "own-work")
    work = lambda batch, number: write_batch(batch.select("id", "query"), f"{folder}/table", number)
    _drain(ingest.ingest_stream(t.live_stream(), "", f"{folder}/log", tracks=None, languages=None, work=work))
    return t.spark.read.parquet(f"{folder}/table").select("id", "query")


_TRACKED = rf"regexp_extract_all({sql_fold('text')}, '@?[\p{{L}}\p{{N}}_]+')"


@query(
    "ingest_tagged",
    f"""
    SELECT id, CASE WHEN list_contains({_TRACKED}, 'ciones') THEN 'Ciones' WHEN list_contains({_TRACKED}, 'que') THEN 'que' ELSE 'un' END AS query
    FROM (SELECT doc_id AS id, text FROM documents WHERE lang = 'es') WHERE list_has_any({_TRACKED}, ['ciones', 'que', 'un'])""",
)
def ingest_tagged(t):
    """Documents as live posts: Spanish only, each stamped with the first track term it matches."""
    docs = t.stream("documents", "doc_id long, text string, lang string, source string, n_chars long")
    when = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(n_chars as int))")
    posts = docs.select(F.col("doc_id").alias("id"), when.alias("created_at"), "text", "lang")
    folder = run_dir(t.spark, "tagged")
    _drain(
        ingest.ingest_stream(posts, f"{folder}/table", f"{folder}/log", tracks=["Ciones", "que", "un"], buckets=16)
    )
    return t.spark.read.parquet(f"{folder}/table").select("id", "query")


@query(
    "ingest_replies",
    f"""
    SELECT id, parent FROM threads WHERE parent IS NOT NULL AND list_has_any({sql_tokens('text')}, ['the', 'und', 'ete'])""",
)
def ingest_replies(t):
    turns = t.stream("conversations", "conv_id long, turn long, role string, text string")
    posts = turns.select(
        (F.col("conv_id") * 100 + F.col("turn") + 100).alias("id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(turn as int), 0, conv_id)").alias("created_at"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 100 + F.col("turn") + 99).alias(P.PARENT),
        "text",
    )
    folder = run_dir(t.spark, "replies")
    _drain(
        ingest.ingest_replies(posts, f"{folder}/table", f"{folder}/log", ["the", "und", "été"], languages=None, buckets=16)
    )
    return t.spark.read.parquet(f"{folder}/table").select("id", F.col(P.PARENT).alias("parent"))


@query("dedup_stream", "SELECT id, query FROM live")
def dedup_stream(t):
    stream = t.live_stream().withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    once = ingest.drop_replays(stream, spread=8)
    folder = run_dir(t.spark, "dedup")
    writer = once.select("id", "query").writeStream.format("parquet").option("path", f"{folder}/table")
    _drain(writer.option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start())
    return t.spark.read.schema("id long, query string").parquet(f"{folder}/table")


@query(
    "article_stream",
    """
    SELECT l.id AS tweet_id, p.url, p.title FROM linked l LEFT JOIN page_keys p ON p.key = l.link_key""",
)
def article_stream(t):
    """Articles built batch by batch from a folder of posts."""
    folder = run_dir(t.spark, "articles")
    t.linked.repartition(2).write.parquet(f"{folder}/posts")
    stream = t.spark.readStream.schema(model.POST).option("maxFilesPerTrigger", 1).parquet(f"{folder}/posts")
    accounts = t.linked.select("user_name").distinct()
    pages = page_store(t.spark, f"{folder}/pages", buckets=8)
    pages.create(stored_pages(t.pages))
    _drain(ingest.article_stream(stream, pages, f"{folder}/table", f"{folder}/log", accounts))
    return t.spark.read.parquet(f"{folder}/table").select("tweet_id", "url", "title")


@query(
    "upstream_stream",
    """
    WITH RECURSIVE reached AS (
      SELECT p.id, p.parent FROM threads p JOIN caught c ON c.parent = p.id
      WHERE p.user_name = 'assistant' AND p.id NOT IN (SELECT tweet_id FROM errors)
      UNION
      SELECT p.id, p.parent FROM threads p JOIN reached r ON r.parent = p.id
      WHERE p.user_name = 'assistant' AND p.id NOT IN (SELECT tweet_id FROM errors))
    SELECT id, parent IS NOT NULL AS look_for_upstream FROM reached""",
)
def upstream_stream(t):
    """Posts found over landed responses that come in several files, the top of every thread first."""
    folder = run_dir(t.spark, "upstream")
    t.responses.repartitionByRange(3, "id").write.parquet(f"{folder}/responses")
    landed = t.spark.readStream.schema(model.RESPONSE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/responses")
    _drain(ingest.upstream_stream(landed, t.caught, t.errors, folder, f"{folder}/log", period=None, buckets=8))
    return t.spark.read.parquet(f"{folder}/found").select("id", "look_for_upstream")


TRACKS = ["@Click", "@View", "@Signup", "@Purchase", "@Error", "@Quiet"]
GRID = f"""
    SELECT q.query, p.period_start FROM (SELECT unnest({TRACKS!r}) AS query) q
    CROSS JOIN (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL 10 MINUTE)) AS period_start FROM ({RATES})) p"""


@query(
    "rate_report_tracks",
    f"""
    SELECT period_start, period_start + INTERVAL 10 MINUTE AS period_end, query, coalesce(n, 0) AS n,
           CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS total, CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) - coalesce(n, 0) AS before
    FROM ({GRID}) LEFT JOIN ({RATES}) USING (query, period_start)
    WINDOW w AS (PARTITION BY query ORDER BY period_start)""",
)
def rate_report_tracks(t):
    """Every track in every period, also with no post; one track never has any."""
    return rates.report(rates.with_silence(rates.flat(rates.rates(t.live)), TRACKS))


@query("stall_tracks", f"SELECT query, period_start FROM ({GRID}) ANTI JOIN ({RATES}) USING (query, period_start)")
def stall_tracks(t):
    return rates.stalls(rates.flat(rates.rates(t.live)), tracks=TRACKS)


CLOSED = "(SELECT max(created_at) - INTERVAL 10 MINUTE FROM live)"


@query(
    "tracks_live",
    f"""
    WITH r AS ({RATES}), grid AS (
      SELECT q.query, p.period_start FROM (SELECT unnest({TRACKS!r}) AS query) q
      CROSS JOIN (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL 10 MINUTE)) AS period_start FROM r) p
      WHERE p.period_start + INTERVAL 10 MINUTE <= {CLOSED})
    SELECT period_start, period_start + INTERVAL 10 MINUTE AS period_end, query, coalesce(n, 0) AS n,
           CAST(sum(coalesce(n, 0)) OVER (PARTITION BY query ORDER BY period_start) AS BIGINT) AS total
    FROM grid LEFT JOIN r USING (query, period_start)""",
)
def tracks_live(t):
    """Totals and silent periods by state and timers, for the periods that the watermark has closed; one track never has a post."""
    folder = run_dir(t.spark, "tracks")
    _drain(tracks.start_tracked(tracks.tracked(t.live_stream(), TRACKS), f"{folder}/table", f"{folder}/log"))
    return tracks.read_tracked(t.spark, f"{folder}/table")


@query(
    "trigger_totals",
    f"""
    SELECT query, count(e.id) AS n FROM (SELECT unnest({TRACKS!r}) AS query) q LEFT JOIN live e USING (query) GROUP BY 1
    UNION ALL SELECT NULL, count(*) FROM live""",
)
def trigger_totals(t):
    """Posts per track, counted while a stream writes them out, over several triggers."""
    folder = run_dir(t.spark, "observed")
    t.table("events").repartition(3).write.parquet(f"{folder}/in")
    events = t.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    totals = tracks.TriggerTotals(TRACKS)
    t.spark.streams.addListener(totals)
    try:
        stream = tracks.observed(t.live_posts(events), TRACKS).writeStream.format("parquet").option("path", f"{folder}/out")
        written = stream.option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
        _drain(written)
        totals.wait(written)
    finally:
        t.spark.streams.removeListener(totals)
    counted = t.spark.createDataFrame(totals.rows(), "trigger long, query string, n long, total long")
    return counted.groupBy("query").agg(F.sum("n").alias("n"))
