"""Streams: any cut into files and any replay give the batch answer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadloom import model
from threadloom.plans.articles import build_articles, comments_of
from threadloom.sources.adapters import Tables, as_posts
from threadloom.sources.readers import stream_files
from threadloom.streaming import ingest, rates

POSTS = "id long, created_at timestamp_ntz, text string, lang string, in_reply_to_status_id long"
T0 = dt.datetime(2024, 1, 1)


def minute(n):
    return T0 + dt.timedelta(minutes=n)


DATA = [
    (1, minute(0), "hola @infobae", "es", None),
    (1, minute(1), "hola @infobae otra", "es", None),
    (2, minute(2), "racista!", "es", 1),
    (3, minute(3), "@infobae in english", "en", None),
    (4, minute(4), "nada", "es", 1),
    (5, minute(5), "@LaNacion y @INFOBAE", "es", 0),
    (2, minute(600), "racista! tarde", "es", 1),
]


def land(spark, folder, rows, files):
    for i in range(files):
        part = rows[i::files] if files > 1 else rows
        spark.createDataFrame(part, POSTS).coalesce(1).write.mode("append").parquet(str(folder))


def ingested(spark, tmp_path, **more):
    stream = stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], POSTS).schema, files_per_batch=1)
    start = more.pop("start", ingest.ingest_stream)
    start(stream, str(tmp_path / "out"), str(tmp_path / "log"), **more).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("files", [1, 3, 7])
def test_first_copies(spark, tmp_path, files):
    land(spark, tmp_path / "in", DATA, files)
    got = sorted((r.id, r.query) for r in ingested(spark, tmp_path, tracks=["@infobae", "@LANACION"]).collect())
    assert got == [(1, "@infobae"), (5, "@infobae")]


def test_new_files_add_and_replays_do_not(spark, tmp_path):
    land(spark, tmp_path / "in", DATA[:1], 1)
    assert ingested(spark, tmp_path, tracks=["@infobae"]).count() == 1
    land(spark, tmp_path / "in", DATA, 2)
    got = ingested(spark, tmp_path, tracks=["@infobae"])
    assert sorted((r.id, r.created_at) for r in got.collect()) == [(1, minute(0)), (5, minute(5))]


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    work = ingest.save_new(str(tmp_path / "out"))
    batch = spark.createDataFrame(DATA, POSTS)
    work(batch, 0)
    work(batch, 1)
    work(batch, 0)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5]


def test_replies_only(spark, tmp_path):
    land(spark, tmp_path / "in", DATA, 2)
    got = ingested(spark, tmp_path, start=ingest.ingest_replies)
    assert [(r.id, r.query) for r in got.collect()] == [(2, "racista")]


def test_own_work(spark, tmp_path):
    land(spark, tmp_path / "in", DATA, 1)
    seen = []
    stream = stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], POSTS).schema)
    ingest.ingest_stream(stream, "", str(tmp_path / "log"), tracks=["@infobae"], work=lambda df, n: seen.append(df.count())).awaitTermination()
    assert seen == [3]


def test_every_match_counts(spark):
    df = spark.createDataFrame(DATA, POSTS)
    got = sorted((r.id, r.query) for r in ingest.track_matches(df, ["@infobae", "@LANACION"]).where("id = 5").collect())
    assert got == [(5, "@LANACION"), (5, "@infobae")]


@pytest.mark.parametrize("spread", [0, 4])
def test_replays_within_the_horizon(spark, tmp_path, spread):
    land(spark, tmp_path / "in", DATA[:5] + DATA[:5], 1)
    stream = stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], POSTS).schema)
    once = ingest.drop_replays(stream, spread=spread).select("id")
    writer = once.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.schema("id long").parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("files", [1, 4])
def test_closed_periods_equal_the_batch(spark, tmp_path, files):
    rows = [(i, minute(3 * i), "x", "es", None) for i in range(60)]
    step = 60 // files
    for i in range(files):  # in order, so that nothing is late
        land(spark, tmp_path / "in", rows[i * step : (i + 1) * step], 1)
    stream = stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], POSTS).schema, files_per_batch=1)
    live = rates.live_rates(stream.withColumn("query", F.lit("@a")), "600 seconds", "0 seconds")
    writer = live.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log"))
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.period_start, r.n) for r in spark.read.schema(live.schema).parquet(str(tmp_path / "out")).collect())
    whole = rates.flat(rates.rates(spark.createDataFrame(rows, POSTS).withColumn("query", F.lit("@a"))))
    closed = sorted((r.period_start, r.n) for r in whole.where(F.col("period_end") <= F.lit(minute(177)).cast("timestamp_ntz")).collect())
    assert got == closed and len(got) == 17


def test_stalls(spark):
    rows = [(1, minute(0), "@a"), (2, minute(25), "@a"), (3, minute(12), "@b")]
    df = spark.createDataFrame(rows, "id long, created_at timestamp_ntz, query string")
    counted = rates.flat(rates.rates(df))
    got = sorted((r.query, r.period_start) for r in rates.stalls(counted).collect())
    assert got == [("@a", minute(10)), ("@b", minute(0)), ("@b", minute(20))]
    report = sorted((r.query, r.n, r.before, r.total) for r in rates.report(counted).collect())
    assert report == [("@a", 1, 0, 1), ("@a", 1, 1, 2), ("@b", 1, 0, 1)]


@pytest.mark.parametrize("files", [1, 3])
def test_live_stalls_equal_the_batch(spark, tmp_path, files):
    moments = [0, 1, 5, 31, 32, 33, 64, 95, 121, 122, 150, 181]
    rows = [(i, minute(m), "x", "@a" if i % 3 else "@b", None) for i, m in enumerate(moments)]
    step = len(rows) // files
    for i in range(files):
        land(spark, tmp_path / "in", rows[i * step : (i + 1) * step], 1)
    stream = stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], POSTS).schema, files_per_batch=1)
    live = rates.live_rates(stream.withColumnRenamed("lang", "query"), "600 seconds", "0 seconds")
    rates.watch(live, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = sorted((r.query, r.period_start) for r in spark.read.parquet(str(tmp_path / "out" / "stalls")).collect())
    whole = rates.flat(rates.rates(spark.createDataFrame(rows, POSTS).withColumnRenamed("lang", "query")))
    closed = whole.where(F.col("period_end") <= F.lit(minute(181)).cast("timestamp_ntz"))
    assert got == sorted((r.query, r.period_start) for r in rates.stalls(closed).collect()) and got


def test_articles_in_any_batches_equal_one_build(spark, tmp_path, folder):
    t = Tables(spark, folder)
    posts = t.linked.limit(60).cache()
    posts.repartition(3).write.parquet(str(tmp_path / "in"))
    posts.repartition(1).write.mode("append").parquet(str(tmp_path / "in"))  # all of them once more
    stream = stream_files(spark, str(tmp_path / "in"), model.POST, files_per_batch=1)
    accounts = t.linked.select("user_name").distinct()
    ingest.article_stream(stream, t.pages, str(tmp_path / "out"), str(tmp_path / "log"), accounts).awaitTermination()
    columns = ["tweet_id", "title", "url", "body", "user"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    whole = build_articles(posts, t.pages, accounts=accounts).select(*columns)
    assert got.count() == 60 and got.exceptAll(whole).isEmpty()


def test_late_reply_is_a_comment(spark):
    """A reply years after its article, stored before the article or after it, is found when comments are joined."""
    rows = [(5, 1, T0 + dt.timedelta(days=3000)), (6, 1, T0), (7, 2, T0), (1, None, T0), (8, 0, T0)]
    df = spark.createDataFrame(rows, "i long, p long, at timestamp_ntz")
    posts = as_posts(df, id=F.col("i"), in_reply_to_status_id=F.col("p"), created_at=F.col("at"))
    articles = spark.createDataFrame([(1,)], "tweet_id long")
    assert sorted(r.tweet_id for r in comments_of(posts, articles).collect()) == [5, 6]
