"""Closing threads batch by batch: each batch met with the rest by its own ids."""

import pytest
from pyspark.sql import functions as F

from threadloom import model
from threadloom.operators import filters as P
from threadloom.plans.upstream import close_upward
from threadloom.sources.adapters import Tables
from threadloom.sources.buckets import BucketStore
from threadloom.streaming import ingest


def drained(spark, t, tmp_path, landed, parts, posts, errors, **more):
    landed.repartitionByRange(parts, "id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(model.RESPONSE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.upstream_stream(stream, posts, errors, str(tmp_path / "out"), str(tmp_path / "log"), period=None, buckets=4, **more).awaitTermination()
    return {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in ("found", "errors", "marked")}


@pytest.mark.parametrize("buckets", [0, 4])
def test_batches_equal_one_closure(spark, folder, tmp_path, buckets):
    """Answers in three batches, the tops of the threads first, give what all answers give at once."""
    t = Tables(spark, folder)
    whole = close_upward(t.caught, t.errors, None, t.responses)
    posts = t.caught
    if buckets:
        posts = BucketStore(spark, str(tmp_path / "posts"), t.caught.schema, "id", buckets)
        posts.create(t.caught)
    got = drained(spark, t, tmp_path, t.responses, 3, posts, t.errors)
    ids = lambda df, c="id": sorted(r[0] for r in df.select(c).collect())
    assert ids(got["found"]) == ids(whole.found) and ids(got["errors"], "tweet_id") == ids(whole.errors, "tweet_id")
    assert set(ids(got["marked"])) == set(ids(whole.marked))


def test_replies_that_come_after_their_answers(spark, folder, tmp_path):
    """Nothing waits at first; the replies arrive with the last batch and use the answers kept."""
    t = Tables(spark, folder)
    nobody = t.caught.limit(0)
    got = drained(spark, t, tmp_path, t.responses, 2, nobody, t.errors, arrivals=lambda number: t.caught if number == 1 else nobody)
    whole = close_upward(t.caught, t.errors, None, t.responses)
    # The store is empty here, so posts that had been caught are found as well.
    caught = {r.id for r in t.caught.select("id").collect()}
    assert {r.id for r in got["found"].collect()} - caught == {r.id for r in whole.found.collect()}


def test_a_small_batch_reads_the_buckets_of_its_ids(spark, folder, tmp_path):
    t = Tables(spark, folder)
    posts = BucketStore(spark, str(tmp_path / "posts"), t.caught.schema, "id", 16)
    posts.create(t.caught)
    ids = spark.createDataFrame([(101,)], "id long")
    plan = ingest.near_ids(posts)(ids).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and P.PARENT not in plan.split("ReadSchema")[1]
