"""Physical plans: the joins and scans meant, no cross products, Python only for pages."""

import pytest
from pyspark.sql import functions as F

from threadloom.catalog import QUERIES
from threadloom.operators import filters as P
from threadloom.operators import threads as G
from threadloom.sources.adapters import Tables

PAGES = {"page_bodies", "page_default_bodies", "articles_built", "articles_with_page", "body_repair", "content_bodies", "failing_rules"}
# Rows that come straight out of written tables: their own work is in the jobs before.
NO_PLAN = {"article_stream", "upstream_stream", "ingest_stream", "ingest_tagged", "ingest_replies", "rate_stream", "dedup_stream", "stall_stream", "tracks_live", "trigger_totals", "ingest_own_work"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_PLAN))
def test_no_cross_product_and_no_stray_python(name, spark, folder):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "Pandas" in plan) == (name in PAGES)


@pytest.mark.parametrize("name", ["unchecked", "lost_ids", "upstream_frontier", "unbuilt_posts", "unreleased_roots", "unmatched_annotations"])
def test_differences_are_anti_joins(name, spark, folder):
    assert "LeftAnti" in plan_of(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", ["kept_ids", "parents_known", "posts_with_code", "direct_replies", "point_lookup"])
def test_lookups_are_semi_joins(name, spark, folder):
    assert "LeftSemi" in plan_of(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", ["newest_n", "shuffled_of_users", "label_sample"])
def test_top_rows_are_not_sorted_globally(name, spark, folder):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, folder))


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["recent_of_users"](spark, folder))
    assert "In(o_orderpriority" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan


def test_skewed_parent_is_split(spark, tmp_path):
    """All replies to one parent: the adaptive skew join reads its partition in several tasks."""
    spark.range(400_000).select("id", F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).alias(P.PARENT), F.lit(True).alias("look_for_upstream"), F.uuid().alias("text")).write.parquet(str(tmp_path / "p"))
    spark.range(1000).select("id", F.lit("found").alias("outcome")).write.parquet(str(tmp_path / "o"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        posts = spark.read.parquet(str(tmp_path / "p"))
        done = G.resolved_replies(posts, spark.read.parquet(str(tmp_path / "o")))
        assert done.count() >= 360_000
        done.write.format("noop").mode("overwrite").save()
        done.collect()
        assert "skew" in plan_of(done)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adapters_fit_the_post_schema(spark, folder):
    t = Tables(spark, folder)
    for posts in (t.threads, t.linked, t.store):
        assert [f.name for f in posts.schema] == [f.name for f in t.threads.schema]
