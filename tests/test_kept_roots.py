"""Roots kept over batches equal the roots of all posts at once."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import filters as P
from threadloom.operators import threads as G
from threadloom.plans import kept_roots

POSTS = f"id long, {P.PARENT} long"


def posts_of(spark, edges):
    return spark.createDataFrame(edges, POSTS)


def expected(spark, edges):
    return sorted(map(tuple, G.thread_roots(posts_of(spark, edges)).collect()), key=repr)


def kept(spark, folder, batches):
    table = kept_roots.RootTable(spark, str(folder), 4)
    for number, edges in enumerate(batches):
        table.add(posts_of(spark, edges), number)
    return table


def got(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


# Two threads, an orphan under 90, posts with parent 0, a cycle 50-51 with 52 below it, a post that answers itself.
EDGES = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, 3), (10, 0), (11, 10), (91, 90), (92, 91), (50, 51), (51, 50), (52, 51), (60, 60)]


@pytest.mark.parametrize("seed", [1])
def test_any_order_and_cut(spark, tmp_path, seed):
    pick = random.Random(seed)
    edges = EDGES[:]
    pick.shuffle(edges)
    cuts = sorted(pick.sample(range(1, len(edges)), 2))
    batches = [edges[a:b] for a, b in zip([0, *cuts], [*cuts, len(edges)])]
    assert got(kept(spark, tmp_path, batches)) == expected(spark, edges)


def test_top_last_and_run_again(spark, tmp_path):
    """A chain from its end upward: every batch gives the root of the one before a parent."""
    edges = [(n, n - 1 if n > 1 else None) for n in range(1, 13)]
    batches = [edges[9:], edges[6:9], edges[:6]]
    table = kept(spark, tmp_path, batches)
    assert got(table) == expected(spark, edges)
    table.add(posts_of(spark, batches[-1]), 2)
    table.add(posts_of(spark, [(20, 12), (7, None), (None, 3)]), 3)
    assert got(table) == expected(spark, [*edges, (20, 12)])
    table.add(posts_of(spark, [(21, 12)]), 4)
    # The long way from the anchor of 12 is one link by now.
    assert {r.root_id for r in table._latest(table.links.read(), 99).where(F.col("id") == 10).collect()} == {1}


def test_a_batch_reads_its_own_buckets(spark, tmp_path):
    table = kept(spark, tmp_path, [EDGES])
    plan = table.members.near(posts_of(spark, [(7, 3)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    seen = []
    near = type(table.members).near
    reading = {k: getattr(type(table.members), k) for k in ("read",)}
    try:
        type(table.members).read = lambda self: seen.append(self.path) or reading["read"](self)
        type(table.members).near = lambda self, keys, key=None: [near(self, keys, key), seen.pop()][0]
        table.add(posts_of(spark, [(7, 3)]), 1)
    finally:
        type(table.members).read, type(table.members).near = reading["read"], near
    assert seen == [] and got(table) == expected(spark, [*EDGES, (7, 3)])


def test_nothing(spark, tmp_path):
    table = kept(spark, tmp_path, [[]])
    assert got(table) == []
