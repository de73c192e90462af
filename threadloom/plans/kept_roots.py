"""Thread roots kept over batches: a batch meets the roots that wait for it and the ancestors of its own posts, never the store.

A post is written once, with its *anchor*, the topmost post known when it came, and the depth below it. When the
parent of an anchor turns up, one link is written, from this anchor to the root above it. The posts under the
anchor stay as they are: reading follows the links.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators import filters as P
from threadloom.operators.groups import first_wins
from threadloom.session import materialise
from threadloom.sources.buckets import BUCKETS, BucketStore


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


# A null anchor or root stands for a post on or below a cycle.
MEMBER = _longs("id", "anchor", "depth", "batch")
LINK = _longs("id", "root_id", "depth", "batch")
WAITING = _longs("parent", "id", "batch")


def climbed(state: DataFrame, name: str = "climb") -> DataFrame:
    """id, root_id and depth at the end of the chains of ``state`` (id unique, up, depth; the depth of an end is 0).

    Pointer doubling: a chain of n links takes log2(n) rounds, each written to the shared folder. Chains that
    lead into a cycle get nulls.
    """
    state = materialise(state, name)
    done, moving = state.where("depth = 0"), state.where("depth > 0")
    while not moving.isEmpty():
        above = done.withColumn("_ended", F.lit(True)).unionByName(moving.withColumn("_ended", F.lit(False)))
        above = above.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), "_ended")
        stepped = moving.join(above, F.col("up") == F.col("_id")).select("id", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), "_ended")
        stepped = materialise(stepped, name)
        ended = stepped.where("_ended").drop("_ended")
        moving = stepped.where("not _ended").drop("_ended")
        done = done.unionByName(ended)
        if ended.isEmpty():
            break
    nothing = F.lit(None).cast("long")
    return done.withColumnRenamed("up", "root_id").unionByName(moving.select("id", nothing.alias("root_id"), nothing.alias("depth")))


@dataclass
class RootTable:
    """Roots and depths of all posts seen so far, under ``folder``: ``members``, ``links`` and ``waiting``, each in buckets of ids.

    Batches may come in any order and any cut; the result is that of ``thread_roots`` over all of them. Of
    several rows with one id the first batch counts, in it the smallest parent. A batch that runs again, after
    a loss in the middle of it too, reads what was there before it and adds nothing twice.
    """

    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        self.members = BucketStore(self.spark, f"{self.folder}/members", MEMBER, "id", self.buckets)
        self.links = BucketStore(self.spark, f"{self.folder}/links", LINK, "id", self.buckets)
        self.waiting = BucketStore(self.spark, f"{self.folder}/waiting", WAITING, "parent", self.buckets)

    def _latest(self, links: DataFrame, number: int) -> DataFrame:
        """The newest link of each anchor: later ones lead further up."""
        return first_wins(links.where(F.col("batch") < number), ["id"], [F.col("batch").desc()]).select("id", "root_id", "depth")

    def _followed(self, anchors: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
        """id, root_id, depth of the roots that ``anchors`` (id) have now; and those that took more than one link."""
        at = materialise(anchors.select("id", F.col("id").alias("root_id"), F.lit(0).cast("long").alias("depth"), F.lit(0).alias("hops")), "anchors")
        done = at.limit(0)
        while not at.isEmpty():
            ends = at.where("root_id is not null").select(F.col("root_id").alias("id")).distinct()
            found = P.only_keys(self._latest(self.links.near(ends), number), ends, "id")
            found = found.select(F.col("id").alias("_id"), F.col("root_id").alias("_root"), F.col("depth").alias("_depth"))
            step = materialise(at.join(found, F.col("root_id") == F.col("_id"), "left"), "anchors")
            done = done.unionByName(step.where("_id is null").select(*at.columns))
            at = step.where("_id is not null").select("id", F.col("_root").alias("root_id"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("hops") + 1).alias("hops"))
        return done.drop("hops"), done.where("hops > 1").drop("hops")

    def add(self, posts: DataFrame, number: int) -> None:
        """Take in the posts of batch ``number``: only buckets of their ids, parents and anchors are read."""
        parent = F.col(P.PARENT)
        new = first_wins(posts.where(F.col("id").isNotNull()).select("id", F.when(P.is_reply(), parent).alias("up")), ["id"], [F.col("up").asc_nulls_last()])
        new = materialise(new, "root-batch")
        known = self.members.near(new).where(F.col("batch") < number)
        new = materialise(P.without_keys(new, known, "id"), "root-batch")
        if new.isEmpty():
            return
        woken = P.only_keys(self.waiting.near(new, "id").where(F.col("batch") < number), new, "parent", "id")
        woken = woken.select("id", F.col("parent").alias("up")).distinct()
        # Parents that came before: their anchors, and where these lead by now.
        asked = new.where("up is not null").select(F.col("up").alias("id")).distinct()
        held = P.only_keys(self.members.near(asked).where(F.col("batch") < number), asked, "id")
        held = materialise(held.select(F.col("id").alias("_held"), "anchor", F.col("depth").alias("_below")), "root-parents")
        now, long_ways = self._followed(held.select(F.col("anchor").alias("id")).where("id is not null").distinct(), number)
        now = now.select(F.col("id").alias("anchor"), "root_id", F.col("depth").alias("_above"))
        held = materialise(held.join(now, "anchor", "left").select("_held", "root_id", (F.col("_below") + F.col("_above")).alias("_depth")), "root-parents")

        inside = new.select(F.col("id").alias("_new"))
        edges = new.join(inside, F.col("up") == F.col("_new"), "left").join(held, F.col("up") == F.col("_held"), "left")
        lost = F.col("_held").isNotNull() & F.col("root_id").isNull()
        top = F.col("_new").isNull() & F.col("_held").isNull()
        edges = materialise(
            edges.select(
                "id",
                "up",
                lost.alias("lost"),
                (top & F.col("up").isNotNull()).alias("waits"),
                F.when(top, F.col("id")).when(F.col("_new").isNotNull(), F.col("up")).otherwise(F.col("root_id")).alias("to"),
                F.when(top, 0).when(F.col("_new").isNotNull(), 1).otherwise(F.col("_depth") + 1).cast("long").alias("depth"),
            ),
            "root-edges",
        )
        # A post below a cycle leads to itself by way of nothing: it is climbed as one more end and loses its root afterwards.
        ends = edges.select("id", F.when(F.col("lost"), F.col("id")).otherwise(F.col("to")).alias("up"), "depth", "lost")
        ends = ends.withColumn("depth", F.when(F.col("lost"), 0).otherwise(F.col("depth")))
        steps = ends.drop("lost").unionByName(woken.withColumn("depth", F.lit(1).cast("long")))
        # Roots that nothing of the batch leads further up end the chains.
        last = steps.select(F.col("up").alias("id")).distinct()
        last = P.without_keys(last, steps, "id").select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("depth"))
        roots = climbed(steps.unionByName(last), "root-climb")
        lost_ids = ends.where("lost").select(F.col("id").alias("_lost"))
        roots = roots.join(lost_ids, F.col("root_id") == F.col("_lost"), "left")
        found = F.col("_lost").isNull()
        roots = materialise(roots.select("id", F.when(found, F.col("root_id")).alias("root_id"), F.when(found, F.col("depth")).alias("depth")), "root-new")

        mark = F.lit(number).cast("long").alias("batch")
        links = P.only_keys(roots, woken, "id").unionByName(self._shortened(long_ways, roots))
        self.waiting.append(edges.where("waits").select(F.col("up").alias("parent"), "id", mark))
        self.links.append(links.select("id", "root_id", "depth", mark))
        # Members come last: a batch that was cut short before is not taken for one that is done.
        self.members.insert(P.only_keys(roots, new, "id").select("id", F.col("root_id").alias("anchor"), "depth", mark), [F.col("batch")])

    @staticmethod
    def _shortened(long_ways: DataFrame, roots: DataFrame) -> DataFrame:
        """Links over several steps as one, so that the next batch follows one; their ends may have been linked by this batch."""
        above = roots.select(F.col("id").alias("_id"), F.col("root_id").alias("_root"), F.col("depth").alias("_above"))
        joined = long_ways.join(above, F.col("root_id") == F.col("_id"), "left")
        moved = F.col("_id").isNotNull()
        return joined.select("id", F.when(moved, F.col("_root")).otherwise(F.col("root_id")).alias("root_id"), F.when(moved, F.col("depth") + F.col("_above")).otherwise(F.col("depth")).alias("depth"))

    def read(self) -> DataFrame:
        """id, root_id and depth of every post. Links are followed among themselves first: there is one for each anchor that got a parent."""
        links = self._latest(self.links.read(), 1 << 62)
        ends = links.where("root_id is not null").select(F.col("root_id").alias("id")).distinct()
        nothing = F.lit(None).cast("long")
        ends = P.without_keys(ends, links, "id").select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("depth"))
        # A link to nothing is a chain of its own that never ends at a root.
        lost = links.where("root_id is null").select(F.col("id").alias("_lost"))
        steps = links.select("id", F.coalesce("root_id", "id").alias("up"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))
        whole = climbed(steps.unionByName(ends), "root-links").join(lost, F.col("root_id") == F.col("_lost"), "left")
        whole = whole.select(F.col("id").alias("anchor"), F.when(F.col("_lost").isNull(), F.col("root_id")).alias("_root"), F.when(F.col("_lost").isNull(), F.col("depth")).alias("_above"))
        whole = materialise(whole, "root-links").withColumn("_moved", F.lit(True))
        members = self.members.read().select("id", "anchor", "depth").join(whole, "anchor", "left")
        moved = F.col("_moved").isNotNull()
        return members.select(
            "id",
            F.when(moved, F.col("_root")).otherwise(F.col("anchor")).alias("root_id"),
            F.when(moved, F.col("depth") + F.col("_above")).when(F.col("anchor").isNull(), nothing).otherwise(F.col("depth")).alias("depth"),
        )
