"""Near duplicates: an exact Jaccard join of shingle sets as a T-occurrence search."""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import kernels as K
from threadloom.llm.components import components
from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, PERCENT = 5, 80
FLUSH = 500_000
BUCKET_POSTINGS = 4_000_000
FREQUENT, LEAST_FREQUENT = 200_000, 8
BLOCK_TOKENS = 4_000_000


def least_overlap(n: int, m: int, percent: int) -> int:
    """Fewest common elements of linked sets with n and m elements."""
    return -(-percent * (n + m) // (100 + percent))


def class_of(shingles: np.ndarray) -> int:
    """The id of all texts with this set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sized(size: int):
    def sized(texts: pd.Series) -> pd.DataFrame:
        sets = [K.shingle_set(t, size) for t in texts]
        return pd.DataFrame({"n": [len(s) for s in sets], "class_id": [class_of(s) for s in sets]})

    return F.pandas_udf(sized, "n long, class_id long")


def _pack_lists(size: int, bits: int):
    """Postings (shingle, class) by the shingle's first ``bits`` bits: per bucket the classes, how many shingles each has there, and those."""

    def flushed(classes: list[int], sets: list[np.ndarray]) -> pd.DataFrame:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        bucket = (shingles >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, owner = bucket[order], owner[order]
        low = ((shingles[order] << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        ids = np.array(classes, "<i8")
        cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        rows = []
        for b in range(1 << bits):
            here = owner[cuts[b] : cuts[b + 1]]
            if len(here):
                first = np.flatnonzero(np.diff(here, prepend=-1))
                counts = np.diff(first, append=len(here)).astype("<u4")
                rows.append((b, ids[here[first]].tobytes(), counts.tobytes(), low[cuts[b] : cuts[b + 1]].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "classes", "counts", "shingles"])

    def packed(batches):
        seen: set[int] = set()
        classes, sets, held = [], [], 0
        for batch in batches:
            for text in batch["text"]:
                shingles = K.shingle_set(text, size)
                own = class_of(shingles)
                if not len(shingles) or own in seen:
                    continue
                seen.add(own)
                classes.append(own)
                sets.append(shingles)
                held += len(shingles)
                if held >= FLUSH:
                    yield flushed(classes, sets)
                    classes, sets, held = [], [], 0
                    seen.clear()
        if sets:
            yield flushed(classes, sets)

    return packed


def _count_lists(bits: int):
    """Of one bucket: per class how many of its shingles another class has too (kind 0); the classes of each frequent shingle (kind 1)."""

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        classes = np.concatenate([np.frombuffer(x, "<i8") for x in rows["classes"]])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]]).astype(np.int64)
        shingles = np.concatenate([np.frombuffer(x, "<u4") for x in rows["shingles"]])
        # A class that several tasks met counts once.
        ids, first = np.unique(classes, return_index=True)
        once = np.zeros(len(classes), bool)
        once[first] = True
        shingles = shingles[np.repeat(once, counts)]
        owner = np.repeat(np.searchsorted(ids, classes[once]), counts[once])
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
        df = np.diff(starts, append=len(shingles))
        shared = np.bincount(owner[np.repeat(df > 1, df)], minlength=len(ids))
        often = df >= LEAST_FREQUENT
        names = (np.int64(rows["bucket"].iloc[0]) << np.int64(32)) | shingles[starts[often]].astype(np.int64)
        return pd.DataFrame(
            {
                "kind": np.concatenate([np.zeros(len(ids), np.int32), np.ones(len(names), np.int32)]),
                "id": np.concatenate([ids, names]),
                "n": np.concatenate([shared, df[often]]),
            }
        )

    return counted


def _frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` shingles, those in the most classes: sorted names and their counts."""
    often = counted.where("kind = 1")
    histogram = sorted(often.groupBy("n").count().orderBy(F.desc("n")).limit(most).collect(), reverse=True)
    total, cut = 0, None
    for n, count in histogram:
        total += count
        if total > most:
            break
        cut = n
    rows = often.where(F.col("n") >= cut).select("id", "n").toPandas() if cut is not None else pd.DataFrame({"id": [], "n": []})
    rows = rows.astype("int64").sort_values("id")
    return rows["id"].to_numpy(), rows["n"].to_numpy()


def rare_first(shingles: np.ndarray, names: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """A set in global order: by hash, the frequent shingles after all others and by their counts."""
    own = (shingles >> np.uint64(32 - bits)).astype(np.int64) if len(names) else np.zeros(0, np.int64)
    if not len(own):
        return shingles
    at = np.minimum(np.searchsorted(names, own), len(names) - 1)
    known = names[at] == own
    late = shingles[known]
    return np.concatenate([shingles[~known], late[np.lexsort((late, counts[at[known]]))]])


def search(ids: list[int], sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between the sets (of different sides, if there are two), as far as they join components.

    The sets are put in order of size and indexed. A query looks for sets after its own that are small
    enough; T, the overlap that a set of its own size would need, bounds that of all larger ones from below.
    As in DivideSkip the query's longest T - 1 lists are put aside: a set with T of its shingles is in at
    least one of the short lists. These are merged, counting occurrences; a set that could not reach its own
    required overlap even if it were in all long lists is out. The rest is probed for the long lists'
    shingles by binary search, in its sorted set. A set that is in the query's component already adds nothing.
    """
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    sets, ids, sides = [sets[i] for i in order], [ids[i] for i in order], np.array([sides[i] for i in order])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    by_shingle = np.argsort(flat, kind="stable")
    owner = owner[by_shingle]
    starts = np.flatnonzero(np.concatenate([[True], flat[by_shingle][1:] != flat[by_shingle][:-1]]))
    ends = np.append(starts[1:], len(flat))
    lists = np.empty(len(flat), np.int64)
    lists[by_shingle] = np.repeat(np.arange(len(starts)), ends - starts)
    offsets = np.cumsum(sizes) - sizes
    two_sided = len(set(sides.tolist())) > 1
    roots = np.arange(len(ids))

    def root(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    links = []
    for q in range(len(ids)):
        n = int(sizes[q])
        upto = int(np.searchsorted(sizes, 100 * n // percent, "right"))
        if upto <= q + 1:
            continue
        mine = lists[offsets[q] : offsets[q] + n]
        lengths = ends[mine] - starts[mine]
        by_length = np.argsort(lengths, kind="stable")
        long = least_overlap(n, n, percent) - 1
        short = mine[by_length[: n - long]]
        short = short[ends[short] - starts[short] > 1]
        if not len(short):
            continue
        merged = np.concatenate([owner[starts[x] : ends[x]] for x in short])
        found, counts = np.unique(merged[(merged > q) & (merged < upto)], return_counts=True)
        need = -(-percent * (n + sizes[found]) // (100 + percent))
        keep = counts + long >= need
        if two_sided:
            keep &= sides[found] != sides[q]
        rest = np.sort(sets[q][by_length[n - long :]])
        for other, count, least in zip(found[keep].tolist(), counts[keep].tolist(), need[keep].tolist(), strict=True):
            a, b = root(q), root(other)
            if a == b:
                continue
            there = sets[other]
            at = np.minimum(np.searchsorted(there, rest), len(there) - 1)
            if count + int((there[at] == rest).sum()) >= least:
                roots[max(a, b)] = min(a, b)
                links.append((ids[q], ids[other]))
    return links


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Texts with equal shingle sets are one class from the start, so copies cost nothing further. One shuffle
    of packed lists counts, over all classes, in how many each shingle occurs. A class with so many shingles
    of its own that no other class can share enough with it is done; the others are the survivors. Their
    short lists (the shingles a linked set must have one of: all but the ``need - 1`` that come last in the
    global order, frequent ones last) are joined on the shingle, which gives clusters that no link leaves.
    Every cluster is searched in one task as long as its sets have at most ``block_tokens`` shingles; a
    larger one is dealt to blocks, and every pair of blocks is searched. The links of all tasks make the
    components.

    At most ``FREQUENT`` shingles are sent to all tasks; they set the order only, never the result. Shingles
    and classes are known by 64-bit hashes.

    Null text, empty text and text of white space have no shingles and are linked with nothing; their component is
    their own id. Texts of fewer than ``size`` words have one. Rows that are there twice are one class; a
    null id takes part, but is the smallest id only where there is no other. An empty table gives no rows.
    Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    light = materialise(source.select("doc_id", _sized(size)("text").alias("set")).select("doc_id", "set.*"), "sets")
    classes = materialise(
        light.where("n > 0").groupBy("class_id").agg(F.max("n").alias("n"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "classes"
    )
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = max(5, (int(total) // BUCKET_POSTINGS).bit_length())

    lists = source.select("text").mapInPandas(_pack_lists(size, bits), "bucket int, classes binary, counts binary, shingles binary")
    counted = materialise(lists.repartition(1 << bits, "bucket").groupBy("bucket").applyInPandas(_count_lists(bits), "kind int, id long, n long"), "counts")
    names, often = _frequent(counted, FREQUENT)
    shared = counted.where("kind = 0").groupBy(F.col("id").alias("class_id")).agg(F.sum("n").alias("shared"))
    prefix = F.col("n") - least_prefix(F.col("n"), percent) + 1
    survivors = materialise(classes.join(shared, "class_id").where(F.col("n") - F.col("shared") < prefix).select("class_id", "first_id"), "survivors")

    fetched = source.join(survivors.select("first_id"), source["doc_id"].eqNullSafe(F.col("first_id")), "left_semi")
    sets = materialise(fetched.select("text").mapInPandas(_sets(size), "class_id long, n int, shingles binary"), "survivor-sets")
    frequent = spark.sparkContext.broadcast((names, often))
    postings = materialise(sets.mapInPandas(_short_lists(frequent, bits, percent), "shingle long, class_id long"), "short-lists")
    met = postings.groupBy("shingle").agg(F.min("class_id").alias("a"), F.max("class_id").alias("last")).where("a <> last").select("shingle", "a")
    met = materialise(met, "met-lists")
    meets = postings.join(met, "shingle").where("a <> class_id").select("a", F.col("class_id").alias("b")).distinct()
    clusters = components(meets)
    clusters = clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct())

    members = sets.join(clusters.withColumnRenamed("node", "class_id"), "class_id").dropDuplicates(["class_id"])
    members = materialise(members, "members")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("blocks"))
    large = materialise(blocks.where("blocks > 1"), "large-clusters")
    work = members.join(large, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    work = work.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    work = work.select("root", "class_id", "shingles", "block", other)
    work = work.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class_id", "block", "shingles")
    dealt = work.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    links = dealt.mapInPandas(_search_runs(percent), "a long, b long")

    roots = components(links).withColumnRenamed("node", "class_id")
    named = classes.join(roots, "class_id", "left").select("class_id", "first_id", F.coalesce("root", "class_id").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("size")).where("size > 1")
    of_class = named.join(materialise(least, "least-ids"), "root", "left")
    of_class = of_class.select("class_id", F.coalesce("component_id", "first_id").alias("component_id"))
    # Only classes with several rows or links need the lookup; all other rows are their own component.
    wanted = classes.where("copies > 1").select("class_id").unionByName(roots.select("class_id")).unionByName(roots.select(F.col("root").alias("class_id")))
    of_class = materialise(of_class.join(wanted.distinct(), "class_id", "left_semi"), "class-components")
    return light.join(of_class, "class_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def least_prefix(n: Column, percent: int) -> Column:
    """ceil(n * percent / 100): the fewest common elements of a set with n elements and any set it is linked to."""
    return F.floor((n * percent + 99) / 100)


def _sets(size: int):
    def made(batches):
        for batch in batches:
            sets = [K.shingle_set(t, size) for t in batch["text"]]
            sets = [s for s in sets if len(s)]
            yield pd.DataFrame({"class_id": [class_of(s) for s in sets], "n": [len(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    return made


def _short_lists(frequent, bits: int, percent: int):
    def made(batches):
        names, counts = frequent.value
        for batch in batches:
            shingles, owners = [], []
            for own, raw in zip(batch["class_id"], batch["shingles"], strict=True):
                s = rare_first(np.frombuffer(raw, np.uint64), names, counts, bits)
                s = s[: len(s) + 1 + (-percent * len(s)) // 100]
                shingles.append(s.view(np.int64) if s.flags.c_contiguous else s.copy().view(np.int64))
                owners.append(np.full(len(s), own, np.int64))
            if shingles:
                yield pd.DataFrame({"shingle": np.concatenate(shingles), "class_id": np.concatenate(owners)})

    return made


def _search_runs(percent: int):
    def searched(batches):
        key, ids, sets, sides = None, [], [], []
        for batch in batches:
            for root, i, j, own, block, raw in batch.itertuples(index=False, name=None):
                if (root, i, j) != key:
                    if len(ids) > 1:
                        yield pd.DataFrame(search(ids, sets, sides, percent), columns=["a", "b"])
                    key, ids, sets, sides = (root, i, j), [], [], []
                ids.append(own)
                sets.append(np.frombuffer(raw, np.uint64))
                sides.append(block)
        if len(ids) > 1:
            yield pd.DataFrame(search(ids, sets, sides, percent), columns=["a", "b"])

    return searched


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, all columns kept.

    Rows with one id are one document and stay or go together; rows without an id stay.
    """
    found = near_duplicates(docs, doc_id, text, **settings)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("key"))
    return keyed.join(gone, keyed["key"] == gone["gone"], "left_anti").select("row.*")
