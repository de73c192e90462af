"""Benchmark passages in documents: multi-pattern search with block shift tables over words."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm import kernels as K
from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
SLICE_WORDS = 500_000
BLOCK = 2


class WindowSearch:
    """Search tables for windows that all have ``length`` words.

    A block is the last two words (one, if windows have only one) of a stretch of text. ``shift`` says how
    far the search may move when it sees a block: as far as the block's last place in any window, at most
    the window's length less one. ``buckets`` holds, by the hash of the closing block, the windows that end
    in it; they are compared word by word.
    """

    def __init__(self, length: int, windows: dict[tuple, list[int]]):
        self.length, self.block = length, min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple]] = {}
        self.items = windows
        for window in windows:
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                left = length - end
                if left < self.shift.get(block, self.default):
                    self.shift[block] = left
            self.buckets.setdefault(window[-self.block :], []).append(window)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """Every place (first word, window)."""
        length, shift, default, buckets = self.length, self.shift, self.default, self.buckets
        n, end = len(words), length
        if self.block == 1:
            while end <= n:
                block = (words[end - 1],)
                step = shift.get(block, default)
                if not step:
                    yield from ((end - 1, w) for w in buckets[block])
                end += step or 1
            return
        while end <= n:
            block = (words[end - 2], words[end - 1])
            step = shift.get(block, default)
            if step:
                end += step
                continue
            here = tuple(words[end - length : end])
            for window in buckets[block]:
                if window == here:
                    yield end - length, window
            end += 1


def build_searches(items: list[tuple[int | None, bytes | None]], window: int = WINDOW) -> list[WindowSearch]:
    """One search for each length of window that occurs; items without words take no part."""
    by_length: dict[int, dict[tuple, list[int]]] = {}
    for item, text in items:
        words = K.alnum_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            owners = by_length.setdefault(size, {}).setdefault(tuple(words[i : i + size]), [])
            if item not in owners:
                owners.append(item)
    return [WindowSearch(size, windows) for size, windows in sorted(by_length.items())]


def scan_text(text: bytes | None, searches: list[WindowSearch]) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, covered stretches (from, to) in order and disjoint, and the items found."""
    words = K.alnum_words(text)
    spans, found = [], set()
    for search in searches:
        for start, window in search.find(words):
            spans.append((start, start + search.length))
            found.update(search.items[window])
    return len(words), merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _slices(benchmark: DataFrame, item_id: str, text: str, slice_words: int) -> Iterator[list[tuple]]:
    """The benchmark in lists of about ``slice_words`` words, one in memory at a time."""
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("binary")).distinct()
    part, size = [], 0
    for item, raw in rows.toLocalIterator():
        part.append((item, bytes(raw) if raw is not None else None))
        size += len(raw or b"") // 2 + 1
        if size >= slice_words:
            yield part
            part, size = [], 0
    if part:
        yield part


def with_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` beside ``found``: n_words, spans (word ranges inside windows), items.

    Windows are ``window`` consecutive words of an item; an item with fewer words is one window. The search
    tables hold at most about ``slice_words`` words of the benchmark at a time; a larger benchmark is taken
    in slices, each searched for in all documents, and the finds of a document are put together at the end.
    Documents are never shuffled for one slice.

    Null and empty texts have no words and no finds; items without words are never found; an item that is
    there twice counts once, a null item id is the item "null". Repeated rows of ``docs`` each give a row.
    An empty benchmark finds nothing. All columns of ``docs`` come through unread, whatever their names.
    """
    spark = docs.sparkSession
    source = docs.select(F.struct("*").alias("row"), F.col(text).cast("binary").alias("text"))
    slices = _slices(benchmark, item_id, item_text, slice_words)
    current = next(slices, [])
    following = next(slices, None)
    if following is None:
        return source.select("row", _searcher(spark, current, window)("text").alias("found"))
    source = materialise(source.withColumn("key", F.monotonically_increasing_id()), "texts")
    first = materialise(source.select("row", "key", _searcher(spark, current, window)("text").alias("found")), "finds")
    parts = []
    while following is not None:
        found = source.select("key", _searcher(spark, following, window)("text").alias("more"))
        parts.append(materialise(found.where("size(more.spans) > 0"), "finds"))
        following = next(slices, None)
    more = parts[0]
    for part in parts[1:]:
        more = more.unionByName(part)
    more = more.groupBy("key").agg(
        F.flatten(F.collect_list("more.spans")).alias("spans"), F.flatten(F.collect_list("more.items")).alias("items")
    )
    spans = F.concat("found.spans", F.coalesce("spans", F.array().cast(SPANS)))
    items = F.concat("found.items", F.coalesce("items", F.array().cast("array<string>")))
    return first.join(more, "key", "left").select(
        "row",
        F.struct(
            F.col("found.n_words").alias("n_words"),
            union_of(spans).alias("spans"),
            F.array_sort(F.array_distinct(items)).alias("items"),
        ).alias("found"),
    )


def _searcher(spark: SparkSession, items: list[tuple], window: int):
    shared = spark.sparkContext.broadcast(items)

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        searches = build_searches(shared.value, window)
        for texts in batches:
            rows = [scan_text(t, searches) for t in texts]
            yield pd.DataFrame(
                {
                    "n_words": [n for n, _, _ in rows],
                    "spans": [[{"start": a, "end": b} for a, b in s] for _, s, _ in rows],
                    "items": [sorted(str(i) if i is not None else "null" for i in found) for _, _, found in rows],
                }
            )

    return F.pandas_udf(search, FOUND)


def union_of(spans):
    """Overlapping or touching ranges made one."""

    def step(done, span):
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        head = F.slice(done, F.lit(1), F.size(done) - 1)
        joins = (F.size(done) > 0) & (span["start"] <= F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1)))
        return F.when(joins, F.concat(head, F.array(wider))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), step)


def contamination(found: Column) -> list[Column]:
    """The counts of a document's finds: n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return [
        found["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(found["items"], ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size(found["spans"]) > 0).alias("contaminated"),
    ]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with no benchmark window in them, all columns kept."""
    return with_passages(docs, benchmark, **settings).where(F.size("found.spans") == 0).select("row.*")
