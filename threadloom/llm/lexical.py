"""Ranked lexical search: short posting lists summed first, then one bounded iterator among long lists that are skipped through."""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import kernels as K
from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
# Distinct words of the queries that are searched for in one go; more are taken in slices of whole queries.
SLICE_TERMS = 200_000
# Documents whose lists one search holds in memory.
BLOCK_DOCS = 50_000
# A list with a posting for fewer than one in so many documents of the block is short.
SHORT_SHARE = 32
FIRST_RANGE, LAST_RANGE = 512, 8_192
SALTS = 64

POSTINGS = "doc_id {id_type}, n long, terms array<int>, tfs array<int>"


def query_terms(text: bytes | None) -> list[bytes]:
    """The distinct words of a query, in order."""
    return list(dict.fromkeys(K.alnum_words(text)))


def _slices(queries: DataFrame, item_id: str, text: str, slice_terms: int) -> Iterator[list[tuple]]:
    """The queries in lists with about ``slice_terms`` words in all, one list in memory at a time."""
    rows = queries.select(F.col(item_id), F.col(text).cast("binary")).distinct()
    part, size = [], 0
    for item, raw in rows.toLocalIterator():
        terms = query_terms(bytes(raw) if raw is not None else None)
        part.append((item, terms))
        size += len(terms)
        if size >= slice_terms:
            yield part
            part, size = [], 0
    if part:
        yield part


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n, and the numbers and counts of the vocabulary's words in every document that has words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value.get
        for batch in batches:
            rows = []
            for doc, raw in zip(batch["doc_id"], batch["text"]):
                words = K.alnum_words(raw)
                if words:
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    rows.append((doc, len(words), list(found), list(found.values())))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "tfs"])

    # Ids go through as text: pandas would make floats of ids with nulls among them.
    source = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    found = source.mapInPandas(count, "doc_id string, n long, terms array<int>, tfs array<int>")
    return found.withColumn("doc_id", F.col("doc_id").cast(id_type))


def weight(n_docs: int, df: int) -> int:
    """Weight of a word that ``df`` of ``n_docs`` documents have."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """The length part of the score of documents with ``n`` words, in whole numbers."""
    if len(n) and 90 * int(n.max()) * n_docs < 2**63:
        return 10 + (90 * n * n_docs) // n_words
    return np.array([10 + (90 * int(x) * n_docs) // n_words for x in n], np.int64)


class BlockLists:
    """The posting lists of a block of documents, by word: places (ascending) and what each adds to a score."""

    def __init__(self, n: np.ndarray, owners: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int):
        self.size = len(n)
        length = 8 * norms(n, n_docs, n_words)
        order = np.argsort(terms, kind="stable")
        terms, owners, tfs = terms[order], owners[order], tfs[order].astype(np.int64)
        self.places = owners
        self.adds = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + length[owners]))
        self.starts = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.bounds = {}

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places, addends and the largest addend of a word."""
        a, b = self.starts[term], self.starts[term + 1]
        adds = self.adds[a:b]
        if term not in self.bounds:
            self.bounds[term] = int(adds.max()) if b > a else 0
        return self.places[a:b], adds, self.bounds[term]

    def best(self, terms: list[int], top: int, short_share: int = SHORT_SHARE) -> list[tuple[int, int]]:
        """(place, score) of the ``top`` best documents with a score above 0, best first, ties by place.

        The short lists are summed, term at a time, into one list of accumulators, which then is an iterator
        like the long lists: it has a largest value. Documents are taken in ranges, in order. The lists are
        ordered by their bounds; those that can't reach the current threshold even together are not essential:
        only documents of the others are candidates, and the rest is looked up (skipped to) for candidates
        that can still reach it.
        """
        lists = [x for x in map(self.list_of, terms) if len(x[0])]
        limit = max(1, self.size // short_share)
        short, long_ = [x for x in lists if len(x[0]) < limit], [x for x in lists if len(x[0]) >= limit]
        if short:
            places, inverse = np.unique(np.concatenate([p for p, _, _ in short]), return_inverse=True)
            sums = np.zeros(len(places), np.int64)
            np.add.at(sums, inverse, np.concatenate([a for _, a, _ in short]))
            long_.append((places, sums, int(sums.max())))
        long_.sort(key=lambda x: x[2])
        reach = np.cumsum([b for _, _, b in long_])
        kept: list[tuple[int, int]] = []
        threshold, start, step = 0, 0, FIRST_RANGE
        at = [0] * len(long_)
        while start < self.size:
            stop = min(self.size, start + step)
            # The lists up to here can't make a document reach the threshold (a tie with a later place doesn't count).
            first = int(np.searchsorted(reach, threshold, side="right")) if threshold else 0
            if first == len(long_):
                break
            ends = [int(np.searchsorted(p, stop)) if i >= first else at[i] for i, (p, _, _) in enumerate(long_)]
            score = np.zeros(stop - start, np.int64)
            for i in range(first, len(long_)):
                places, adds, _ = long_[i]
                score[places[at[i] : ends[i]] - start] += adds[at[i] : ends[i]]
            at = ends
            others = int(reach[first - 1]) if first else 0
            candidates = np.flatnonzero(score + others > threshold) if threshold else np.flatnonzero(score > 0)
            values = score[candidates]
            for i in range(first - 1, -1, -1):
                if not len(candidates):
                    break
                places, adds, _ = long_[i]
                found = np.minimum(np.searchsorted(places, candidates + start), len(places) - 1)
                values += np.where(places[found] == candidates + start, adds[found], 0)
                below = int(reach[i - 1]) if i else 0
                alive = values + below > threshold
                candidates, values = candidates[alive], values[alive]
            if len(candidates):
                order = np.lexsort((candidates, -values))[:top]
                kept = sorted(kept + [(int(candidates[i]) + start, int(values[i])) for i in order], key=lambda x: (-x[1], x[0]))[:top]
                threshold = kept[-1][1] if len(kept) == top else 0
            start, step = stop, min(LAST_RANGE, step * 2)
        return kept


def _search(lists: DataFrame, asked: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_words: int, top: int, block: int) -> DataFrame:
    """query (number), doc_id, score: the best documents of every block of every task."""
    shared = lists.sparkSession.sparkContext.broadcast((asked, weights))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= block:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, known = shared.value
        for part in blocks(batches):
            # Ties go by id, nulls last, so places are in that order.
            part = part.sort_values(["unknown", "doc_id"], kind="stable", ignore_index=True)
            counts = part["terms"].map(len).to_numpy()
            if not counts.sum():
                continue
            terms, tfs = np.concatenate(part["terms"].to_list()), np.concatenate(part["tfs"].to_list())
            index = BlockLists(part["n"].to_numpy(), np.repeat(np.arange(len(part)), counts), terms, tfs, known, n_docs, n_words)
            found = [(query, place, score) for query, wanted in queries for place, score in index.best(wanted, top)]
            if found:
                numbers, places, scores = zip(*found)
                yield pd.DataFrame({"query": numbers, "doc_id": part["doc_id"].to_numpy()[list(places)], "unknown": part["unknown"].to_numpy()[list(places)], "score": scores})

    id_type = lists.schema["doc_id"].dataType.simpleString()
    # A null id is sent as a 0 that is marked.
    known = lists.select(F.coalesce("doc_id", F.lit(0).cast(id_type)).alias("doc_id"), F.col("doc_id").isNull().alias("unknown"), "n", "terms", "tfs")
    found = known.mapInPandas(search, f"query long, doc_id {id_type}, unknown boolean, score long")
    return found.withColumn("part", F.spark_partition_id())


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slice_terms: int = SLICE_TERMS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` best documents of every query.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Scores are whole numbers
    (:func:`weight`, :func:`norms`): rare words weigh more, repeats add ever less, long documents count down.
    Equal scores are in order of document id; only scores above 0 are listed.

    The texts are read once for each slice of queries (``slice_terms`` words), which writes the postings of the
    queries' words; counts over all documents come from these. Then every task searches its own documents in
    blocks of ``block_docs`` (:meth:`BlockLists.best`), and the best of all blocks are merged, first in parts of
    the tasks, so that no task gets what all of them found for a query.

    Null and empty texts have no words and are never found, nor do they count. A query without words finds
    nothing and has no rows; a query that is there twice counts once, the same id with two texts gives two
    lists; a null query id is kept. Rows of ``docs`` with the same id are documents of their own; null ids
    come last among ties. Ids are numbers. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[doc_id].dataType.simpleString(), queries.schema[item_id].dataType.simpleString()
    parts = []
    for asked in _slices(queries, item_id, item_text, slice_terms):
        vocabulary: dict[bytes, int] = {}
        numbered = [(number, [vocabulary.setdefault(t, len(vocabulary)) for t in terms]) for number, (_, terms) in enumerate(asked)]
        lists = materialise(postings(docs, vocabulary, doc_id, text), "lexical-postings")
        totals = lists.agg(F.count("*"), F.sum("n")).first()
        n_docs, n_words = totals[0], totals[1] or 0
        if not n_docs:
            continue
        df = dict(lists.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        best = _search(lists, numbered, weights, n_docs, n_words, top, block_docs)
        names = spark.createDataFrame([(number, item) for number, (item, _) in enumerate(asked)], f"number long, item_id {item_type}")
        best = _first(best, top, "query", F.col("part") % SALTS)
        best = _first(best, top, "query").join(F.broadcast(names), F.col("query") == F.col("number"))
        parts.append(best.select("item_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("unknown"), F.col("doc_id")).alias("doc_id"), "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _first(found: DataFrame, top: int, *keys) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "unknown", "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
