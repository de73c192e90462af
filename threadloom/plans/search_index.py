"""A search table: where every word of every document stands, stored in buckets of words.

``build_index`` reads the texts once. Searches then read the buckets of their own words and nothing else: a
query of three words over a table of 1,000 buckets opens three folders, however many texts there are.

Layout: ``<path>/words/bucket=<b>`` holds (term, shard, doc_id, places), sorted by term so that the Parquet reader
skips within a bucket, and ``<path>/texts`` holds the ids. ``shard`` spreads the documents of a word that
most texts have over several files and tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import text as TX

BUCKETS, SHARDS = 256, 16


def placed_words(docs: DataFrame, key: str, text: Column | str) -> DataFrame:
    """doc_id, place (from 0) and term of every word of every text; a null text has no words."""
    words = TX.tokens(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return docs.select(F.col(key).alias("doc_id"), F.posexplode(words).alias("place", "term"))


def word_postings(words: DataFrame, *by: str) -> DataFrame:
    """``by``, doc_id, term and the ascending places of the term in the text."""
    return words.groupBy(*by, "doc_id", "term").agg(F.array_sort(F.collect_list("place")).alias("places"))


def _shifted(places: str, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_index(docs: DataFrame, key: str, text: Column | str, path: str, buckets: int = BUCKETS, shards: int = SHARDS) -> SearchIndex:
    """Write the search table of ``docs``, unique by ``key``.

    One shuffle, by (bucket, shard): all places of a word in a text are in one task, so they are put together
    there without another one. A word that all texts have fills ``shards`` files.
    """
    words = placed_words(docs, key, text).withColumns(
        {"bucket": bucket_of(F.col("term"), buckets), "shard": F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")}
    )
    dealt = word_postings(words.repartition("bucket", "shard"), "bucket", "shard").sortWithinPartitions("bucket", "term", "doc_id")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/words")
    docs.select(F.col(key).alias("doc_id")).write.mode("overwrite").parquet(f"{path}/texts")
    return SearchIndex(docs.sparkSession, path, docs.schema[key].dataType, buckets)


class SearchIndex:
    """A written search table. Ids are named ``doc_id``; ``within`` narrows a search to the ids of a table."""

    def __init__(self, spark: SparkSession, path: str, id_type: T.DataType, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        fields = [("doc_id", id_type), ("term", T.StringType()), ("places", T.ArrayType(T.IntegerType())), ("shard", T.IntegerType()), ("bucket", T.IntegerType())]
        self.schema = T.StructType([T.StructField(n, t) for n, t in fields])
        self._bucket: dict[str, int] = {}

    def _buckets(self, words: Sequence[str]) -> list[int]:
        """The buckets of some words, by the same hash that wrote them; asked for once per word."""
        new = [w for w in dict.fromkeys(words) if w not in self._bucket]
        if new:
            listed = self.spark.createDataFrame([(w,) for w in new], "term string")
            self._bucket |= {r.term: r.bucket for r in listed.select("term", bucket_of(F.col("term"), self.buckets).alias("bucket")).collect()}
        return sorted({self._bucket[w] for w in words})

    def postings(self, words: Iterable[str]) -> DataFrame:
        """doc_id, term and places of the given words. Only their buckets are listed and read, and in them only row groups that can hold the words."""
        words = list(dict.fromkeys(words))
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/words")
        if not words:
            return rows.where(F.lit(False)).select("doc_id", "term", "places")
        return rows.where(F.col("bucket").isin(self._buckets(words)) & F.col("term").isin(words)).select("doc_id", "term", "places")

    def ids(self) -> DataFrame:
        """Every id, those of texts without words too."""
        return self.spark.read.schema(T.StructType([self.schema["doc_id"]])).parquet(f"{self.path}/texts")

    def with_any(self, words: Iterable[str]) -> DataFrame:
        """Ids of the texts that have one of the words."""
        return self.postings(words).select("doc_id").distinct()

    def with_phrase(self, words: Sequence[str]) -> DataFrame:
        """Ids of the texts in which the words stand one after another.

        The places of the i-th word, less i, are the starts it allows; a phrase stands where one start is
        allowed by every word. The lists of a text meet in one row, so the work is linear in its places.
        """
        distinct = list(dict.fromkeys(words))
        if len(distinct) == 1 == len(words):
            return self.with_any(words)
        offsets = {w: [i for i, x in enumerate(words) if x == w] for w in distinct}
        held = self.postings(distinct).groupBy("doc_id").agg(*[F.max(F.when(F.col("term") == w, F.col("places"))).alias(f"w{n}") for n, w in enumerate(distinct)])
        held = held.where(reduce(lambda a, b: a & b, [F.col(f"w{n}").isNotNull() for n in range(len(distinct))]))
        starts = [_shifted(f"w{n}", i) for n, w in enumerate(distinct) for i in offsets[w]]
        return held.where(F.size(reduce(F.array_intersect, starts)) > 0).select("doc_id")

    def _positive(self, query: TX.TextQuery) -> DataFrame | None:
        if query.phrases:
            found = [self.with_phrase(p) for p in query.phrases]
            return reduce(lambda a, b: a.join(b, "doc_id", "left_semi"), found)
        return self.with_any(query.terms) if query.terms else None

    def search(self, *searches: str | TX.TextQuery, within: DataFrame | None = None) -> DataFrame:
        """``doc_id`` of the texts that satisfy one of the search strings, each once; the rules are those of :func:`TX.matches`.

        Phrases meet by semi joins, what is excluded leaves by an anti join. A search without anything positive
        finds nothing.
        """
        found = None
        for search in searches:
            query = TX.parse_search(search) if isinstance(search, str) else search
            hits = self._positive(query)
            if hits is None:
                continue
            if query.banned_terms:
                hits = hits.join(self.with_any(query.banned_terms), "doc_id", "left_anti")
            for phrase in query.banned_phrases:
                hits = hits.join(self.with_phrase(phrase), "doc_id", "left_anti")
            found = hits if found is None else found.unionByName(hits)
        if found is None:
            return self.postings([]).select("doc_id")
        found = found.distinct() if len(searches) > 1 else found
        return found if within is None else found.join(within, "doc_id", "left_semi")

    def _listed(self, terms: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The terms by position, and (doc_id, position) of the terms a text has, a row for each of its words."""
        listed = self.spark.createDataFrame(list(enumerate(terms, 1)), "position int, term string")
        words = [(i, w) for i, t in enumerate(terms, 1) for w in TX.words_of(t)]
        owners = self.spark.createDataFrame(words, "position int, word string")
        rows = self.postings([w for _, w in words]).select("doc_id", "term")
        # As long as the list of terms.
        return listed, rows.join(F.broadcast(owners), F.col("term") == F.col("word")).select("doc_id", "position")

    def term_counts(self, terms: Sequence[str], within: DataFrame | None = None) -> DataFrame:
        """term and the number of texts with one of its words, zeros included."""
        listed, hits = self._listed(terms)
        if within is not None:
            hits = hits.join(within, "doc_id", "left_semi")
        counted = hits.distinct().groupBy("position").agg(F.count(F.lit(1)).alias("n"))
        return listed.join(counted, "position", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))

    def term_yield(self, terms: Sequence[str], over: int = 500) -> DataFrame:
        """Texts found by the first i terms, what the i-th adds, and whether that is more than ``over``."""
        listed, hits = self._listed(terms)
        gains = hits.groupBy("doc_id").agg(F.min("position").alias("position")).groupBy("position").agg(F.count(F.lit(1)).alias("gain"))
        # The window has no partition because the table is as long as the term list.
        running = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
        return (
            listed.join(gains, "position", "left")
            .withColumn("gain", F.coalesce("gain", F.lit(0)))
            .withColumn("found", F.sum("gain").over(running))
            .withColumn("changes", (F.abs("gain") > over) & (F.col("position") > 1))
        )
