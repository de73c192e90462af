"""The corpus pipeline: five stages over the documents, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontamination, jaccard, lines, packing, queries, toxicity
from threadloom.session import run_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of the toxicity query, learned from the labels of the stage's own documents."""
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"), queries.learns_toxicity())


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that match an earlier one; ``n_chars`` follows. A document of which no line is left goes."""
    found = lines.without_matching_lines(docs)
    left = found.where("n_removed < n_lines")
    changed = F.col("n_removed") > 0
    columns = [
        F.when(changed, F.col("text")).otherwise(F.col("row.text")).alias("text")
        if c == "text"
        else F.when(changed, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c)
        if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return left.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of linked documents."""
    return jaccard.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    packed = packing.pack_documents(docs, queries.tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

# A trained network decides in the first stage, so SQL can't say which documents the others get.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each returns is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = run_dir(spark, f"stage-{number + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
