"""The pipeline's stages against plain versions of them."""

import brute
import corpus_pipeline as C
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def run_stages(spark, docs, folder, tmp_path, upto):
    frames = [docs]
    for i, (_, stage) in enumerate(C.STAGES[:upto]):
        stage(spark, frames[-1], folder).write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
    return frames


def test_stages_follow_their_plain_versions(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = run_stages(spark, docs, folder, tmp_path, 5)
    rows = [{r.doc_id: r.asDict() for r in f.collect()} for f in frames[:5]]
    assert all(f.columns == docs.columns for f in frames[:5])
    assert set(rows[1]) <= set(rows[0])
    wanted = {}
    gone = brute.kept_lines([(i, r["text"]) for i, r in rows[1].items()])
    for i, r in rows[1].items():
        lines = r["text"].split("\n")
        left = [x for k, x in enumerate(lines) if k not in gone.get(i, ())]
        if left:
            text = "\n".join(left)
            wanted[i] = {**r, "text": text, "n_chars": len(text) if i in gone else r["n_chars"]}
    assert rows[2] == wanted
    same = brute.near_duplicates([(i, r["text"]) for i, r in rows[2].items()])
    assert set(rows[3]) == {i for i, _, c in same if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(rows[4]) == {i for i, r in rows[3].items() if not brute.contamination(r["text"], items)[1]}
    packed = frames[5].groupBy("doc_id").agg(F.min("start")).collect()
    assert {r.doc_id for r in packed} == set(rows[4])


def test_stages_take_odd_and_empty_tables(spark, folder, odd_docs, tmp_path):
    odd = odd_docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    frames = run_stages(spark, odd, folder, tmp_path / "odd", 5)
    assert frames[5].count() > 0
    empty = run_stages(spark, odd.limit(0), folder, tmp_path / "none", 5)
    assert empty[5].count() == 0
