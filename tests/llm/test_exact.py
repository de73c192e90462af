"""Exact copies: folding, hash collisions, odd rows."""

import hashlib

from pyspark.sql import functions as F

from threadloom.llm.exact import drop_exact_copies, exact_groups


def plain(rows):
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    norm = [(t or "").translate(strip) for _, t in rows]
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [k for k in range(len(rows)) if norm[k] == norm[i]]
        best = min(group, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0))
        same = rows[best][0] == doc and len(rows[best][1] or "") == len(rows[i][1] or "")
        out.append((doc, rows[best][0], len(group), same, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in exact_groups(odd_docs).collect()), key=repr) == plain(rows)


def test_colliding_hashes_are_told_apart(spark):
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda text: F.encode(F.char_length(text).cast("string"), "UTF-8")
    assert sorted((tuple(r) for r in exact_groups(df, content_hash=weak).collect()), key=repr) == plain(rows)


def test_empty_table_and_dropping(no_docs, spark):
    assert exact_groups(no_docs).count() == 0
    df = spark.createDataFrame([(1, "a b", "s"), (2, "a  b", "s"), (3, "ab", "s")], "doc_id long, text string, source string")
    assert [tuple(r) for r in drop_exact_copies(df).collect()] == [(2, "a  b", "s")]
