"""Benchmark windows against a plain search."""

import random

import brute

from threadloom.llm import decontamination as D


def tables(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(rng.choice((0, 1, 3, 9, 10, 14))))) for i in range(30)] + [(31, None), (5, "w1 w2, W3")]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(rng.randrange(0, 40))]
        if i % 3 == 0:
            parts[3:3] = (rng.choice(items)[1] or "").split()
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, "...")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def found(df, benchmark, **settings):
    rows = D.with_passages(df, benchmark, **settings).select("row.doc_id", "found.*").collect()
    return {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in rows}


def test_plain_search(spark):
    docs, items, df, benchmark = tables(spark)
    wanted = {i: brute.contamination(t, items) for i, t in docs}
    assert found(df, benchmark) == wanted
    assert found(df, benchmark, slice_words=40) == wanted


def test_odd_rows(odd_docs, no_docs, spark):
    items = spark.createDataFrame([(None, "one two"), (2, "")], "item_id long, text string")
    rows = D.with_passages(odd_docs, items).select("row.doc_id", "found.items").collect()
    assert {r.doc_id for r in rows if r["items"]} == {8, 9} and len(rows) == odd_docs.count()
    assert D.with_passages(no_docs, items).count() == 0
    assert D.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
    kept = D.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2


def test_skips_are_safe():
    search = D.WindowSearch(4, {tuple("abab"): [1], tuple("babb"): [2]})
    text = list("xababbabab")
    wanted = [(i, tuple(text[i : i + 4])) for i in range(7) if tuple(text[i : i + 4]) in {tuple("abab"), tuple("babb")}]
    assert sorted(search.find(text)) == wanted
