"""Matching lines against all pairs."""

import random

import brute

from threadloom.llm import lines as L


def texts(seed=2):
    rng = random.Random(seed)
    common = [" ".join(f"c{k}x{i}" for i in range(14)) for k in range(4)]
    rows = []
    for doc in range(40):
        parts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 16))) for _ in range(3)]
        line = rng.choice(common).split(" ")
        if rng.random() < 0.6:
            line[rng.choice((0, 7, 13))] = f"z{rng.randrange(20)}"
        parts.insert(rng.randrange(4), " ".join(line))
        rows.append((doc, "\n".join(parts)))
    return rows + [(50, None), (51, ""), (52, "a b c d e"), (53, "A B c d e\n\n"), (54, "one\ttwo\none  two\nthree"), (55, "Three\r\n \t\nfour one two")]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in L.matching_lines(df).collect():
        got.setdefault(r.doc_id, []).append(r.at)
    assert {k: sorted(v) for k, v in got.items()} == brute.kept_lines(rows)


def test_all_pairs(spark):
    check(spark, texts())


def test_without_sending_lists(spark, monkeypatch):
    monkeypatch.setattr(L, "SENT_ROWS", 0)
    monkeypatch.setattr(L, "frequent_slots", lambda shingles: list(range(0, L.SLOTS, 3)))
    check(spark, texts(9))


def test_texts_keep_their_other_lines(spark):
    rows = [(1, "same words in this line\nown", "s"), (2, "Same words in this line\nother\n", "s"), (3, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed string")
    got = {r.row.doc_id: (r.text, r.n_lines, r.n_removed, r.row.n_removed) for r in L.without_matching_lines(df).collect()}
    assert got == {1: ("same words in this line\nown", 2, 0, "s"), 2: ("other\n", 3, 1, "s"), 3: ("", 1, 0, "s")}


def test_odd_rows(odd_docs, no_docs):
    got = L.without_matching_lines(odd_docs)
    assert got.count() == odd_docs.count()
    gone = {(r.doc_id, r.at) for r in L.matching_lines(odd_docs).collect()}
    assert gone == {(2, 0), (7, 0), (9, 0), (10, 0), (None, 0)}
    assert L.without_matching_lines(no_docs).count() == 0


def test_sets_are_no_join_key(spark, monkeypatch):
    """A comparison of sets never reaches the join with all lines, which would make every line's set, and its words for every run."""
    frames = []
    write = L.materialise
    monkeypatch.setattr(L, "materialise", lambda df, name: (frames.append(df), write(df, name))[1])
    L.matching_lines(spark.createDataFrame(texts(), "doc_id long, text string")).count()
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in frames]
    assert any("Join" in p for p in plans)
    assert not any("transform(" in line for p in plans for line in p.split("\n") if "Join" in line or "Filter" in line)


def test_lines_of_one_passage_do_not_meet_by_it(spark, monkeypatch):
    """Lines with the same passage and many words of their own are compared with a few others, not with all; near copies still go."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(80)]
    rows = []
    for doc in range(200):
        line = list(passage)
        for at in rng.sample(range(80), 2 if doc % 10 == 0 else 9):
            line[at] = f"own{doc}x{at}"
        rows.append((doc, " ".join(line)))
    rows += [(1000 + doc, text + " more") for doc, text in rows[1:40:3]]
    pairs = []
    write = L.materialise

    def written(df, name):
        out = write(df, name)
        if name == "line-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(L, "materialise", written)
    check(spark, rows)
    assert sum(pairs) < 8 * len(rows)
