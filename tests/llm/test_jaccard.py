"""Near duplicates against all pairs, on one block and on many."""

import random

import brute
import numpy as np
import pytest

from threadloom.llm import jaccard as J
from threadloom.llm.components import components


def family(seed=3):
    rng = random.Random(seed)
    rows, doc = [], 0
    for size in (1, 2, 5, 9):
        words = [f"w{rng.randrange(400)}" for _ in range(80)]
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            rows.append((doc, " ".join(copy)))
            doc += 1
    passage = " ".join(f"shared{i}" for i in range(12))
    rows += [(doc + i, passage + " " + " ".join(f"own{i}x{k}" for k in range(3 * i))) for i in range(8)]
    rows += [(doc + 20 + i, "one two three") for i in range(3)] + [(doc + 30, ""), (doc + 31, " ")]
    return rows


@pytest.mark.parametrize("block_tokens", [J.BLOCK_TOKENS, 100])
def test_all_pairs(spark, block_tokens):
    rows = family()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in J.near_duplicates(df, block_tokens=block_tokens).collect())
    assert got == brute.near_duplicates(rows)


def test_frequent_shingles_change_the_order_only(spark, monkeypatch):
    monkeypatch.setattr(J, "LEAST_FREQUENT", 2)
    rows = family(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in J.near_duplicates(df).collect()) == brute.near_duplicates(rows)


def test_search_finds_every_component():
    rng = np.random.default_rng(1)
    base = rng.choice(10_000, 50, replace=False)
    sets = []
    for _ in range(60):
        own = base.copy()
        own[rng.choice(50, rng.integers(0, 12), replace=False)] = rng.integers(10_000, 20_000)
        sets.append(np.unique(own[: rng.integers(40, 51)]).astype(np.uint64))
    links = J.search(list(range(60)), sets, [0] * 60, 80)

    def groups(pairs):
        up = list(range(60))
        for a, b in pairs:
            a, b = (next(r for r in iter(lambda x=[x]: x.__setitem__(0, up[x[0]]) or x[0], None) if up[r] == r) for x in (a, b))
            up[a] = b
        root = lambda x: x if up[x] == x else root(up[x])
        parts = {}
        for i in range(60):
            parts.setdefault(root(i), set()).add(i)
        return sorted(map(sorted, parts.values()))

    every = [(a, b) for a in range(60) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
    assert groups(links) == groups(every)


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_odd_rows(odd_docs, no_docs):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in J.near_duplicates(odd_docs).collect()}
    assert got[(3, 0)] == 3 and got[(4, 0)] == 4 and got[(5, 0)] == 5 and got[(9, 1)] == 8 and got[(7, 59_997)] == 6
    assert got[(10, 116)] == 1 and got[(2, 116)] == 1 and got[(None, 116)] == 1
    assert J.near_duplicates(no_docs).count() == 0
    kept = J.keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 11, 12]
