"""Ranked search against scores of every document, one word at a time."""

import math
import random
from collections import Counter

import brute
import numpy as np

from threadloom.llm import lexical as X


def plain(docs, items, top=10):
    """(item, rank, doc, score) with whole-number scores of all documents."""
    counted = [(d, Counter(w)) for d, t in docs if (w := brute.alnum(t))]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, c in counted:
            m, score = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_words, 0
            for w in set(brute.alnum(text)):
                if w in c:
                    df = sum(w in o for _, o in counted)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[min(59, int(rng.expovariate(0.1)))] for _ in range(rng.randrange(40)))) for i in range(n)]
    docs += [(n + i, "same text W1 w2") for i in range(15)] + [(None, "same text W1 w2"), (7, "same text w1 w2"), (9_999, None), (9_998, "...")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))) for i in range(20)]
    return docs, items + [(20, "same text"), (21, None), (22, "no such"), (None, "w3 w3 w4"), (0, "w5"), (1, items[1][1])]


def check(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in X.search(d, q, **settings).collect()), key=repr) == plain(docs, items)


def test_all_documents(spark):
    check(spark, *corpus())


def test_slices_and_small_blocks(spark):
    check(spark, *corpus(2), slice_terms=30, block_docs=40)


def test_ranges_skip_but_lose_nothing(monkeypatch):
    """Every split of the lists into short and long ones gives the best of all sums."""
    monkeypatch.setattr(X, "FIRST_RANGE", 4)
    monkeypatch.setattr(X, "LAST_RANGE", 16)
    rng = np.random.default_rng(3)
    n = rng.integers(1, 50, 400)
    owners, terms, tfs = [], [], []
    for term, share in enumerate((0.9, 0.6, 0.5, 0.1, 0.02, 0.01)):
        found = np.flatnonzero(rng.random(400) < share)
        owners.append(found)
        terms.append(np.full(len(found), term))
        tfs.append(rng.integers(1, 4, len(found)))
    index = X.BlockLists(n, np.concatenate(owners), np.concatenate(terms), np.concatenate(tfs), np.array([100, 300, 500, 2000, 4000, 0]), 400, int(n.sum()))
    whole = np.zeros(400, np.int64)
    for term in range(6):
        places, adds, _ = index.list_of(term)
        whole[places] += adds
    wanted = [(int(i), int(whole[i])) for i in np.lexsort((np.arange(400), -whole))[:10] if whole[i] > 0]
    for share in (1, 2, 5, 32, 1000):
        assert index.best(list(range(6)), 10, share) == wanted


def test_large_counts_stay_exact():
    n = np.array([3, 10**7])
    assert X.norms(n, 10**11, 10**13).tolist() == [10 + 90 * 3 * 10**11 // 10**13, 10 + 90 * 10**7 * 10**11 // 10**13]


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "alpha1 beta7", "x"), (2, None, "x"), (3, "word59999", "x")], "item_id long, text string, doc_id string")
    got = X.search(odd_docs, items).collect()
    assert {r.doc_id for r in got if r.item_id == 3} == {6, 7} and {r.item_id for r in got} == {1, 3}
    assert X.search(no_docs, items).count() == 0
    assert X.search(odd_docs, items.limit(0)).count() == 0
