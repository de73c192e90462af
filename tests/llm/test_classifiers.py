"""Both classifiers: gradients, held-out rows, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from threadloom.llm import quality as Q
from threadloom.llm import toxicity as X
from threadloom.llm.samples import fold, labelled_sample


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in X.new_model(3).items()}
    # Wide gates, so that none sits at a corner of the hard sigmoid.
    table = rng.standard_normal((2, 9, 3 * X.HIDDEN)) * 0.3
    windows = [rng.integers(0, 9, n) for n in (3, 5, 5, 1)]
    ids, mask = X.laid_out(windows)

    def loss(m, t):
        return float((X.forward(m, t.astype(np.float64), ids, mask) * np.array([1.0, -2.0, 0.5, 1.5])).sum())

    _, kept = X.forward(model, table, ids, mask, keep=True)
    grads, dsent = X.backward(model, kept, np.array([1.0, -2.0, 0.5, 1.5]))
    for name in ("step", "query", "out", "level"):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in model[name].shape)
            ends = []
            for h in (1e-2, -1e-2):
                other = {**model, name: model[name].copy()}
                other[name][at] += h
                ends.append(loss(other, table))
            assert abs((ends[0] - ends[1]) / 2e-2 - grads[name].reshape(model[name].shape)[at]) < 2e-2
    dtable = np.stack([X._sum_rows(i, dsent[:, k].transpose(0, 2, 1), 9) for k, i in enumerate((ids, ids[::-1]))])
    for _ in range(8):
        at = (int(rng.integers(2)), int(rng.integers(1, 9)), int(rng.integers(3 * X.HIDDEN)))
        ends = []
        for h in (1e-2, -1e-2):
            other = table.copy()
            other[at] += h
            ends.append(loss(model, other))
        assert abs((ends[0] - ends[1]) / 2e-2 - dtable[at]) < 2e-2


def toxic_texts(n, seed=0):
    rng = np.random.default_rng(seed)
    syllables = ["ba", "do", "ki", "lu", "men", "ra", "so", "ti", "va", "zu"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(int(rng.integers(5, 200)))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(int(rng.integers(1, 4))):
                words.insert(int(rng.integers(len(words))), rng.choice(["idiot", "scum"]) if rng.random() < 0.5 else "grush" + word())
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_network_learns_words_and_word_parts():
    rows = toxic_texts(700)
    model = X.train([t.encode() for _, t, _ in rows[:500]], [y for _, _, y in rows[:500]])
    scores = X.score_texts(model, [t.encode() for _, t, _ in rows[500:]])
    truth = np.array([y for _, _, y in rows[500:]])
    assert ((scores >= 0.7) == truth).mean() > 0.9
    many = X.score_texts(model, [t.encode() for _, t, _ in rows[500:]] * 3)
    assert np.allclose(many, np.tile(scores, 3), atol=1e-5)


def test_windows_cover_every_word():
    for n in (1, 10, 64, 65, 120, 121, 1000):
        seen = set()
        for s in X.window_starts(n):
            seen |= set(range(s, min(s + X.WINDOW, n)))
        assert seen == set(range(n))


def test_passages_of_half_a_window_are_whole_in_one():
    for n in (33, 64, 65, 120, 121, 500):
        starts = X.window_starts(n)
        for at in range(n - X.WINDOW // 2 + 1):
            assert any(s <= at and at + X.WINDOW // 2 <= min(s + X.WINDOW, n) for s in starts)


def test_words_of_texts():
    words = X.Words([b"One two ONE", None, b"", b"...", b"two"])
    assert words.counts.tolist() == [3, 1, 1, 1, 1]
    assert words.ids[0] == words.ids[2] and words.ids[1] == words.ids[6] and words.ids[3] == words.ids[4] == words.ids[5]
    other = X.Words([b"three two"])
    two = words.hashes[words.ids[1]]
    words.merged(other)
    assert words.counts.tolist() == [3, 1, 1, 1, 1, 2] and words.hashes[words.ids[-1]] == two
    assert sorted(np.diff(words.ends).tolist()) == [1, 3, 3, 5]


def test_toxicity_on_tables(spark, folder, odd_docs, no_docs):
    rows = toxic_texts(300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, None), (None, 1)], "doc_id long, toxic int")
    learn = fold(F.col("doc_id"), 3) != 1
    model = X.fit(docs, labels, learn)
    scored = docs.select("doc_id", X.toxicity_score(spark, model, F.col("text")).alias("score")).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held]) > 0.85
    odd = odd_docs.select(X.toxicity_score(spark, model, F.col("text")).alias("s")).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.s <= 1 for r in odd)
    assert X.fit(docs, labels.limit(0), learn) is None
    kept = X.drop_toxic(odd_docs, labels.limit(0), learn)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert no_docs.select(X.toxicity_score(spark, model, F.col("text"))).count() == 0


def test_quality(spark, folder, odd_docs):
    docs, labels = (spark.read.parquet(f"{folder.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    weights = Q.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    scored = docs.join(labels, "doc_id").where(fold(F.col("doc_id"), 5) == 0)
    rows = scored.select("quality", Q.quality_score(spark, weights, F.col("text")).alias("s")).collect()
    assert np.mean([(r.s >= 0.5) == bool(r.quality) for r in rows]) > 0.9
    odd = odd_docs.select(Q.quality_score(spark, weights, F.col("text")).alias("s")).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.s <= 1 for r in odd)
    none = Q.fit(docs, labels.limit(0), fold(F.col("doc_id"), 5) != 0)
    assert not none.any() and Q.score(b"x", none) == 0.5


def test_samples_are_bounded_and_deterministic(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "cast(id as string) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic").union(docs.selectExpr("doc_id", "1 - cast(doc_id % 2 as int)").limit(1))
    pick = lambda d: sorted(tuple(r) for r in labelled_sample(d, labels, "toxic", F.col("doc_id") > 10, {0: 7, 1: 9}).collect())
    first = pick(docs)
    assert first == pick(docs.repartition(5)) and sorted(r[2] for r in first) == [0] * 7 + [1] * 9
