"""Mixing against a plain water-filling and a plain walk through the keys."""

import hashlib
import random
from fractions import Fraction

import pytest

from threadloom.llm import mixing as M


def plain_targets(totals, weights, percent, epochs):
    """Rounds over all sources in exact fractions."""
    want, clamped = Fraction(percent * sum(totals), 100), set()
    while len(clamped) < len(totals):
        left = want - sum(epochs * totals[i] for i in clamped)
        open_ = [i for i in range(len(totals)) if i not in clamped]
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * level > epochs * totals[i]}
        if not over:
            return [float(epochs * totals[i]) if i in clamped else float(weights[i] * level) for i in range(len(totals))]
        clamped |= over
    return [float(epochs * t) for t in totals]


@pytest.mark.parametrize("percent, epochs", [(150, 2), (50, 1), (290, 3), (400, 3)])
def test_targets(spark, percent, epochs):
    rng = random.Random(percent)
    totals = [rng.choice((0, 3, 50, 1000, 100_000)) + rng.randrange(9) for _ in range(40)]
    names = [f"s{i:02}" for i in range(39)] + [None]
    rows = [(n, t, (3, 1, 2)[i % 3]) for i, (n, t) in enumerate(zip(names, totals))]
    df = spark.createDataFrame(rows, "source string, total long, weight int")
    got = {r.source: r.target for r in M.filled(df, percent, epochs).collect()}
    wanted = plain_targets(totals, [w for _, _, w in rows], percent, epochs)
    assert [got[n] for n in names] == pytest.approx(wanted, rel=1e-12)


def test_sources_are_numbered_by_code_point(spark):
    names = [None, "b", "B", "é", "\U0001f600", "\uffee", "a", ""]
    df = spark.createDataFrame([(n, 5) for n in names], "source string, size long").repartition(4)
    got = {r.source: r.weight for r in M.weighed_sources(df).collect()}
    order = ["", "B", "a", "b", "é", "\uffee", "\U0001f600", None]
    assert got == {n: (3, 1, 2)[i % 3] for i, n in enumerate(order)}


def rows(seed=4, n=600):
    rng = random.Random(seed)
    out = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice((0, 1, 5, 40, 400)))), rng.choice(("a", "a", "a", "b", "c", None))) for i in range(n)]
    return out + [(n, None, "only null"), (n + 1, "", "b"), (n + 2, "one\u2003word\ttwo", "c"), (None, "no id", "c"), (None, "no id", "c"), (5, "again five", "a")]


def test_documents(spark):
    docs = rows()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = [r.asDict() for r in M.mix(df.repartition(5)).collect()]
    assert len(got) == len(docs)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        total, target = sum(r["size"] for r in own), own[0]["target"]
        assert all(r["source_size"] == total and r["target"] == target and r["taken"] == r["size"] * r["repeats"] <= 2 * r["size"] for r in own)
        # As near as whole documents come: off by half of the document at the edge at most.
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own) / 2 or total == 0
        key = lambda r: hashlib.md5(f"13:{r['doc_id']}".encode()).hexdigest()
        known = sorted((r for r in own if r["doc_id"] is not None and r["size"]), key=key)
        assert [r["repeats"] for r in known] == sorted((r["repeats"] for r in known), reverse=True)
    again = [r.asDict() for r in M.mix(df.repartition(2)).collect()]
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(rows(n=20), "doc_id long, text string, source string")
    plan = M.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_mixture_repeats_rows(spark):
    df = spark.createDataFrame(rows(n=60), "doc_id long, text string, source string")
    taken = sum(r.repeats for r in M.mix(df).collect())
    out = M.mixture(df).collect()
    assert len(out) == taken and {r.epoch for r in out} <= {1, 2}


def test_odd_rows(odd_docs, no_docs):
    assert M.mix(odd_docs, source="lang").count() == odd_docs.count()
    assert M.mix(no_docs, source="lang").count() == 0
    nothing = odd_docs.where("text is null or text = ''")
    assert {(r.target, r.taken) for r in M.mix(nothing, source="lang").collect()} == {(0.0, 0)}
