"""Quality scores: logistic regression on hashed word n-grams, trained with FTRL updates."""

from __future__ import annotations

import io
import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import kernels as K
from threadloom.llm.samples import labelled_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 18
SAMPLE = 8000
EPOCHS = 3
# A word is a run of letters and digits or a run of other signs.
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-\x7f]+")


def features(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words and word pairs of a whole text, and their values (unit length). Slot 0 is the bias.

    A word that repeats the one before it counts as one fixed word, so repetition itself can be learned.
    """
    words = TOKEN.findall(text.translate(K.LOWER)) if text else []
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    ones = K.span_hashes(words, 1)
    ones = np.concatenate([ones[:1], np.where(ones[1:] == ones[:-1], np.uint64(1), ones[1:])])
    pairs = K.mix(ones[:-1] * np.uint64(0xD6E8FEB86659FD93) + ones[1:])
    slots, counts = np.unique(np.concatenate([ones, pairs]) >> np.uint64(64 - bits), return_counts=True)
    values = np.sqrt(counts)
    values /= np.sqrt(np.square(values).sum())
    return np.concatenate([[0], slots.astype(np.int64) + 1]), np.concatenate([[1.0], values])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights after ``epochs`` passes of follow-the-regularised-leader updates, one row at a time."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for slots, values, label in rows:
            w = _weights(z[slots], n[slots], alpha, beta, l1, l2)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / alpha
            z[slots] += g - sigma * w
            n[slots] += g * g
    return _weights(z, n, alpha, beta, l1, l2).astype(np.float32)


def _weights(z, n, alpha, beta, l1, l2):
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def score(text: bytes | None, weights: np.ndarray, bits: int = BITS) -> float:
    slots, values = features(text, bits)
    return float(1 / (1 + np.exp(-np.clip(weights[slots] @ values, -35, 35))))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, label: str = "quality", doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``sample`` labelled documents, half of them of each label.

    The features are made where the texts are; one task makes the updates, in hash order, on the bounded
    sample. Only the weights (2**bits numbers) come to the driver. Without labelled rows all weights are 0,
    and every score is 0.5.
    """
    rows = labelled_sample(docs, labels, label, learn, {0: sample // 2, 1: sample // 2}, doc_id, text)

    def make(batches):
        for batch in batches:
            made = [features(t, bits) for t in batch["text"]]
            yield pd.DataFrame(
                {"spread": batch["spread"], "label": batch["label"], "slots": [m[0].astype("<i4").tobytes() for m in made], "values": [m[1].astype("<f4").tobytes() for m in made]}
            )

    def learned(batches):
        held = [r for b in batches for r in zip(b["slots"], b["values"], b["label"], strict=True)]
        made = [(np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float), y) for s, v, y in held]
        if made:
            out = io.BytesIO()
            np.save(out, train(made, bits))
            yield pd.DataFrame({"weights": [out.getvalue()]})

    made = rows.mapInPandas(make, "spread long, label int, slots binary, values binary")
    found = made.repartition(1).sortWithinPartitions("spread").mapInPandas(learned, "weights binary").collect()
    return np.load(io.BytesIO(bytes(found[0][0]))) if found else np.zeros((1 << bits) + 1, np.float32)


def quality_score(spark, weights: np.ndarray, text: Column, bits: int = BITS) -> Column:
    """The score of every whole text, 0 to 1; null and empty texts get the bias alone. A row is never dropped."""
    shared = spark.sparkContext.broadcast(weights)

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([score(t, shared.value, bits) for t in texts], dtype="float64")

    return F.pandas_udf(scores, "double")(text.cast("binary"))
