"""Toxicity scores: a bidirectional gated recurrent network with attention pooling over words and their characters."""

from __future__ import annotations

import io
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import kernels as K
from threadloom.llm.samples import labelled_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Half a window: any 32 words or fewer in a row are whole in some window.
WINDOW, STRIDE = 64, 32
HIDDEN, WIDTH = 8, 12
WORD_SLOTS, CHAR_SLOTS = 1 << 14, 1 << 14
SAMPLE = {1: 800, 0: 1600}
UPDATES = 300
CHUNK = 1024


class Words:
    """The words of some texts: per word a number, per number the hash of the word and its character runs.

    ``ids`` has the words of all texts in order, ``counts`` how many each text has. A text without words has
    one word that no other text can have.
    """

    def __init__(self, texts: list[bytes | None]):
        rows = [t.translate(K.ALNUM) if t else b"" for t in texts]
        rows = [r if not r.isspace() and r else b"\x01" for r in rows]
        data = np.frombuffer(b" %b " % b" ".join(rows), np.uint8)
        inside = data != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, stops = edges[::2], edges[1::2]
        text_ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) + 1)
        self.counts = np.diff(np.searchsorted(starts, text_ends, "right"), prepend=0)
        self.hashes, first, ids = np.unique(K.range_hashes(data, starts, stops), return_index=True, return_inverse=True)
        self.ids = ids.astype(np.int32)
        self.chars, self.ends = char_runs(data, starts[first], (stops - starts)[first])

    def merged(self, other: Words) -> None:
        """Take in more texts."""
        hashes, first = np.unique(np.concatenate([self.hashes, other.hashes]), return_index=True)
        self.ids = np.concatenate(
            [np.searchsorted(hashes, x.hashes)[x.ids].astype(np.int32) for x in (self, other)]
        )
        chars, ends = np.concatenate([self.chars, other.chars]), np.concatenate([self.ends, self.ends[-1] + other.ends[1:]])
        self.chars, self.ends = K.taken(chars, ends, first)
        self.hashes, self.counts = hashes, np.concatenate([self.counts, other.counts])

    def windows(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Windows of all texts, and how many each text has."""
        out, sizes, at = [], [], 0
        for n in self.counts.tolist():
            starts = window_starts(n)
            out.extend(self.ids[at + s : at + min(s + WINDOW, n)] for s in starts)
            sizes.append(len(starts))
            at += n
        return out, np.array(sizes)

    def word_slots(self) -> np.ndarray:
        return (self.hashes % np.uint64(WORD_SLOTS)).astype(np.int32)


def char_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of four bytes of every word, its edges marked as in <word>>, and where each word's runs end."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    shift = 3 * np.arange(len(lengths))
    inner = np.arange(ends[-1]) + np.repeat(shift, lengths)
    marked = np.full(ends[-1] + 3 * len(lengths), ord(">"), np.uint32)
    marked[ends[:-1] + shift] = ord("<")
    marked[inner + 1] = data[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)]
    runs = marked[inner] | marked[inner + 1] << 8 | marked[inner + 2] << 16 | marked[inner + 3] << 24
    return ((runs * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32), ends


def window_starts(n: int) -> range:
    """Overlapping windows over all n words; the last one reaches the end."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "words": draw(WORD_SLOTS, WIDTH, scale=0.05),
        "chars": draw(CHAR_SLOTS, WIDTH, scale=0.05),
        "into": draw(2, 3 * HIDDEN, WIDTH, scale=WIDTH**-0.5),
        "bias": np.zeros((2, 3 * HIDDEN, 1), np.float32),
        "step": draw(2, 3 * HIDDEN, HIDDEN, scale=HIDDEN**-0.5),
        "query": draw(2 * HIDDEN, scale=0.5),
        "out": draw(2 * HIDDEN, scale=0.5),
        "level": np.zeros(1, np.float32),
    }


def vectors(model: dict, word: np.ndarray, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One input vector per word: its own and the mean of its character runs'. ``ends`` starts with where the first begins."""
    sums = np.add.reduceat(model["chars"][chars], ends[:-1] - ends[0], axis=0)
    return model["words"][word] + sums / np.diff(ends)[:, None].astype(np.float32)


def projections(model: dict, made: np.ndarray) -> np.ndarray:
    """What each word sends into the gates of both directions: [2, words, 3H]."""
    return made @ model["into"].transpose(0, 2, 1) + model["bias"].transpose(0, 2, 1)


def _gate(x: np.ndarray) -> np.ndarray:
    """The hard sigmoid."""
    x *= np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(model: dict, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows. ``table``: [2, words, 3H]; ``ids``: [T, B] word numbers; ``mask``: [T, B], 1 where there is a word."""
    steps, batch = ids.shape
    full = bool(mask.all())
    h = np.zeros((2, HIDDEN, batch), np.float32)
    states = np.empty((steps, 2 * HIDDEN, batch), np.float32)
    x, rows = np.empty((2, 3 * HIDDEN, batch), np.float32), np.empty((batch, 3 * HIDDEN), np.float32)
    masks = np.stack([mask, mask[::-1]], axis=1)[:, :, None, :]
    tape = []
    for t in range(steps):
        back = steps - 1 - t
        for side, at in ((0, t), (1, back)):
            x[side] = np.take(table[side], ids[at], axis=0, out=rows, mode="clip").T
        a = model["step"] @ h
        q = a[:, 2 * HIDDEN :]
        gates = _gate(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = r * q
        n += x[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        if not full:
            new *= masks[t]
        if keep:
            tape.append((h, z, r, q, n))
        h = new
        states[t, :HIDDEN] = h[0]
        states[back, HIDDEN:] = h[1]
    scores = model["query"] @ states
    if not full:
        scores += (mask - 1) * np.float32(1e9)
    scores -= scores.max(axis=0)
    weights = np.exp(scores, out=scores)
    weights /= weights.sum(axis=0)
    pooled = np.einsum("tb,thb->hb", weights, states)
    logits = model["out"] @ pooled + model["level"]
    return (logits, (tape, masks, states, weights, pooled)) if keep else logits


def backward(model: dict, kept: tuple, dlogits: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the model's own parts, and of what the words sent in: [T, 2, 3H, B] in each direction's own time."""
    tape, masks, states, weights, pooled = kept
    steps = len(tape)
    grads = {"out": pooled @ dlogits, "level": np.array([dlogits.sum()], np.float32)}
    dpooled = model["out"][:, None] * dlogits
    dweights = np.einsum("hb,thb->tb", dpooled, states)
    dscores = weights * (dweights - (weights * dweights).sum(axis=0))
    grads["query"] = np.einsum("tb,thb->h", dscores, states)
    dstates = weights[:, None] * dpooled + dscores[:, None] * model["query"][:, None]
    dsent = np.empty((steps, 2, 3 * HIDDEN, states.shape[2]), np.float32)
    grads["step"] = np.zeros_like(model["step"])
    turned = model["step"].transpose(0, 2, 1)
    carry = np.zeros_like(tape[0][0])
    for t in range(steps - 1, -1, -1):
        h, z, r, q, n = tape[t]
        dh = (np.stack([dstates[t, :HIDDEN], dstates[steps - 1 - t, HIDDEN:]]) + carry) * masks[t]
        dn = dh * (1 - z) * (1 - n * n)
        # The hard sigmoid is flat at 0 and 1.
        dz = dh * (h - n) * np.float32(0.25) * ((z > 0) & (z < 1))
        dr = dn * q * np.float32(0.25) * ((r > 0) & (r < 1))
        dsent[t] = np.concatenate([dz, dr, dn], axis=1)
        da = np.concatenate([dz, dr, dn * r], axis=1)
        grads["step"] += da @ h.transpose(0, 2, 1)
        carry = dh * z + turned @ da
    return grads, dsent


def laid_out(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers [T, B] (0 where a window is shorter) and mask [T, B]."""
    lengths = np.fromiter(map(len, windows), np.int64, len(windows))
    steps = int(lengths.max())
    ids = np.zeros((len(windows), steps), np.int32)
    mask = np.arange(steps) < lengths[:, None]
    ids[mask] = np.concatenate(windows)
    return np.ascontiguousarray(ids.T), np.ascontiguousarray(mask.T.astype(np.float32))


def window_logits(model: dict, table: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """Logits of many windows, those of like length together."""
    out = np.empty(len(windows), np.float32)
    order = np.argsort([len(w) for w in windows], kind="stable")
    for at in range(0, len(order), CHUNK):
        part = order[at : at + CHUNK]
        out[part] = forward(model, table, *laid_out([windows[i] for i in part]))
    return out


def train(texts: list[bytes], labels: list[int], updates: int = UPDATES, seed: int = 7, rate: float = 0.1, batch: int = 64) -> dict:
    """A network for texts of which a label only says that some window of it is toxic, after about ``updates`` steps.

    In every epoch a text stands for itself with one window: a random one at first, then the one that
    scores highest, mostly, so that positives are learned where they are toxic and negatives where they look it.
    """
    rng, model = np.random.default_rng(seed), new_model(seed)
    squares = {k: np.full_like(v, 1e-4) for k, v in model.items()}
    y = np.array(labels, np.float32)
    words = None
    for first, end in K.runs_of(texts):
        some = Words(texts[first:end])
        words = words.merged(some) or words if words else some
    flat, sizes = words.windows()
    owners, firsts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
    word, chars, ends = words.word_slots(), words.chars, words.ends
    for epoch in range(-(-updates * batch // len(y))):
        chosen = rng.integers(0, sizes)
        if epoch >= 2:
            table = projections(model, vectors(model, word, chars, ends))
            best = np.lexsort((-window_logits(model, table, flat), owners))[firsts] - firsts
            chosen = np.where((y == 1) | (rng.random(len(y)) < 0.9), best, chosen)
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            ids, mask = laid_out([flat[i] for i in firsts[part] + chosen[part]])
            used, local = np.unique(ids, return_inverse=True)
            local = local.reshape(ids.shape).astype(np.int32)
            grams, local_ends = K.taken(chars, ends, used)
            runs = np.diff(local_ends)
            made = vectors(model, word[used], grams, local_ends)
            logits, kept = forward(model, projections(model, made), local, mask, keep=True)
            dlogits = ((_sigmoid(logits) - y[part]) / len(part)).astype(np.float32)
            grads, dsent = backward(model, kept, dlogits)
            dtable = np.stack([_sum_rows(ids_, dsent[:, k].transpose(0, 2, 1), len(used)) for k, ids_ in enumerate((local, local[::-1]))])
            grads["bias"] = dtable.sum(axis=1)[..., None]
            grads["into"] = dtable.transpose(0, 2, 1) @ made
            dmade = np.einsum("kvg,kgw->vw", dtable, model["into"])
            shared = np.repeat(dmade / runs[:, None], runs, axis=0)
            for name, slots, rows in (("words", word[used], dmade), ("chars", grams, shared)):
                touched, inverse = np.unique(slots, return_inverse=True)
                g = _sum_rows(inverse, rows, len(touched))
                squares[name][touched] += g * g
                model[name][touched] -= rate * g / np.sqrt(squares[name][touched])
            for name, g in grads.items():
                squares[name] += g * g
                model[name] -= (rate * g / np.sqrt(squares[name])).astype(np.float32)
    return model


def _sum_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    index = index.ravel()
    rows = rows.reshape(len(index), -1)
    return np.stack([np.bincount(index, rows[:, d], n) for d in range(rows.shape[1])], axis=1).astype(np.float32)


def score_texts(model: dict, texts: list[bytes | None]) -> np.ndarray:
    """Scores of whole texts: the highest of all their windows. Memory follows the longest text and the size of a run."""
    out = np.empty(len(texts))
    for first, end in K.runs_of(texts):
        words = Words(texts[first:end])
        table = projections(model, vectors(model, words.word_slots(), words.chars, words.ends))
        flat, sizes = words.windows()
        out[first:end] = np.maximum.reduceat(window_logits(model, table, flat), np.cumsum(sizes) - sizes)
    return _sigmoid(out)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: dict[int, int] = SAMPLE, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", updates: int = UPDATES) -> dict | None:
    """The network, trained in one task on at most ``sample`` documents of each label (whole texts).

    Only the network's numbers come to the driver. None if the labels don't hold both values.
    """
    rows = labelled_sample(docs, labels, label, learn, sample, doc_id, text)

    def learned(batches):
        held = [(bytes(t), y) for b in batches for t, y in zip(b["text"], b["label"], strict=True)]
        if len({y for _, y in held}) > 1:
            out = io.BytesIO()
            np.savez(out, **train([t for t, _ in held], [y for _, y in held], updates))
            yield pd.DataFrame({"model": [out.getvalue()]})

    found = rows.repartition(1).sortWithinPartitions("spread").mapInPandas(learned, "model binary").collect()
    return dict(np.load(io.BytesIO(bytes(found[0][0])))) if found else None


def toxicity_score(spark: SparkSession, model: dict | None, text: Column) -> Column:
    """The score of every whole text, 0 to 1. Null and empty texts are one empty word; without a model all get 0.5.

    Texts come as an Arrow column and are taken out of it a run at a time, so a worker holds a batch once.
    """
    if model is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(model)

    def scores(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        runs = [score_texts(shared.value, texts.slice(first, end - first).to_pylist()) for first, end in K.runs_of_sizes(sizes.tolist())]
        K.give_back()
        return pa.array(np.concatenate([np.empty(0), *runs]), pa.float64())

    return F.arrow_udf(scores, "double")(text.cast("binary"))


def drop_toxic(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.7, text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept."""
    model = fit(docs, labels, learn, text=text, **settings)
    scored = docs.select(F.struct("*").alias("row"), toxicity_score(docs.sparkSession, model, F.col(text)).alias("score"))
    return scored.where(F.col("score") < threshold).select("row.*")
