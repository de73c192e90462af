"""Byte-level helpers that run inside tasks: words, shingle hashes, sets. No Spark in here."""

from __future__ import annotations

import ctypes
import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The code travels with the job, so executors need only numpy, pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
# Word characters of the strict split: digits, letters and every byte of a non-ASCII character.
ALNUM = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

_GENERATOR = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _GENERATOR.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LONG_RANGE = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; null has none."""
    return text.translate(ALNUM).split() if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; null has none."""
    return text.translate(LOWER).split() if text else []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of every run of ``size`` words, in order; fewer words: the whole sequence as one; none: empty.

    Every word has a hash of its own, and a run mixes the hashes of its words, so what runs have in common
    byte by byte plays no part.
    """
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    single = range_hashes(data, ends - lengths, ends)
    size = min(size, len(words))
    if size == 1:
        return single
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        runs = mix(runs + single[k : k + len(runs)])
    return runs


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of ``data``.

    A short range takes the difference of two running sums, brought back to offset zero. Such sums modulo 2^64
    are the same for certain long patterns of two letters, whatever the base, so ranges over ``LONG_RANGE``
    bytes, which are rare, take a cryptographic hash.
    """
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    far = np.flatnonzero(ends - starts > LONG_RANGE)
    if len(far):
        found = [hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in zip(starts[far].tolist(), ends[far].tolist())]
        hashes[far] = np.frombuffer(b"".join(found), "<u8")
    return hashes


def shingle_set(text: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(span_hashes(spaced_words(text), size))


def taken(chars: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``chars`` that the chosen rows have, and their new ends. ``ends`` starts with where the first begins."""
    runs = ends[chosen + 1] - ends[chosen]
    new = np.concatenate([[0], np.cumsum(runs)])
    return chars[np.repeat(ends[chosen] - new[:-1], runs) + np.arange(new[-1])], new


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker outlives its tasks, and its executor needs the room for the stages to come."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def runs_of(texts: list[bytes | None], size: int = 1_000_000):
    """(first, end) of runs of texts with about ``size`` bytes."""
    return runs_of_sizes([len(t or b"") for t in texts], size)


def runs_of_sizes(sizes: list[int], size: int = 1_000_000):
    """(first, end) of runs of texts, of which the ``sizes`` in bytes are known, with about ``size`` bytes."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held > size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)
