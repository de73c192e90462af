"""Documents packed into token sequences: local best fit, then best fit over the bins that stayed open."""

from __future__ import annotations

import itertools
import json
import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import kernels as K
from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
SLACK = 8
TASK_ITEMS = 200_000
CACHED_CHUNKS = 600_000
RUN_BYTES = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True

# The tokenizer's split into pieces, for lower-cased characters below U+0180: contractions, letters, single digits, other signs.
_PLAIN = [chr(c) for c in range(33, 0x180) if chr(c).isprintable() and chr(c) not in "\u0130\u0149"]
_LETTERS = "".join(c for c in _PLAIN if c.isalpha())
_DIGITS = "".join(c for c in _PLAIN if unicodedata.category(c)[0] == "N")
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+")
NOT_PLAIN = re.compile(f"[^{re.escape(''.join(_PLAIN))}]|<\\|")
WORD_END = "</w>"


# What is cut into pieces by whole arrays: printable ASCII and the letters U+00C0 to U+00FF, lower-cased; their UTF-8
# bytes are the lead byte 0xC3 and one more. Kinds: 0 white space, 1 letters, 2 digits, 3 other signs, 4 all else.
_LEAD = 0xC3
_KIND = np.full(256, 4, np.uint8)
_KIND[[ord(c) for c in map(chr, range(33, 127))]] = 3
_KIND[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KIND[[ord(c) for c in "0123456789"]] = 2
_KIND[_SPACE] = 0
_ASCII_LOWER = np.frombuffer(K.LOWER, np.uint8)
PIECE_BYTES = 64


def cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, stops, whole) of the pieces of ``data``, which begins and ends with a space.

    A chunk between white space of plain characters only is lower-cased and cut as the tokenizer does: contractions,
    runs of letters, single digits, runs of other signs. Any other chunk is one piece, as it stands, and marked whole.
    """
    inside = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, last = edges[::2], edges[1::2]
    kind, low = _KIND[data], _ASCII_LOWER[data]
    lead = data == _LEAD
    if lead.any():
        after = np.zeros(len(data), bool)
        after[1:] = lead[:-1]
        letter = after & (data != 0x97) & (data != 0xB7)
        kind[lead | letter] = 1
        low = low + (letter & (data < 0x9F)).astype(np.uint8) * np.uint8(32)
    odd = kind == 4
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if odd.any():
        odds = np.concatenate([[0], np.cumsum(odd)])
        bad = odds[last] > odds[first]
        turns = np.zeros(len(data) + 1, np.int8)
        turns[first[bad]] = 1
        turns[last[bad]] = -1
        whole = np.cumsum(turns[:-1], dtype=np.int8) > 0
        kind[whole] = 4
        low = np.where(whole, data, low)
    begins = inside.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    marks = np.flatnonzero((low[1:-1] == ord("'")) & (kind[1:-1] == 3) & (kind[:-2] != 3)) + 1
    if len(marks):
        one, two = low[marks + 1], low[np.minimum(marks + 2, len(low) - 1)]
        short = np.isin(one, list(b"stmd"))
        long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begins[marks[short | long] + 1] = False
        rests = np.concatenate([marks[short] + 2, marks[long] + 3])
        begins[rests] = inside[rests]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(inside[:-1] & (begins[1:] | ~inside[1:])) + 1
    return low, starts, stops, kind[starts] == 4


class PieceModel:
    """Token ids of single pieces: those of up to ``PIECE_BYTES`` bytes by a table of ranks, others by the tokenizer.

    A piece's last byte carries the end of a word, so in the table it is another byte, one that no plain piece has.
    Merging by the rank of what comes out is the same as by the list of merges, since ids rise along that list and
    every token comes out of its own bytes; a tokenizer whose ids don't rise takes the other way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.ends, self.ranked = self._ranks(path)

    def _ranks(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            return None, None
        # A byte-level token is written with a printable character for each byte.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        used = [b for b in range(33, 127) if not 65 <= b <= 90] + [_LEAD, *range(0x9F, 0xC0)]
        free = [b for b in range(256) if b not in used]
        end_of = dict(zip([b for b in used if b != _LEAD], free))
        ranks = {}
        for token, i in model["vocab"].items():
            closed = token.endswith(WORD_END)
            content = [byte_of[c] for c in token.removesuffix(WORD_END)]
            if content and set(content) <= set(used) and (not closed or content[-1] in end_of):
                ranks[bytes([*content[:-1], end_of[content[-1]] if closed else content[-1]])] = i
        ends = [bytes([end_of[b]]) if b in end_of else b"" for b in range(256)]
        return ends, tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each of the distinct plain ``pieces``."""
        if self.ranked is None:
            return self._by_model(pieces)
        encode, ends = self.ranked.encode_single_piece, self.ends
        out = [encode(p[:-1] + ends[p[-1]]) if len(p) <= PIECE_BYTES else None for p in pieces]
        far = [i for i, ids in enumerate(out) if ids is None]
        if far:
            for i, ids in zip(far, self._by_model([pieces[i] for i in far]), strict=True):
                out[i] = ids
        return out

    def _by_model(self, pieces: list[bytes]) -> list[list[int]]:
        if not pieces:
            return []
        ids = self.model.encode_batch_fast([b" ".join(pieces).decode()], add_special_tokens=False)[0].ids
        ends = (np.flatnonzero(self.closes[np.array(ids)]) + 1).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each of ``chunks``: plain Latin ones by their distinct pieces, all others by the whole tokenizer."""
        parts, whole, pieces = [], [], set()
        for i, chunk in enumerate(chunks):
            if NOT_PLAIN.search(chunk):
                whole.append(i)
                parts.append([])
            else:
                parts.append([p.encode() for p in PIECE.findall(chunk.lower())])
                pieces.update(parts[-1])
        new = list(pieces)
        known = dict(zip(new, self._by_model(new), strict=True))
        out = [[x for p in ps for x in known[p]] for ps in parts]
        if whole:
            for i, found in zip(whole, self.tokenizer.encode_batch_fast([chunks[i] for i in whole], add_special_tokens=False), strict=True):
                out[i] = found.ids
        return out


class Chunks:
    """The ids of the pieces met so far, one stretch each, found by the piece's 64-bit hash."""

    def __init__(self):
        self.slots: dict[int, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, hashes: list[int], found: list[list[int]]) -> None:
        self.slots.update(zip(hashes, range(len(self.slots), len(self.slots) + len(hashes)), strict=True))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])


def worker_chunks(path: str) -> dict:
    """What earlier tasks of this Python worker have made of this tokenizer and met with it, to be changed in place."""
    kept = sys.modules.setdefault("threadloom_worker_chunks", types.ModuleType("threadloom_worker_chunks"))
    return kept.__dict__.setdefault(path, {})


class ChunkEncoder:
    """Token ids of texts.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its pieces, one
    after the other. Plain texts are cut into the tokenizer's own pieces, others into chunks between ASCII white
    space (``cut``). A piece is encoded once and kept in a table of bounded size.
    """

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        self.cached, self.kept = cached, worker_chunks(path)
        if "model" not in self.kept:
            self.kept["model"] = PieceModel(path)

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        for first, end in K.runs_of(texts, RUN_BYTES):
            yield from self._run([t or b"" for t in texts[first:end]])

    def _run(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        low, starts, stops, whole = cut(np.frombuffer(b" %b " % b" ".join(texts), np.uint8))
        if not len(starts):
            yield from (np.zeros(0, np.uint32) for _ in texts)
            return
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        last = np.searchsorted(starts, text_ends, "right")
        hashes, at, which = np.unique(K.range_hashes(low, starts, stops), return_index=True, return_inverse=True)
        chunks = self.kept.setdefault("chunks", Chunks())
        if len(chunks.slots) + len(hashes) > max(self.cached, len(hashes)):
            chunks = self.kept["chunks"] = Chunks()
        slots = np.fromiter(map(chunks.slots.get, hashes.tolist(), itertools.repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(slots < 0)
        if len(new):
            blob, model = low.tobytes(), self.kept["model"]
            for some, learn in ((new[~whole[at[new]]], model.pieces), (new[whole[at[new]]], lambda found: model.chunks([c.decode() for c in found]))):
                found = [blob[a:b] for a, b in zip(starts[at[some]].tolist(), stops[at[some]].tolist(), strict=True)]
                slots[some] = np.arange(len(chunks.slots), len(chunks.slots) + len(some))
                chunks.add(hashes[some].tolist(), learn(found))
        ids, ends = K.taken(chunks.ids, chunks.ends, slots[which])
        ends = ends[last]
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield ids[a:b]


PIECES = "key long, doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def tokenise(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: key (unique), doc_id, piece, start, length, ids_crc32, ids; written once.

    A document is its text's ids and a closing 0; only one longer than ``capacity`` is cut, into pieces of
    ``capacity`` ids, the last one shorter. Null text: empty, a single 0. Repeated rows give pieces of their own.
    ``tokenizer`` is the path of a tokenizer file that every executor has.
    """

    def pieces(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, task, at = ChunkEncoder(tokenizer), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], encoder.encode(list(batch["text"])), strict=True):
                ids = np.append(ids, np.uint32(0))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((task + at, doc, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), part.astype(np.int32)))
                    at += 1
                    if len(rows) >= 2000:
                        yield _frame(rows)
                        rows = []
            if rows:
                yield _frame(rows)
            batch = rows = None
        K.give_back()

    # As text, since pandas would make floats of ids among which there are nulls.
    source = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return materialise(source.mapInPandas(pieces, PIECES), "pieces")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = [x.split()[0] for x in PIECES.split(", ")]
    out = pd.DataFrame(rows, columns=columns)
    out["doc_id"] = pd.array([None if x is None else int(x) for x in out["doc_id"]], dtype="Int64")
    return out


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Positions of ``lengths`` (longest first) by bin: each goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    open_frees = 0  # bit f: a bin with f tokens free
    for i, length in enumerate(lengths):
        fitting = open_frees >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            stack = by_free[free]
            at = stack.pop()
            if not stack:
                open_frees &= ~(1 << free)
            bins[at].append(i)
            free -= length
        else:
            at, free = len(bins), capacity - length
            bins.append([i])
        if free:
            by_free.setdefault(free, []).append(at)
            open_frees |= 1 << free
    return bins


MEMBERS = "array<struct<key:long,length:int,offset:long>>"


def dealt_by_fill(items: DataFrame, tasks: int) -> DataFrame:
    """``items`` over ``tasks`` partitions: each partition as it is now deals its items, sorted by fill, one by one.

    The order within a partition is total, so a task that runs again deals the same.
    """
    numbered = items.sortWithinPartitions("fill", "id").withColumn("dealt", F.monotonically_increasing_id())
    place, partition = F.col("dealt").bitwiseAND((1 << 33) - 1), F.shiftright("dealt", 33)
    return numbered.repartitionById(tasks, F.pmod(place + partition, F.lit(tasks)).cast("int")).drop("dealt")


def pack(items: DataFrame, key: str = "key", length: str = "length", capacity: int = CAPACITY, slack: int = SLACK, task_items: int = TASK_ITEMS) -> DataFrame:
    """A place for every item: key, sequence_id, offset. Lengths are 1 to ``capacity``.

    Every round deals the items to tasks of about ``task_items`` and packs each task's share by best fit,
    longest first. Bins with at most ``slack`` tokens free are done. The others go into the next round as
    items as long as they are full, in fewer tasks, until one task has packed all that was left. Every task
    gets its share of each length, so that what fits together meets (``dealt_by_fill``). After a
    round that joined next to nothing, only bins that can still be joined go on: best fit leaves at most one bin
    per task that is half full or less, every join needs one of these, and if any bin can take them, so can as
    many of the emptiest others. So at the end no two bins that are not nearly full fit together. A task's memory is
    bounded by ``task_items``, whatever the size of the table; each round reads only the open bins of the round
    before, from a written table, and only their number comes to the driver. An empty table gives no rows.
    """
    spark = items.sparkSession
    member = F.struct(F.col(key).cast("long").alias("key"), F.col(length).cast("int").alias("length"), F.lit(0).cast("long").alias("offset"))
    left = items.select(F.col(key).cast("long").alias("id"), F.col(length).cast("int").alias("fill"), F.array(member).alias("members"))
    done, number, count = [], 0, left.count()
    if not count:
        return items.select(F.col(key).cast("long").alias("key"), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    while True:
        tasks = -(-count // max(task_items, 4))
        last = tasks == 1

        def local(batches, number=number, last=last):
            rows = pd.concat(list(batches), ignore_index=True)
            rows = rows.sort_values(["fill", "id"], ascending=[False, True], ignore_index=True)
            fills, members = rows["fill"].tolist(), rows["members"].tolist()
            base = (number << 56) + (TaskContext.get().partitionId() << 32)
            out = []
            for at, bin_ in enumerate(best_fit(fills, capacity)):
                fill = sum(fills[i] for i in bin_)
                together, offset = [], 0
                for m in (m for i in bin_ for m in members[i]):
                    together.append({"key": m["key"], "length": m["length"], "offset": offset})
                    offset += m["length"]
                out.append((base + at, fill, together, last or capacity - fill <= slack))
                if len(out) >= 5000:
                    yield pd.DataFrame(out, columns=["id", "fill", "members", "done"])
                    out = []
            yield pd.DataFrame(out, columns=["id", "fill", "members", "done"])

        def guarded(batches, local=local):
            batches = [b for b in batches if len(b)]
            if batches:
                yield from local(batches)

        packed = materialise(dealt_by_fill(left, tasks).mapInPandas(guarded, f"id long, fill int, members {MEMBERS}, done boolean"), f"bins-{number}")
        done.append(packed.where("done"))
        left = packed.where("not done").select("id", "fill", "members")
        before, count = count, left.count()
        number += 1
        if not count:
            break
        if count > 0.98 * before:
            half = left.where(F.col("fill") <= capacity // 2).count()
            place = F.struct("fill", "id")
            others = left.where(F.col("fill") > capacity // 2).select(place.alias("place")).orderBy("place").limit(half)
            edge = others.agg(F.max("place.fill"), F.max_by("place.id", "place")).first() if half else (None, None)
            goes_on = F.col("fill") <= capacity // 2
            if edge[0] is not None:
                goes_on |= place <= F.struct(F.lit(edge[0]).alias("fill"), F.lit(edge[1]).alias("id"))
            done.append(left.where(~goes_on).withColumn("done", F.lit(True)))
            left = left.where(goes_on)
            count = min(2 * half, count)
            if not half:
                break
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    placed = bins.select(F.col("id").alias("sequence_id"), F.explode("members").alias("m"))
    return placed.select("m.key", "sequence_id", "m.offset")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **settings) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A sequence's ids are those of its pieces by offset. Rows, nulls and empty texts as in ``tokenise``.
    """
    pieces = tokenise(docs, tokenizer, doc_id, text, capacity)
    places = pack(pieces.select("key", "length"), capacity=capacity, **settings)
    return pieces.join(places, "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids; at most ``capacity`` ids are gathered in a row."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))

