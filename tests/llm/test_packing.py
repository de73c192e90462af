"""Token pieces against the tokenizer itself, and places that must fit."""

import json
import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import packing as P
from threadloom.llm.queries import tokenizer_path


def ids_of(text):
    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [0]


def test_chunks_give_the_tokenizers_ids():
    texts = ["It's  a\ttest of　spaces\x1cand\x1dmore", "Été ǅ ẞ ΣΣ x́", "<|endoftext|> a<|startoftext|>b", "", "\x85  123 !?!"]
    got = [x.tolist() for x in P.ChunkEncoder(tokenizer_path(), cached=3).encode([t.encode() for t in texts])]
    assert got == [ids_of(t)[:-1] for t in texts]


def test_any_text_gives_the_tokenizers_ids():
    signs = "ab stSTredlmv''\"#1230<|>ÉéßñÿÀ×÷ÞçḰ \u0000\x1c\x7f¿«Ωд字\n\tİſKªº²ł\u0301"
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 40))) for _ in range(8000)]
    texts += ["x" * 5000, "'" * 100 + "s", "don't'LL'rex'VE''s", "é" * 32, "é" * 33, "É" * 31 + "ab", "<|STARTOFTEXT|>"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts += [t.removesuffix(P.WORD_END) for t in tokenizer.get_vocab()]
    got = [x.tolist() for x in P.ChunkEncoder(tokenizer_path()).encode([t.encode() for t in texts])]
    assert got == [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_every_token_comes_out_of_its_own_bytes():
    """So merging by the rank of the result is merging by the list: a token has one pair, and its bytes come to that pair."""
    with open(tokenizer_path()) as file:
        model = json.load(file)["model"]
    merges = {tuple(m.split(" ") if isinstance(m, str) else m): n for n, m in enumerate(model["merges"])}
    assert len({a + b for a, b in merges}) == len(merges)
    for token in model["vocab"]:
        body = token.removesuffix(P.WORD_END) or token
        parts = [*body[:-1], body[-1] + token[len(body) :]]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: merges.get((parts[i], parts[i + 1]), len(merges)))
            assert (parts[best], parts[best + 1]) in merges, token
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        assert parts == [token]


def test_tokenizers_without_rising_ids_take_the_other_way(tmp_path):
    with open(tokenizer_path()) as file:
        spec = json.load(file)
    low, high = spec["model"]["vocab"], sorted(spec["model"]["vocab"].values())
    spec["model"]["vocab"] = {t: high[-1] - i for t, i in low.items()}
    path = str(tmp_path / "falling.json")
    with open(path, "w") as file:
        json.dump(spec, file)
    encoder, text = P.ChunkEncoder(path), "It's Été 2024, no more! " + "long" * 40
    assert encoder.kept["model"].ranked is None
    assert next(encoder.encode([text.encode()])).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def check(packed, capacity):
    rows = [r.asDict() for r in packed.collect()]
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return rows, places


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows, places = check(P.pack_documents(docs, tokenizer_path()), 2048)
    wanted = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(got.setdefault(r["doc_id"], [])) and r["piece"] == r["start"] // 2048
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["doc_id"]] += r["ids"]
    assert got == wanted
    assert len(places) <= -(-sum(map(len, wanted.values())) // 2048) + 1


def test_rounds_merge_open_bins(spark):
    rng = random.Random(1)
    items = spark.createDataFrame([(i, rng.randrange(1, 101)) for i in range(3000)], "key long, length int")
    packed = P.pack(items, capacity=100, slack=0, task_items=200)
    rows, places = check(packed.join(items, "key"), 100)
    assert sorted(r["key"] for r in rows) == list(range(3000))
    total = items.agg(F.sum("length")).first()[0]
    assert len(places) <= 1.03 * total / 100


def test_items_that_never_fit_together(spark):
    items = spark.createDataFrame([(i, 60) for i in range(500)], "key long, length int")
    _, places = check(P.pack(items, capacity=100, task_items=100).join(items, "key"), 100)
    assert len(places) == 500


def test_bins_of_different_tasks_meet(spark):
    lengths = [90] * 400 + [60] * 3 + [40] * 3
    items = spark.createDataFrame(list(enumerate(lengths)), "key long, length int")
    got = P.pack(items, capacity=100, slack=0, task_items=50).collect()
    assert sorted(r.key for r in got) == list(range(406))
    assert len({r.sequence_id for r in got}) == 403
    alone = spark.createDataFrame([(i, 90) for i in range(200)] + [(200, 40)], "key long, length int")
    assert len({r.sequence_id for r in P.pack(alone, capacity=100, slack=0, task_items=50).collect()}) == 201


def test_sequences(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20)
    packed = P.pack_documents(docs, tokenizer_path(), capacity=64).persist()
    whole = P.sequences(packed).agg(F.sum(F.size("ids")), F.max(F.size("ids"))).first()
    assert whole[0] == packed.agg(F.sum("length")).first()[0] and whole[1] <= 64
    packed.unpersist()


def test_odd_rows(odd_docs, no_docs):
    rows, _ = check(P.pack_documents(odd_docs, tokenizer_path()), 2048)
    assert sorted((r["doc_id"], r["length"]) for r in rows if r["doc_id"] in (3, 4, 5)) == [(3, 1), (4, 1), (5, 1)]
    assert sum(r["doc_id"] == 2 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert P.pack_documents(no_docs, tokenizer_path()).count() == 0
