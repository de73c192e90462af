"""Hashes of words and runs, also for words made to collide in sums of powers."""

import numpy as np
from pyspark.sql import functions as F

from threadloom.llm import jaccard, packing
from threadloom.llm import kernels as K
from threadloom.llm.queries import tokenizer_path


def thue_morse(n, swap):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_words_of_two_letters_keep_apart():
    for n in (1 << 10, 1 << 12):
        one, two = thue_morse(n, 0).encode(), thue_morse(n, 1).encode()
        assert K.span_hashes([one], 5)[0] != K.span_hashes([two], 5)[0]
        data = np.frombuffer(one + two, np.uint8)
        assert len(set(K.range_hashes(data, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2


def test_runs():
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"a" * 200]
    got = K.span_hashes(words, 3).tolist()
    assert len(got) == 5 and got[0] == got[3] and len(set(got)) == 4
    assert len(K.span_hashes(words[:2], 3)) == 1 and len(K.span_hashes([], 3)) == 0
    assert K.span_hashes([b"ab", b"c"], 2)[0] != K.span_hashes([b"a", b"bc"], 2)[0]
    assert K.span_hashes(words, 1).tolist()[0] == K.span_hashes([b"x", b"a"], 1).tolist()[1]


def test_documents_of_such_words(spark):
    rows = [(1, thue_morse(1 << 10, 0)), (2, thue_morse(1 << 10, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect()) == [(1, 1), (2, 2)]
    packed = packing.pack_documents(docs.repartition(1), tokenizer_path()).orderBy("doc_id").select("ids", F.col("doc_id")).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert [list(r.ids) for r in packed] == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for _, t in rows]


def test_freed_memory_goes_back():
    """What small blocks held is the system's again, though a block above them is still in use."""

    def held():
        return sum(int(line.split()[1]) for line in open("/proc/self/smaps_rollup") if line.startswith("Pss_Anon"))

    blocks = [bytes(3000) for _ in range(30_000)]
    last = bytes(3000)
    before = held()
    del blocks
    K.give_back()
    assert len(last) == 3000 and held() < before - 60_000
