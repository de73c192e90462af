"""License notices in documents: an exact containment join of text blocks with templates."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm import kernels as K

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Usual wordings of notices, and the label each one gives.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-notice",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-2.0",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
}
THRESHOLD = 0.8
# Notices of up to so many words must stand there whole: one other word makes another license of them.
SHORT = 13


def block_words(templates: list[list[bytes]]) -> int:
    """Blocks start every so many words and are twice as long: any place of a template lies inside one."""
    return max(map(len, templates), default=1)


class Templates:
    """The templates' side of the join, tokens in global order (rarest first).

    A block of words contains a template when it has at least ``need`` = ceil(threshold * size) of the
    template's distinct words. Then it must have one of the template's ``size - need + 1`` rarest ones: the
    prefix, by which templates are found. Words that are in no template can't count, so a block is cut down
    to template words and put in the same order; what is left of both sides after a shared word bounds the
    overlap that is still possible (positional filter), and a block with fewer words than ``need`` is out
    (length filter).
    """

    def __init__(self, templates: dict[str, str], counts: dict[bytes, int], thresholds: dict[str, float]):
        self.words = {name: K.alnum_words(name.encode()) for name in templates}
        self.labels, self.stride = templates, block_words(list(self.words.values()))
        vocabulary = sorted({w for ws in self.words.values() for w in ws}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.tokens = {name: sorted({self.rank[w] for w in ws}) for name, ws in self.words.items() if ws}
        self.need = {name: max(1, math.ceil(thresholds[name] * len(t) - 1e-9)) for name, t in self.tokens.items()}
        self.index: dict[int, list[tuple[int, str]]] = {}
        for name, tokens in self.tokens.items():
            for i, token in enumerate(tokens[: len(tokens) - self.need[name] + 1]):
                self.index.setdefault(token, []).append((i, name))

    def blocks(self, words: list[bytes]):
        """(first word, sorted distinct template words) of every block that has any."""
        places = [(i, r) for i, r in enumerate(map(self.rank.get, words)) if r is not None]
        by_block: dict[int, set[int]] = {}
        for i, r in places:
            at = i // self.stride
            by_block.setdefault(at, set()).add(r)
            if at:
                by_block.setdefault(at - 1, set()).add(r)
        return [(at * self.stride, sorted(tokens)) for at, tokens in sorted(by_block.items())]

    def join(self, words: list[bytes]) -> list[tuple[int, str, float]]:
        """Every (block, template, containment) that meets the template's threshold."""
        out = []
        for start, block in self.blocks(words):
            seen = set()
            for j, token in enumerate(block):
                for i, name in self.index.get(token, ()):
                    if name in seen:
                        continue
                    seen.add(name)
                    mine, need = self.tokens[name], self.need[name]
                    # The first shared word: nothing before it is shared.
                    if len(block) < need or 1 + min(len(mine) - i - 1, len(block) - j - 1) < need:
                        continue
                    overlap = len(set(mine).intersection(block))
                    if overlap >= need:
                        out.append((start, name, overlap / len(mine)))
        return out


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField(
            "blocks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.LongType()),
                        T.StructField("label", T.StringType()),
                        T.StructField("containment", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def stands_whole(name: str, phrases: dict[str, str], short: int) -> bool:
    """Whether a template's words must all be there, in order and next to each other."""
    return name in phrases or len(K.alnum_words(name.encode())) <= short


def scan_text(text: bytes | None, table: Templates, phrases: dict[str, str], whole: set[str]) -> tuple:
    """Words, first words of phrase places, their labels, and the notice blocks.

    A phrase or short notice is a template of which a block must have every word; its places are then read off the block.
    """
    words = K.alnum_words(text)
    places, base, blocks = set(), set(), []
    for start, name, containment in table.join(words):
        if name not in whole:
            blocks.append((start, table.labels[name], containment))
            continue
        phrase = table.words[name]
        last = min(start + 2 * table.stride, len(words)) - len(phrase)
        found = [i for i in range(start, last + 1) if words[i : i + len(phrase)] == phrase]
        if name in phrases:
            places.update((i, name) for i in found)
            base.update(phrases[name] for _ in found[:1])
        elif found:
            blocks.append((start, table.labels[name], containment))
    return len(words), sorted(i for i, _ in places), sorted(base), blocks


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    threshold: float = THRESHOLD,
    short: int = SHORT,
) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` beside ``found``: n_words, places, base_labels, blocks.

    ``places`` are the first words of all phrase occurrences, ``blocks`` the blocks of words (start, label,
    containment) holding at least ``threshold`` of a notice's distinct words, or a whole notice, word after word,
    if it has at most ``short`` words. Two passes over the texts, no
    shuffle of them: the first counts in how many documents each template word occurs, over all documents
    (as many rows as there are template words reach the driver); the second joins. The templates are
    arguments, so the driver holds them anyway.

    Null and empty texts have no words. Repeated rows each give a row, an empty table none. Long texts are
    read whole, block by block. All columns of ``docs`` come through unread, whatever their names.
    """
    templates = {**phrases, **notices}
    vocabulary = {w for name in templates for w in K.alnum_words(name.encode())}
    source = docs.select(F.struct("*").alias("row"), F.col(text).cast("binary").alias("text"))

    def present(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            for t in batch["text"]:
                for w in vocabulary.intersection(K.alnum_words(t)):
                    counts[w] = counts.get(w, 0) + 1
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    counts = source.select("text").mapInPandas(present, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    whole = {name for name in templates if stands_whole(name, phrases, short)}
    thresholds = {name: 1.0 if name in whole else threshold for name in templates}
    table = Templates(templates, {bytes(r[0]): r[1] for r in counts.collect()}, thresholds)

    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [scan_text(t, table, phrases, whole) for t in texts]
        return pd.DataFrame(
            {
                "n_words": [r[0] for r in rows],
                "places": [r[1] for r in rows],
                "base_labels": [r[2] for r in rows],
                "blocks": [[{"start": a, "label": b, "containment": c} for a, b, c in r[3]] for r in rows],
            }
        )

    return source.select("row", F.pandas_udf(scan, FOUND)("text").alias("found"))
