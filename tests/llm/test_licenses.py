"""License blocks against a scan of every block."""

import math

import brute

from threadloom.llm import licenses as L


def test_join_finds_every_block():
    templates = {**L.PHRASES, **L.NOTICES}
    thresholds = {t: 1.0 if t in L.PHRASES else 0.8 for t in templates}
    text = "x " * 40 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 33 + "CC BY-SA 4.0 licensed under " * 2
    words = [w.encode() for w in brute.alnum(text)]
    for counts in ({}, {w: i % 5 for i, w in enumerate(sorted(set(words)))}):
        table = L.Templates(templates, counts, thresholds)
        wanted = set()
        for start in range(0, len(words), table.stride):
            block = set(words[start : start + 2 * table.stride])
            for name in templates:
                tokens = set(brute.alnum(name))
                n = len({t.encode() for t in tokens} & block)
                if n >= math.ceil(thresholds[name] * len(tokens) - 1e-9):
                    wanted.add((start, name, n / len(tokens)))
        assert set(table.join(words)) == wanted


def test_odd_rows(odd_docs, no_docs):
    got = {r.row.doc_id: r.found for r in L.scan_licenses(odd_docs).collect()}
    assert got[11].places == [3] and got[11].base_labels == ["apache"] and {b.label for b in got[11].blocks} == {"apache-2.0"}
    assert got[3].n_words == 0 and got[3].places == [] and got[6].n_words == 60_000
    assert L.scan_licenses(no_docs).count() == 0


def test_short_notices_stand_whole(spark):
    texts = {
        1: "Released under the Apache License",
        2: "Licensed under CC BY 4.0",
        3: "The 4 papers were licensed by SA under rule 0",
        4: "Text. Licensed under CC BY-NC 4.0.",
        5: "Text. licensed under cc by-sa 4.0 and released under the MIT license",
        6: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        7: "This work is licensed under a Creative Commons Attribution 4.0 International License",
        8: "under the terms of the GNU Lesser General Public License",
        9: "The above copyright notice and this notice shall be included in all copies or substantial portions of this software",
        10: "x " * 200 + "all rights reserved. No part of this publication may be reproduced " + "y " * 200,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.row.doc_id: sorted({b.label for b in r.found.blocks}) for r in L.scan_licenses(docs).collect()}
    assert got == {
        1: [], 2: [], 3: [], 4: ["cc-by-nc-4.0"], 5: ["cc-by-sa-4.0", "mit-notice"], 6: [], 7: ["cc-by-4.0"], 8: ["lgpl"], 9: ["mit-notice"], 10: ["all-rights-reserved"],
    }
