"""Text rules against a plain Python reading of them."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as TX


def py_fold(text):
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))


def py_tokens(text):
    return re.findall(r"[^\W_]+", py_fold(text))


def has_phrase(toks, words):
    return any(toks[i : i + len(words)] == words for i in range(len(toks)))


TEXTS = [
    "El COVID-19 llegó",
    "covid19 no es covid",
    "los 19 años",
    "SÍNTOMAS graves",
    "sintomas",
    "asintomatico",
    "pre-síntomas,fiebre",
    "índice de síntomas",
    "",
    "Wuhan",
    "el wuhanés",
    "¿Y tú, qué insulto progre eres?",
    "y tu que",
    "una ñandú_fiebre",
    "día 19/03",
    "fase\n2 de la fase",
    "x" * 5000 + " dengue",
]


def random_texts(n):
    rng = random.Random(3)
    words = ["covid", "19", "Síntomas", "fiebre", "fase", "ñu", "é", "que", "quE", "insulto", "y", "tú", "covid19", "_", "-"]
    glue = [" ", "-", "_", ", ", "\n", "", "/", "́ "]
    return ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    data = list(enumerate(TEXTS + random_texts(400)))
    return spark.createDataFrame(data, "id int, text string").cache(), dict(data)


def test_tokens(texts):
    df, plain = texts
    got = {r.id: r.toks for r in df.select("id", TX.tokens("text").alias("toks")).collect()}
    assert got == {i: py_tokens(t) for i, t in plain.items()}


@pytest.mark.parametrize(
    "search, expected",
    [
        ("covid-19", lambda t: {"covid", "19"} & set(t)),
        ("aislamiento  síntomas ", lambda t: {"aislamiento", "sintomas"} & set(t)),
        ("SINTOMAS fiebre -covid-19", lambda t: {"sintomas", "fiebre"} & set(t) and not {"covid", "19"} & set(t)),
        ('"Y tú qué insulto"', lambda t: has_phrase(t, ["y", "tu", "que", "insulto"])),
        ('"y tu" fase', lambda t: has_phrase(t, ["y", "tu"])),
        ('que -"que insulto"', lambda t: "que" in t and not has_phrase(t, ["que", "insulto"])),
        ("-covid", lambda t: False),
        ("", lambda t: False),
        ("é ñu", lambda t: {"e", "nu"} & set(t)),
    ],
)
def test_matches(texts, search, expected):
    df, plain = texts
    got = {r.id for r in df.where(TX.matches("text", search)).select("id").collect()}
    assert got == {i for i, t in plain.items() if expected(py_tokens(t))}


def test_null_text_matches_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id int, text string")
    assert df.select(TX.matches("text", "a").alias("m")).first().m is False


def test_positions(texts):
    df, plain = texts
    terms = ["fiebre", "covid-19 ", "Síntomas", "19", "que"]
    words = [set(TX.words_of(t)) for t in terms]
    got = {r.id: (r.all, r.first) for r in df.select("id", TX.matched_positions("text", terms).alias("all"), TX.first_position("text", terms).alias("first")).collect()}
    for i, t in plain.items():
        there = [n for n, w in enumerate(words, 1) if w & set(py_tokens(t))]
        assert got[i] == (there, there[0] if there else None)


def test_tracks(spark):
    cases = [
        ("hola @Infobae y @infobae2", ["@infobae"]),
        ("infobae sin arroba", []),
        ("@LaNacion: sos racista", ["@LANACION", "racista"]),
        ("mail@infobae", ["@infobae"]),
        ("@racista", []),
        ("racistas", []),
        ("MISÓGINO!", ["misógino"]),
        ("@abc_es y abc_es", ["@abc_es"]),
        ("@@infobae", ["@infobae"]),
    ]
    tracks = ["@infobae", "@LANACION", "@abc_es", "racista", "misógino"]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "id int, text string")
    got = {r.id: r.hits for r in df.select("id", TX.track_hits("text", tracks).alias("hits")).collect()}
    assert got == {i: c[1] for i, c in enumerate(cases)}
    by_tokens = F.array_intersect(F.array(*[F.lit(x) for x in ("@infobae", "@lanacion", "@abc_es", "racista", "misogino")]), TX.track_tokens("text"))
    sizes = df.select((F.size(by_tokens) == F.size(TX.track_hits("text", tracks))).alias("same")).collect()
    assert all(r.same for r in sizes)


def test_parse():
    q = TX.parse_search('salud -cuarentena -covid-19 "a b" -"c d"')
    assert q.terms == ("salud",) and q.banned_terms == ("cuarentena", "covid", "19")
    assert q.phrases == (("a", "b"),) and q.banned_phrases == (("c", "d"),)
