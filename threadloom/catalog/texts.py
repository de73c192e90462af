"""Full-text queries over whole documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from threadloom.catalog.registry import query, sql_fold, sql_tokens
from threadloom.functions import scalars as X
from threadloom.functions import text as TX
from threadloom.operators import aggregates as A
from threadloom.operators import filters as P
from threadloom.plans.search_index import SearchIndex, build_index
from threadloom.session import run_dir
from threadloom.streaming.ingest import track_matches

TOKENS = sql_tokens("body")
TERMS = ["für ", "étre", "covid-19", "que", "Ción", "mentre", "und", "ther-ble", "zueinen"]
WORDS = {
    "für ": "['fur']",
    "étre": "['etre']",
    "covid-19": "['covid', '19']",
    "que": "['que']",
    "Ción": "['cion']",
    "mentre": "['mentre']",
    "und": "['und']",
    "ther-ble": "['ther', 'ble']",
    "zueinen": "['zueinen']",
}


@query("text_any", f"SELECT tweet_id FROM docs WHERE list_has_any({TOKENS}, ['fur', 'etre', '19', 'covid'])")
def text_any(t):
    return t.docs.where(TX.matches("body", "FÜR étre covid-19 ")).select("tweet_id")


@query(
    "text_not",
    f"""
    SELECT tweet_id FROM docs WHERE list_has_any({TOKENS}, ['que', 'und'])
    AND NOT list_has_any({TOKENS}, ['covid', '19', 'etre', 'fur'])""",
)
def text_not(t):
    return t.docs.where(TX.matches("body", "que und -covid-19 -étre -für")).select("tweet_id")


@query(
    "text_negation_only",
    f"SELECT tweet_id, list_contains({TOKENS}, 'que') AS with_term, false AS negated_only FROM docs",
)
def text_negation_only(t):
    """A search of negations alone finds nothing, not even the documents without the term."""
    return t.docs.select(
        "tweet_id", TX.matches("body", "que").alias("with_term"), TX.matches("body", "-que").alias("negated_only")
    )


@query(
    "text_phrase",
    f"""
    SELECT tweet_id FROM docs
    WHERE contains(' ' || array_to_string({TOKENS}, ' ') || ' ', ' of the ')
      AND NOT contains(' ' || array_to_string({TOKENS}, ' ') || ' ', ' to the ')""",
)
def text_phrase(t):
    return t.docs.where(TX.matches("body", '"Of, the" -"to the"')).select("tweet_id")


@query(
    "text_or",
    f"""
    SELECT tweet_id, "user" FROM docs
    WHERE "user" IN ('src1', 'src2', 'src3', 'src4', 'src5') AND created_at >= TIMESTAMP '2020-02-10'
      AND (list_has_any({TOKENS}, ['fur', 'etre']) OR (list_has_any({TOKENS}, ['que']) AND NOT list_has_any({TOKENS}, ['un'])))""",
)
def text_or(t):
    keep = P.by_users(["src1", "src2", "src3", "src4", "src5"]) & P.since(dt.datetime(2020, 2, 10))
    return t.docs.where(keep & TX.matches_any("body", ["für étre", "que -un"])).select("tweet_id", "user")


_COUNTS = " UNION ALL ".join(
    f"SELECT '{term}' AS term, count(*) FILTER (list_has_any(toks, {words})) AS n FROM listed" for term, words in WORDS.items()
)


@query(
    "term_counts",
    f"WITH listed AS (SELECT {TOKENS} AS toks FROM docs WHERE tweet_id NOT IN (SELECT tweet_id FROM errors)) {_COUNTS}",
)
def term_counts(t):
    """Matches per term among listed ids only."""
    return A.term_counts(P.without_keys(t.docs, t.errors, "tweet_id"), "body", TERMS)


_FIRST = "CASE " + " ".join(f"WHEN list_has_any(toks, {w}) THEN {i}" for i, w in enumerate(WORDS.values(), 1)) + " END"
_LISTED = ", ".join(f"({i}, '{term}')" for i, term in enumerate(TERMS, 1))


_YIELD = f"""
WITH firsts AS (SELECT {_FIRST} AS position FROM (SELECT {TOKENS} AS toks FROM docs)),
listed(position, term) AS (VALUES {_LISTED}),
gains AS (SELECT l.position, l.term, count(f.position) AS gain
          FROM listed l LEFT JOIN firsts f ON f.position = l.position GROUP BY 1, 2)
SELECT position, term, gain, CAST(sum(gain) OVER (ORDER BY position) AS BIGINT) AS found,
       gain > 50 AND position > 1 AS changes
FROM gains"""


@query("term_yield", _YIELD)
def term_yield(t):
    return A.term_yield(t.docs, "body", TERMS, over=50)


def _index(t) -> SearchIndex:
    """The search table of all documents, in a folder of its own."""
    return build_index(t.docs, "tweet_id", "body", run_dir(t.spark, "search"), buckets=32, shards=4)


@query(
    "index_search",
    f"""
    SELECT tweet_id FROM docs
    WHERE (list_has_any({TOKENS}, ['que', 'und']) AND NOT list_has_any({TOKENS}, ['covid', '19', 'etre', 'fur']))
       OR (list_has_any({TOKENS}, ['fur', 'etre']))""",
)
def index_search(t):
    return _index(t).search("que und -covid-19 -étre -für", "für étre", "-que").withColumnRenamed("doc_id", "tweet_id")


@query(
    "index_phrase",
    f"""
    SELECT tweet_id FROM docs
    WHERE contains(' ' || array_to_string({TOKENS}, ' ') || ' ', ' of the ')
      AND NOT contains(' ' || array_to_string({TOKENS}, ' ') || ' ', ' to the ')""",
)
def index_phrase(t):
    return _index(t).search('"Of, the" -"to the"').withColumnRenamed("doc_id", "tweet_id")


@query(
    "index_term_counts",
    f"WITH listed AS (SELECT {TOKENS} AS toks FROM docs WHERE tweet_id NOT IN (SELECT tweet_id FROM errors)) {_COUNTS}",
)
def index_term_counts(t):
    index = _index(t)
    return index.term_counts(TERMS, within=P.without_keys(index.ids(), t.errors, "doc_id", "tweet_id"))


@query("index_term_yield", _YIELD)
def index_term_yield(t):
    return _index(t).term_yield(TERMS, over=50)


@query("doc_tokens", f"SELECT tweet_id, len({TOKENS}) AS n_tokens, len(list_distinct({TOKENS})) AS n_words FROM docs")
def doc_tokens(t):
    toks = TX.tokens("body")
    return t.docs.select(
        "tweet_id",
        F.size(toks).cast("long").alias("n_tokens"),
        F.size(F.array_distinct(toks)).cast("long").alias("n_words"),
    )


TRACKS = ["@vi", "que", "Für", "über_alles", "the", "é"]
_TRACK_TOKENS = rf"regexp_extract_all({sql_fold('text')}, '@?[\p{{L}}\p{{N}}_]+')"


@query(
    "track_match",
    f"""
    SELECT doc_id AS id, tracks.query AS query FROM documents
    JOIN (VALUES ('@vi', '@vi'), ('que', 'que'), ('Für', 'fur'), ('über_alles', 'uber_alles'), ('the', 'the'), ('é', 'e')) tracks(query, word)
      ON list_contains({_TRACK_TOKENS}, tracks.word)""",
)
def track_match(t):
    posts = t.table("documents").select(F.col("doc_id").alias("id"), "text")
    return track_matches(posts, TRACKS).select("id", "query")


@query(
    "language_filter",
    "SELECT tweet_id, lang FROM docs WHERE lang IN ('es')",
)
def language_filter(t):
    return t.docs.where(P.in_languages(["es"])).select("tweet_id", "lang")


@query(
    "short_texts",
    "SELECT id, length(text) AS n FROM threads WHERE parent IS NOT NULL AND length(text) < 100",
)
def short_texts(t):
    short = t.threads.where(P.is_reply() & P.shorter_than("text", 100))
    return short.select("id", X.code_points("text").cast("long").alias("n"))


@query("snippets", "SELECT tweet_id, substr(body, 1, 500) AS head, substr(body, 1, 200) AS start FROM docs")
def snippets(t):
    return t.docs.select("tweet_id", X.snippet("body", 500).alias("head"), X.snippet("body", 200).alias("start"))


@query(
    "scalar_sheet",
    rf"""
    SELECT tweet_id, lower(substr('@' || "user", 2)) AS account, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS iso,
           strftime(created_at, '%d-%b-%Y (%H:%M:%S)') AS spelled, date_diff('day', DATE '1970-01-01', CAST(created_at AS DATE)) AS day_number,
           CAST(created_at AS DATE) AS day, length(body) AS n_points, CAST(round(CAST(length(body) AS DECIMAL(18, 0)) * 0.001, 2) AS DOUBLE) AS thousands,
           trim(regexp_replace({sql_fold('title')}, '[^\p{{L}}\p{{N}}]+', '-', 'g'), '-') AS slug,
           TRY_CAST("user"[4:] AS BIGINT) AS number, date_diff('day', TIMESTAMP '2020-01-01', created_at) AS days,
           created_at AS parsed, array_to_string([title, lang], chr(10) || chr(10)) AS joined,
           trim(title, E' \t\n\r') AS stripped, len({sql_tokens('title')}) AS n_title_words
    FROM docs""",
)
def scalar_sheet(t):
    stripped = X.strip(F.concat(F.lit(" \n"), F.col("title"), F.lit("\t ")))
    return t.docs.select(
        "tweet_id",
        X.screen_name(F.concat(F.lit("@"), "user")).alias("account"),
        X.to_iso("created_at").alias("iso"),
        X.long_date("created_at").alias("spelled"),
        X.day_number("created_at").cast("long").alias("day_number"),
        X.day_of_number(X.day_number("created_at")).alias("day"),
        X.code_points("body").cast("long").alias("n_points"),
        X.scaled(F.length("body"), 1000).alias("thousands"),
        X.slug("title").alias("slug"),
        X.to_id(F.substring("user", 4, 20)).alias("number"),
        X.whole_days(F.expr("timestamp_ntz'2020-01-01 00:00:00'"), F.col("created_at")).alias("days"),
        X.unwrap_date(X.wrap_date("created_at")).alias("parsed"),
        X.join_blank_line(F.array("title", "lang")).alias("joined"),
        stripped.alias("stripped"),
        X.word_count("title").cast("long").alias("n_title_words"),
    )
