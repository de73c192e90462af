"""Registered queries of the corpus operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontamination, exact, jaccard, lexical, licenses, lines, mixing, packing, pages, quality, toxicity, warc, whitening
from threadloom.llm.samples import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
SQL_ALNUM = rf"regexp_extract_all({SQL_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL_SPACED = rf"regexp_extract_all({SQL_LOWER}, '[^\x20\x09-\x0D]+')"


def licenses_sql() -> str:
    templates = {**licenses.PHRASES, **licenses.NOTICES}
    words = {name: licenses.K.alnum_words(name.encode()) for name in templates}
    stride = licenses.block_words(list(words.values()))
    whole = {name: licenses.stands_whole(name, licenses.PHRASES, licenses.SHORT) for name in templates}
    rows = ", ".join(
        f"({i}, '{label}', {str(name in licenses.PHRASES).lower()}, {str(whole[name]).lower()}, ['{"','".join(w.decode() for w in words[name])}'], {licenses.THRESHOLD})"
        for i, (name, label) in enumerate(templates.items())
    )
    return f"""
WITH templates(t, label, base, whole, phrase, least) AS (VALUES {rows}),
tokens AS (SELECT t, unnest(list_distinct(phrase)) AS w FROM templates WHERE NOT whole),
docs AS (SELECT doc_id, {SQL_ALNUM} AS words FROM documents),
numbered AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM docs),
shared AS (
  SELECT DISTINCT doc_id, b, t, w FROM (
    SELECT doc_id, t, w, i, unnest([i // {stride}, i // {stride} - 1]) AS b FROM numbered JOIN tokens USING (w)
  ) WHERE b >= 0),
held AS (
  SELECT doc_id, t, label, n / len(list_distinct(phrase)) AS containment
  FROM (SELECT doc_id, b, t, count(*) AS n FROM shared GROUP BY ALL) JOIN templates USING (t)
  WHERE n >= ceil(least * len(list_distinct(phrase)) - 1e-9)),
places AS (
  SELECT doc_id, label, base, i FROM (SELECT n.doc_id, n.i, t.label, t.base, t.phrase FROM numbered n JOIN templates t ON t.whole AND n.w = t.phrase[1])
  JOIN docs USING (doc_id) WHERE words[i + 1:i + len(phrase)] = phrase),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
  FROM places WHERE base GROUP BY 1),
every AS (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM (
    SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM held) GROUP BY 1),
best AS (SELECT doc_id, max(containment) AS score FROM (SELECT doc_id, containment FROM held UNION ALL SELECT doc_id, 1.0::DOUBLE FROM places) GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE round(coalesce(score, 0), 9) END AS score
FROM docs d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)"""


@query("op1_licenses", licenses_sql())
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    labels = F.array_sort(F.array_union("found.base_labels", F.array_distinct("found.blocks.label")))
    n_base = F.size("found.places").cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        n_base.alias("n_base"),
        F.array_min("found.places").alias("first_word"),
        F.array_max("found.places").alias("last_word"),
        F.array_join("found.base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.round(F.coalesce(F.array_max("found.blocks.containment"), F.lit(0.0)), 9)).alias("score"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 2048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_pages")
def op3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = pages.extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "template")


@query("op4_warc")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response."""
    responses = warc.responses_of(table(spark, sf_dir, "pages"))
    records = warc.derivatives(responses)
    return records.select(
        "record_id", "warc_type", "refers_to", "target_uri", "date", "content_type", "payload_digest", "block_digest", "content_length",
        F.array_join(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])), "\n").alias("headers"),
        F.decode("block", "UTF-8").alias("block"),
    )


@query(
    "op5_exact",
    r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
placed AS (
  SELECT doc_id, n, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id FROM keyed)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM placed""",
)
def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document, white space aside."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = lambda: fold(F.col("doc_id"), 5) == 0
    weights = quality.fit(docs, labels, ~held_out())
    scored = docs.select("doc_id", held_out().alias("held_out"), quality.quality_score(spark, weights, F.col("text")).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def lines_sql() -> str:
    """Lines as lists of words; sets as lists of runs; the join by any shared run, nothing else left out."""
    return rf"""
WITH numbered AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
line AS (
  SELECT doc_id, unnest(range(len(parts))) AS ln, regexp_extract_all(lower(unnest(parts)), '[^\x20\x09-\x0D]+') AS w FROM numbered),
sets AS (
  SELECT doc_id, ln, list_sort(list_distinct([array_to_string(w[i + 1:i + {lines.SIZE}], ' ') FOR i IN range(greatest(len(w) - {lines.SIZE - 1}, 1))])) AS s
  FROM line WHERE len(w) > 0),
classes AS (
  SELECT s, min((doc_id, ln)) AS first, row_number() OVER () AS c, len(s) AS n FROM sets GROUP BY s),
runs AS (SELECT c, first, n, unnest(s) AS run FROM classes),
linked AS (
  SELECT b.c FROM runs a JOIN runs b ON a.run = b.run AND a.first < b.first AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {lines.PERCENT} * (a.n + b.n - count(*))),
removed AS (
  SELECT DISTINCT sets.doc_id, sets.ln FROM sets JOIN classes USING (s)
  WHERE (doc_id, ln) <> first OR c IN (SELECT c FROM linked)),
gone AS (SELECT doc_id, list(ln) AS lns FROM removed GROUP BY 1)
SELECT doc_id, len(parts)::BIGINT AS n_lines, coalesce(len(lns), 0)::BIGINT AS n_removed,
       array_to_string([parts[i + 1] FOR i IN range(len(parts)) IF NOT coalesce(list_contains(lns, i), false)], chr(10)) AS text
FROM numbered LEFT JOIN gone USING (doc_id)"""


@query("op7_lines", lines_sql())
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that match an earlier one."""
    found = lines.without_matching_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


@query("op8_jaccard")
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and near-duplicate components of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op9_decontamination",
    rf"""
WITH docs AS (SELECT doc_id, {SQL_ALNUM} AS words FROM documents),
items AS (SELECT item_id, {SQL_ALNUM} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(words[i + 1:i + least(10, len(words))], ' ') AS win, least(10, len(words)) AS n
  FROM (SELECT item_id, words, unnest(range(greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(words[i + 1:i + n], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(len(words) - n + 1)) AS i FROM docs, lengths WHERE len(words) >= n)),
hits AS (SELECT doc_id, i, places.n AS n, item_id FROM places JOIN windows USING (win, n)),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, array_to_string(list_sort(list(id)), ',') AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontamination.with_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), *decontamination.contamination(F.col("found")))


def learns_toxicity():
    return fold(F.col("doc_id"), 3) != 1


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learns_toxicity())
    scored = docs.select("doc_id", (~learns_toxicity()).alias("held_out"), toxicity.toxicity_score(spark, model, F.col("text")).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(
    "op11_lexical",
    rf"""
WITH tokens AS (
  SELECT row_number() OVER () AS d, doc_id, {SQL_ALNUM} AS words FROM documents),
docs AS (SELECT d, doc_id, words, len(words) AS n FROM tokens WHERE len(words) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM docs),
counts AS (SELECT d, w, count(*) AS tf FROM (SELECT d, unnest(words) AS w FROM docs) GROUP BY 1, 2),
weights AS (
  SELECT w, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT w, count(*) AS df FROM counts GROUP BY 1), totals),
asked AS (SELECT DISTINCT item_id, unnest({SQL_ALNUM}) AS w FROM benchmark),
scored AS (
  SELECT item_id, d, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words))))::BIGINT AS score
  FROM asked JOIN weights USING (w) JOIN counts USING (w) JOIN docs USING (d), totals GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= {lexical.TOP}""",
)
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that fit each benchmark item's words best."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's place on the sixteen components with the largest variance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def mixing_sql() -> str:
    """The level by the order in which sources reach their caps, in one pass; the keys of each source in one window."""
    weights, percent, epochs = list(mixing.WEIGHTS), mixing.PERCENT, mixing.EPOCHS
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
         md5(concat('{mixing.SEED}:', coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))))) AS key FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS total FROM sized GROUP BY 1),
weighed AS (
  SELECT source, total, {epochs} * total AS cap, {weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS weight FROM sources),
sums AS (SELECT sum(total)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM weighed),
ranked AS (
  SELECT *, row_number() OVER o AS pos, sum(cap) OVER o - cap AS caps, weights - sum(weight) OVER o + weight AS open
  FROM weighed, sums WINDOW o AS (ORDER BY cap * 6 // weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT {percent} * words - 100 * caps AS num, 100 * open AS den FROM ranked
  WHERE weight * ({percent} * words - 100 * caps) <= 100 * open * cap ORDER BY pos LIMIT 1),
targets AS (
  SELECT source, total, CASE WHEN weight * num > cap * den THEN cap::DOUBLE ELSE (weight * num)::DOUBLE / den::DOUBLE END AS target FROM weighed, level),
parts AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS whole FROM targets),
keys AS (
  SELECT source, key, n, sum(n) OVER (PARTITION BY source ORDER BY key) AS until
  FROM (SELECT source, key, sum(size)::BIGINT AS n FROM sized GROUP BY 1, 2)),
more AS (
  SELECT k.source, key, until <= rest OR (until - n <= rest AND 2 * (rest - (until - n)) >= n) AS again
  FROM keys k JOIN (SELECT *, target - whole * total AS rest FROM parts) p ON k.source IS NOT DISTINCT FROM p.source)
SELECT s.doc_id, s.size, p.total AS source_size, p.target, (s.size * (p.whole + CASE WHEN again THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
JOIN more m ON s.source IS NOT DISTINCT FROM m.source AND s.key = m.key"""


@query("op13_mixing", mixing_sql())
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
