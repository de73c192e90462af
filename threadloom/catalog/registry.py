"""Registration of queries and the SQL views their oracles share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.functions.text import FOLD_FROM, FOLD_TO
from threadloom.sources.adapters import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def sql_fold(text: str) -> str:
    return f"translate(lower({text}), '{FOLD_FROM}', '{FOLD_TO}')"


def sql_tokens(text: str) -> str:
    return rf"regexp_extract_all({sql_fold(text)}, '[\p{{L}}\p{{N}}]+')"


def sql_unescape(text: str) -> str:
    """Character references, with or without their semicolon; the ampersand last."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


VIEWS = {
    "articles": 'SELECT o_orderkey AS tweet_id, o_orderpriority AS "user", o_orderdate AS created_at FROM orders',
    "comments": """
        SELECT l_orderkey AS article_id, l_partkey AS tweet_id, l_shipdate AS created_at, l_discount AS score,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS text
        FROM lineitem""",
    "comment_counts": "SELECT l_orderkey AS tweet_id, count(*) AS n_comments FROM lineitem GROUP BY 1",
    "docs": """
        SELECT doc_id AS tweet_id, source AS "user", lang, split_part(text, chr(10), 1) AS title, text AS body,
               TIMESTAMP '2020-01-01' + n_chars * INTERVAL 1 HOUR AS created_at
        FROM documents""",
    "news": """
        SELECT d.tweet_id, d.lang, d.title, d.body, a."user", a.created_at
        FROM docs d JOIN articles a ON a.tweet_id = d.tweet_id""",
    "threads": """
        SELECT conv_id * 100 + turn + 100 AS id, role AS user_name, text, turn,
               TIMESTAMP '2024-01-01' + turn * INTERVAL 1 HOUR + conv_id * INTERVAL 1 SECOND AS created_at,
               CASE WHEN turn > 0 THEN conv_id * 100 + turn + 99 END AS parent
        FROM conversations""",
    "caught": "SELECT * FROM threads WHERE user_name = 'user'",
    "live": """
        SELECT event_id AS id, ts AS created_at, '@' || upper(event_type[1]) || event_type[2:] AS query,
               CAST(user_id AS VARCHAR) AS user_name, value
        FROM events""",
    "errors": """
        SELECT event_type AS message, CAST(json_extract_string(props, '$.k') AS INTEGER) AS api_code, event_id AS tweet_id
        FROM events WHERE event_type = 'error'""",
    "linked": """
        SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS text, d.source AS screen_name,
               lower(d.source) AS user_name, p.url AS link, regexp_replace(trim(p.url), '#.*$', '') AS link_key, d.lang, length(d.text) > 2000 AS flagged,
               TIMESTAMP '2020-01-01' + d.n_chars * INTERVAL 1 HOUR AS created_at
        FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id""",
    "page_keys": r"""
        SELECT *, regexp_replace(trim(url), '#.*$', '') AS key FROM page_parts
        QUALIFY row_number() OVER (PARTITION BY regexp_replace(trim(url), '#.*$', '') ORDER BY url) = 1""",
    "page_parts": rf"""
        SELECT page_id, url, html,
               trim(regexp_replace({sql_unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, '\s+', ' ', 'g')) AS title,
               array_to_string([trim({sql_unescape("regexp_replace(x, '<[^>]*>', '', 'g')")}, E' \t\n\r')
                 FOR x IN string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:]], E'\n\n') AS body
        FROM pages""",
    "annotations": """
        SELECT d.doc_id AS tweet_id, d.n_chars AS article_id, split_part(d.text, chr(10), 1) AS text,
               coalesce(l.toxic, 0) * 2 + coalesce(1 - l.quality, 0) AS hate,
               coalesce(l.toxic, 0) * 2 AS women, d.n_chars % 3 AS lgbti, d.n_chars % 4 AS racism,
               d.doc_id % 2 AS class, coalesce(l.quality, 0) * 3 AS politics, d.doc_id % 3 AS disabled,
               0 AS appearance, d.n_chars % 2 AS criminal
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
}


def with_views(sql: str) -> str:
    """The query with the views it names, and those they name, in front."""
    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name, body in VIEWS.items():
            if name != own and name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(body, name)
                needed.append(name)

    visit(sql)
    sql = sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    if sql.upper().startswith("WITH"):
        rest = re.sub(r"^WITH(\s+RECURSIVE)?", "", sql, flags=re.I)
        return f"WITH RECURSIVE {views}{',' if views else ''}{rest}"
    return f"WITH {views}\n{sql}" if views else sql


def query(name: str, sql: str | None = None):
    """Register a query over the adapted tables."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
