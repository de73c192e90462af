"""Bodies out of stored HTML: the only operators that run Python on the executors."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import html as H

# The page code travels with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(H)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Newspaper account -> rule. Fixed value: the one newspaper whose pages need a rule of their own.
BODY_RULES = {"infobae": "article"}

EXTRACTED = T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType())])
# Pages whose results are handed back together: a task holds these and one page beside the batch that came in.
SLICE = 500
UNREADABLE = (AssertionError, ValueError, RecursionError)

Rule = Callable[[H.Node], str | None]


def _ruled(rule: Rule | None, tree: H.Node) -> str | None:
    """What a rule makes of a page; a rule that fails, however it fails, does not apply."""
    try:
        return rule(tree) if rule else None
    except Exception:  # noqa: BLE001  rules are given by the caller, and one bad page must not end the job
        return None


def _outline(page: str | None) -> H.Node | None:
    try:
        return None if page is None else H.outline(page)
    except UNREADABLE:
        return None  # a page that cannot be read has no page part


def _slices(batches: Iterator[tuple[pa.Array, pa.Array]], rows: int) -> Iterator[Iterator[tuple[str | None, str | None]]]:
    """Pages and rule names in slices of ``rows``; a page becomes a string only when its turn comes."""
    for pages, rules in batches:
        for at in range(0, len(pages), rows):
            yield ((page.as_py(), rule.as_py()) for page, rule in zip(pages.slice(at, rows), rules.slice(at, rows)))


def _whole_pages(functions: Mapping[str, Rule], rows: int = SLICE):
    """(html, rule name) -> title and body; a rule that does not apply or fails leaves the default body."""

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part in _slices(batches, rows):
            titles, bodies = [], []
            for page, rule in part:
                title = body = None
                tree = _outline(page)
                if tree is not None:
                    body = _ruled(functions[rule] if rule else None, tree)
                    try:
                        title = H.title_of(tree)
                        body = H.default_body(tree) if body is None else body
                    except UNREADABLE:
                        pass
                titles.append(title)
                bodies.append(body)
            yield pa.StructArray.from_arrays([pa.array(titles, pa.string()), pa.array(bodies, pa.string())], ["title", "body"])

    return F.arrow_udf(read, EXTRACTED)


def _bodies_by_rule(functions: Mapping[str, Rule], rows: int = SLICE):
    """(html, rule name) -> body, null where the rule does not apply or fails."""

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part in _slices(batches, rows):
            trees = ((_outline(page), functions[rule]) for page, rule in part)
            yield pa.array([None if tree is None else _ruled(rule, tree) for tree, rule in trees], pa.string())

    return F.arrow_udf(read, T.StringType())


def rule_for(newspaper: Column | str, rules: Mapping[str, str] = BODY_RULES) -> Column:
    """Name of the body rule of a newspaper, null for the default alone."""
    name = F.col(newspaper) if isinstance(newspaper, str) else newspaper
    chosen = F.lit(None).cast("string")
    for account, rule in rules.items():
        chosen = F.when(name == account, rule).otherwise(chosen)
    return chosen


def extract_pages(
    pages: DataFrame, rule: Column, html: str = "html", functions: Mapping[str, Rule] = H.RULES
) -> DataFrame:
    """Adds ``title`` and ``body``; both null where nothing could be read, empty bodies counting as nothing.

    ``functions`` are the rules by name; pass your own to add one for another newspaper.
    """
    seen = pages.withColumn("_page", _whole_pages(dict(functions))(F.col(html), rule))
    readable = F.length("_page.body") > 0
    return seen.withColumns(
        {"title": F.when(readable, F.col("_page.title")), "body": F.when(readable, F.col("_page.body"))}
    ).drop("_page")


def repaired_bodies(
    articles: DataFrame, rules: Mapping[str, str] = BODY_RULES, functions: Mapping[str, Rule] = H.RULES
) -> DataFrame:
    """(tweet_id, body) of the articles whose newspaper has a rule and whose page the rule applies to."""
    due = articles.where(F.col("user").isin(list(rules)) & F.col("html").isNotNull())
    body = _bodies_by_rule(dict(functions))(F.col("html"), rule_for("user", rules))
    return due.select("tweet_id", body.alias("body")).where(F.col("body").isNotNull())
