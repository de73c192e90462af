"""Cutting a release."""

from __future__ import annotations

from pyspark.sql import DataFrame

from threadloom.model import RELEASE_FIELDS
from threadloom.operators.aggregates import count_by
from threadloom.operators.groups import BLOCK_ROWS
from threadloom.plans.articles import with_comments
from threadloom.session import materialise
from threadloom.sources.readers import QuerySpec
from threadloom.sources.writers import write_release


def select_articles(articles: DataFrame, spec: QuerySpec | None) -> DataFrame:
    return articles if spec is None else articles.where(spec.predicate())


def cut_release(
    articles: DataFrame, comments: DataFrame, spec: QuerySpec | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The articles a spec selects, with their comments; no spec selects everything.

    Only the fields of a release are read. A selection is written once: its texts are searched in one scan, although both the articles and
    the pruning of their comments need it, and its size is known when the comments are joined.
    """
    fields = [c for c in RELEASE_FIELDS if c != "comments"]
    chosen = select_articles(articles, spec).select(*fields)
    selective = spec is not None and spec != QuerySpec()
    if selective:
        chosen = materialise(chosen, "selection")
    return with_comments(chosen, comments, block_rows, prune=selective).select(*RELEASE_FIELDS, "part")


def release_counts(articles: DataFrame, spec: QuerySpec | None = None) -> DataFrame:
    """Articles per newspaper that a release would hold."""
    return count_by(select_articles(articles, spec), "user")


def export_release(articles: DataFrame, comments: DataFrame, path: str, spec: QuerySpec | None = None) -> None:
    write_release(cut_release(articles, comments, spec), path)
