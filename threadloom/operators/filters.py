"""Predicates. Each returns a column, so that Catalyst can push it to the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARENT = "in_reply_to_status_id"


def parent_of(column: Column | str = PARENT) -> Column:
    """Parent id, with 0 read as no parent."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(0))


def is_reply() -> Column:
    # Two plain comparisons instead of a null test on an expression: both reach the Parquet reader.
    return F.col(PARENT).isNotNull() & (F.col(PARENT) != 0)


def is_root() -> Column:
    """Neither a reply nor a repost."""
    return (F.col(PARENT).isNull() | (F.col(PARENT) == 0)) & F.col("retweeted_status").isNull()


def kept_by_worker(only_replies: bool) -> Column:
    """What the ingest saves: everything, or replies only."""
    return is_reply() if only_replies else F.lit(True)


def by_users(users: Sequence[str], column: str = "user") -> Column:
    """Case-sensitive membership in a short list."""
    return F.col(column).isin(list(users))


def since(moment: dt.datetime, column: str = "created_at") -> Column:
    return F.col(column) >= F.lit(moment).cast("timestamp_ntz")


def before(moment: dt.datetime, column: str = "created_at") -> Column:
    return F.col(column) < F.lit(moment).cast("timestamp_ntz")


def in_languages(languages: Sequence[str]) -> Column:
    return F.col("lang").isin(list(languages))


def flag_is(name: str, value: bool) -> Column:
    """A stored flag; null satisfies neither value."""
    return F.col(name) == F.lit(value)


def unlabelled() -> Column:
    return flag_is("checked", False) & flag_is("interesting", False)


def pending_upstream() -> Column:
    return flag_is("look_for_upstream", True)


def has_more_than(items: Column | str, n: int) -> Column:
    return F.size(items) > n


def has_none(items: Column | str) -> Column:
    """A stored, empty array."""
    return F.size(items) == 0


def absent(column: Column | str) -> Column:
    return F.isnull(column)


def unscored(comments: Column | str = "comments") -> Column:
    """No comment of the array carries a score."""
    return ~F.coalesce(F.exists(comments, lambda c: c["hateful_value"].isNotNull()), F.lit(False))


def shorter_than(text: Column | str, n: int) -> Column:
    return F.length(text) < n


def is_empty(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text) == ""


def not_empty(text: Column | str) -> Column:
    return F.length(text) > 0


def titled(user: str, title: Column | str) -> Column:
    """Posts of one newspaper under exactly this title."""
    return (F.col("user") == user) & (F.col("title") == title)


def newspapers(allowed: Sequence[str] = (), barred: Sequence[str] = (), column: str = "user") -> Column:
    """White list first (empty means all), then black list."""
    keep = F.col(column).isin(list(allowed)) if allowed else F.lit(True)
    return keep & ~F.col(column).isin(list(barred)) if barred else keep


def has_code(code: int) -> Column:
    return F.col("api_code") == code


def mean_at_least(limit: float, strict: bool = False, column: str = "mean_value") -> Column:
    return F.col(column) > limit if strict else F.col(column) >= limit


def votes_at_least(n: int, votes: str = "HATE") -> Column:
    return F.size(votes) >= n


def hate_flagged() -> Column:
    return flag_is("possibly_hateful_comments", True)


def only_keys(df: DataFrame, keys: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """Rows whose key is in ``keys``: a lookup by id is a semi join, never one query per id."""
    right = keys.select(F.col(other or key).alias("_key"))
    return df.join(right, df[key] == right["_key"], "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """Rows whose key is not in ``keys``; unlike NOT IN, nulls among the keys do no harm."""
    right = keys.select(F.col(other or key).alias("_key"))
    return df.join(right, df[key] == right["_key"], "left_anti")
