"""Sampling and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_order(key: str, seed: int | str) -> list[Column]:
    """A reproducible random order: by a hash of key and seed, ties by the key."""
    return [F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)]


def random_rows(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """``n`` random rows, the same in every run. Each task keeps its own first ``n`` (TakeOrderedAndProject)."""
    return df.orderBy(*seeded_order(key, seed)).limit(n)


def random_share(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A random share, for samples too large for one task."""
    return df.sample(fraction=fraction, seed=seed)


def newest(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return df.orderBy(F.desc("created_at"), key).limit(n)


def oldest(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return df.orderBy("created_at", key).limit(n)
