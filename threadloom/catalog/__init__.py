"""Registered queries: each a function of the tables, with its SQL where SQL can say it."""

from threadloom.catalog import articles, audits, live, posts, texts  # noqa: F401
from threadloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
