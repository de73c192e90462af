"""Scalar functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.text import TOKEN, fold

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_Z_FRACTION = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"
LONG_DATE = "dd-MMM-yyyy (HH:mm:ss)"
# What stripping removes: every blank of the basic plane.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def screen_name(query: Column | str) -> Column:
    """``@Name`` as the lower-case account name."""
    return F.lower(F.substring(query, 2, 2**31 - 1))


def from_iso(text: Column | str) -> Column:
    """``2020-02-10T00:00:00Z``, with or without a fraction, as a zone-free UTC timestamp; null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_Z_FRACTION)).cast("timestamp_ntz")


def to_iso(ts: Column | str) -> Column:
    return F.date_format(ts, ISO_Z)


def long_date(ts: Column | str) -> Column:
    return F.date_format(ts, LONG_DATE)


def day_number(ts: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(ts))


def day_of_number(n: Column | str) -> Column:
    return F.date_from_unix_date(n)


def whole_days(first: Column, last: Column) -> Column:
    """Whole days between two timestamps."""
    return F.extract(F.lit("DAY"), last - first).cast("long")


def code_points(text: Column | str) -> Column:
    return F.length(text)


def snippet(text: Column | str, n: int) -> Column:
    return F.substring(text, 1, n)


def join_blank_line(parts: Column | str) -> Column:
    return F.array_join(parts, "\n\n")


def strip(text: Column | str) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def to_id(text: Column | str) -> Column:
    """Integer id, null where the text is none."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("bigint")


def percent(new: Column, old: Column) -> Column:
    """``100 * new / old`` to two decimals, null without an old value."""
    return F.round(F.try_divide(F.lit(100.0) * new, old), 2)


def scaled(n: Column, unit: int) -> Column:
    """Thousands (1000) or millions (1000000) to two decimals."""
    return F.round(n / F.lit(float(unit)), 2)


def unwrap_date(column: Column) -> Column:
    """Extended-JSON date ``{"$date": "..."}`` as a timestamp."""
    return from_iso(column.getField("$date"))


def wrap_date(ts: Column | str) -> Column:
    return F.struct(to_iso(ts).alias("$date"))


def first_link(urls: Column | str) -> Column:
    """Expanded form of the first link, null where there is none."""
    return F.get(urls, F.lit(0)).getField("expanded_url")


def link_key(url: Column | str) -> Column:
    """What two links are compared on: the address without its fragment and outer blanks."""
    return F.regexp_replace(F.trim(url), r"#.*$", "")


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))


def slug(title: Column | str) -> Column:
    """Folded title, runs of other characters as one dash, none at the ends."""
    return F.btrim(F.regexp_replace(fold(title), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))


def first_line(text: Column | str) -> Column:
    return F.substring_index(text, "\n", 1)


def word_count(text: Column | str) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))
