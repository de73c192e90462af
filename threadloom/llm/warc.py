"""Derivatives of archived responses: metadata and plain-text conversion records, linked to their source."""

from __future__ import annotations

import codecs
import hashlib
import re
import sys
import uuid

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import pages as P

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VERSION = "WARC/1.1"
STAMP = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("5f2b1c9e-7a53-4b0e-9d55-0f6c2f1e8a11")


def digest(block: Column) -> Column:
    """A labelled digest of bytes."""
    return F.concat(F.lit("sha1:"), F.sha1(block))


def record_id(*parts: Column) -> Column:
    """A UUID that depends on the parts only, so that a task that runs again makes the same ids."""
    h = F.md5(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])).cast("binary"))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    pieces = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def responses_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = STAMP) -> DataFrame:
    """Response records of a table of pages: an HTTP message whose payload is the page. Null html: an empty payload."""
    # Payload and digest are columns of their own, so that each is made once.
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("target_uri"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload")
    )
    rows = rows.select("*", digest(F.col("payload")).alias("payload_digest"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n")
    )
    return rows.select(
        "page_id",
        record_id(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("date"),
        "payload_digest",
        F.concat(F.encode(head, "UTF-8"), F.col("payload")).alias("block"),
    )


def plain_text(html: str) -> str:
    """All visible text of a page: blocks on lines of their own, references decoded; scripts, styles and the head left out."""
    out, skip_to, line = [], 0, []

    def end_line():
        text = P.SPACE.sub(" ", P.references.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    at = 0
    for tag in P.TAG.finditer(html):
        if tag.start() < skip_to:
            continue
        line.append(html[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        closing = tag[1] or tag[4]
        if not name:
            continue
        if name == "br" or name not in P.INLINE:
            end_line()
        if not closing and name in P.RAW | {"head"} and not (tag[3] or tag[6] or "").endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = skip_to = close.end() if close else len(html)
    line.append(html[at:])
    end_line()
    return "\n".join(out)


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order (folded lines joined), payload. Without a blank line all of it is payload."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    headers: list[tuple[str, str]] = []
    for text in lines[1:]:
        if text[:1] in " \t" and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            headers.append((name.strip(), value.strip()))
    return lines[0], headers, payload


def _charset(headers: list[tuple[str, str]]) -> str:
    for name, value in headers:
        found = re.search(r"charset\s*=\s*\"?([\w.:\-]+)", value, re.I) if name.lower() == "content-type" else None
        if found:
            try:
                return codecs.lookup(found[1]).name
            except LookupError:
                return "utf-8"
    return "utf-8"
    return "utf-8"


def _read_blocks(blocks: pd.Series) -> pd.DataFrame:
    """Status line, headers, payload digest and visible text of HTTP messages."""
    rows = []
    for block in blocks:
        status, headers, payload = split_http(block or b"")
        text = plain_text(payload.decode(_charset(headers), "replace"))
        rows.append((status, [{"name": n, "value": v} for n, v in headers], f"sha1:{hashlib.sha1(payload).hexdigest()}", text))
    return pd.DataFrame(rows, columns=["status", "headers", "digest", "text"])


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records per response, a ``metadata`` and a ``conversion`` one, and the response they refer to.

    ``responses``: record_id, target_uri, date, payload_digest, block (an HTTP message), one row each. Both
    records keep the response's id in ``refers_to``, its URI, date and HTTP headers (in order, repeated names
    too). ``payload_digest`` is the source's payload digest on both, ``block_digest`` that of the record's own
    block. The metadata block is application/warc-fields and links the conversion record; the conversion
    block is the page's whole visible text. Digests missing in the source are computed from its payload.
    No shuffle, no collecting; ids depend on the source record only.

    A null block counts as empty: no headers, empty text. Null URI or date stay null (left out of the fields).
    Repeated responses give repeated records with the same ids. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    read = F.pandas_udf(_read_blocks, "status string, headers array<struct<name:string,value:string>>, digest string, text string")
    source = responses.select("record_id", "target_uri", "date", "payload_digest", read("block").alias("read"))
    source = source.select(
        "record_id",
        "target_uri",
        "date",
        "read",
        F.coalesce("payload_digest", "read.digest").alias("source_digest"),
        record_id(F.lit("metadata"), F.col("record_id")).alias("metadata_id"),
        record_id(F.lit("conversion"), F.col("record_id")).alias("conversion_id"),
        F.encode("read.text", "UTF-8").alias("conversion"),
    )
    fields = F.concat_ws(
        "",
        F.concat(F.lit("derived-conversion: "), F.col("conversion_id"), F.lit("\r\n")),
        F.concat(F.lit("source-payload-digest: "), F.col("source_digest"), F.lit("\r\n")),
        F.when(F.col("read.status") != "", F.concat(F.lit("http-status: "), F.col("read.status"), F.lit("\r\n"))),
        F.array_join(F.transform("read.headers", lambda h: F.concat(F.lit("http-header-"), F.lower(h["name"]), F.lit(": "), h["value"], F.lit("\r\n"))), ""),
        F.concat(F.lit("text-characters: "), F.char_length("read.text").cast("string"), F.lit("\r\n")),
    )
    source = source.select("*", F.encode(fields, "UTF-8").alias("metadata"))
    # Blocks and digests are made before the rows are doubled.
    source = source.select(
        "*",
        *[digest(F.col(k)).alias(f"{k}_digest") for k in ("metadata", "conversion")],
        *[F.octet_length(k).cast("long").alias(f"{k}_length") for k in ("metadata", "conversion")],
    )

    def record(kind: str, content_type: str) -> Column:
        return F.struct(
            F.col(f"{kind}_id").alias("record_id"), F.lit(kind).alias("warc_type"), F.col("record_id").alias("refers_to"), "target_uri", "date",
            F.lit(content_type).alias("content_type"), F.col("source_digest").alias("payload_digest"), F.col(f"{kind}_digest").alias("block_digest"),
            F.col(f"{kind}_length").alias("content_length"), F.col("read.headers").alias("headers"), F.col(kind).alias("block"),
        )

    both = F.array(record("metadata", "application/warc-fields"), record("conversion", "text/plain; charset=utf-8"))
    return source.select(F.inline(both))


def record_bytes(record: dict) -> bytes:
    """A record as it stands in a file; ``parse_records`` reads it back."""
    named = [
        ("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["date"]), ("WARC-Payload-Digest", record["payload_digest"]),
        ("WARC-Block-Digest", record["block_digest"]), ("Content-Type", record["content_type"]), ("Content-Length", str(len(record["block"]))),
    ]
    head = "".join(f"{n}: {v}\r\n" for n, v in named if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + bytes(record["block"]) + b"\r\n\r\n"


def parse_records(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    out, at = [], 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head_end + 4
        stop = start + int(fields["Content-Length"])
        out.append((fields, data[start:stop]))
        at = stop + 4
    return out


def serialised(records: DataFrame) -> DataFrame:
    """The records' bytes, column ``value``, each as it stands in a file."""

    def render(batches):
        for batch in batches:
            yield pd.DataFrame({"value": [record_bytes(r) for r in batch.to_dict("records")]})

    return records.mapInPandas(render, "value binary")
