"""Main text of web pages: templates deduced from equivalence classes of markup tokens on the pages of a host."""

from __future__ import annotations

import hashlib
import html as references
import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_PAGES = 64
# A text belongs to the template if it is on so many pages, and on this share of the pages that have its slot.
LEAST, SHARE = 3, 0.5
# Keys a task counts before it hands them on; rows of host tables that are sent to all tasks.
COUNTED, SENT_ROWS = 200_000, 500_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
NOT_TEXT = frozenset("head nav footer aside form button select dialog menu".split()) | RAW
# Words in class, id and role attributes that name what is not the article.
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices"
    " alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside widget"
    " footer header masthead topbar toolbar comment comments discussion disqus replies respond share sharing social related"
    " recommended newsletter subscribe subscription signup login search complementary contentinfo".split()
)
MAIN = frozenset(("article", "main"))

TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[a-z]+")
# Names that say what an element has or lacks, not what it is.
MODIFIER = re.compile(r"(?:[Hh]as|[Ww]ith|[Ww]ithout|[Nn]o)(?:[-_]|(?=[A-Z]))")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Block:
    """``named``: the elements around it whose names say that they are not text, by number, those around the main element only."""

    role: str
    main: bool
    text: str
    link_chars: int
    named: tuple[int, ...] = ()


@dataclass(slots=True)
class Page:
    """Markup tokens in order (roles: paths of elements) and the text blocks that may be article text."""

    roles: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _names(attributes: str) -> tuple[str, bool, bool]:
    """The part of a role that comes from the attributes; whether they name something other than text, or the main text."""
    label, junk, main = "", False, False
    for kind, *values in ATTRIBUTE.findall(attributes):
        value = references.unescape(next((v for v in values if v), ""))
        if kind.lower() == "class":
            label += "." + ".".join(sorted(value.lower().replace("/", ":").split()))
        plain = " ".join(v for v in value.split() if not MODIFIER.match(v))
        junk |= not NOT_TEXT_NAMES.isdisjoint(NAME.findall(CAMEL.sub(" ", plain).lower()))
        main |= kind.lower() == "role" and value.lower().split() == ["main"]
    return label, junk, main


def settle(blocks: list[Block]) -> list[Block]:
    """The blocks that may be article text, given what the elements around them are named.

    Main elements inside named ones (or named so themselves) hold the main text only where no other does: there
    a name is that of a page's wrapper, elsewhere that of teasers or comments. Outside of main elements a named
    element is left out, unless it holds most of the page's text.
    """
    clean = any(b.main and not b.named for b in blocks)
    held: Counter = Counter()
    for b in blocks:
        held.update(dict.fromkeys(b.named, len(b.text)))
    total = sum(len(b.text) for b in blocks)
    kept = []
    for b in blocks:
        if b.main and not (clean and b.named) or all(2 * held[n] > total for n in b.named):
            kept.append(Block(b.role, b.main and not (clean and b.named), b.text, b.link_chars))
    return kept


def read_page(html: str) -> Page:
    """One pass over the markup. Unclosed elements end where their parent or the next block begins."""
    page = Page()
    # Open elements: tag, role, inside something that is not text, inside the main element, in a link, named elements around the main one.
    stack: list[tuple[str, str, bool, bool, bool, tuple[int, ...]]] = [("", "", False, False, False, ())]
    pieces: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", references.unescape("".join(pieces))).strip()
            if text:
                holder = next(x for x in reversed(stack) if x[0] not in INLINE)
                page.blocks.append(Block(holder[1], holder[3], text, linked, holder[5]))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][2]:
            pieces.append(text)
            if stack[-1][4]:
                linked += len(text)

    end = len(html)
    while at < end:
        tag = TAG.search(html, at)
        if tag is None:
            add(html[at:])
            break
        add(html[at : tag.start()])
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name not in INLINE:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            flush()
            # A block ends an open paragraph; a list item or cell ends the one before it.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or stack[i][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        label, junk, is_main = _names(attributes) if "=" in attributes else ("", False, False)
        # What the whole page is called says nothing about its parts.
        junk &= name not in ("html", "body", "main")
        is_main |= name in MAIN
        _, role, inside, main, link, named = stack[-1]
        role = f"{role}/{name}{label}"
        page.roles.append(role)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at) if not attributes.endswith("/") else None
            at = close.end() if close else (at if attributes.endswith("/") else end)
            continue
        if name in VOID or attributes.endswith("/") and name not in INLINE and name not in ("p", "div"):
            continue
        header = name == "header" and not main
        inside = inside or header or name in NOT_TEXT
        if junk and main:
            inside = True
        elif junk:
            named = (*named, at)
        stack.append((name, role, inside, main or is_main and not inside, link or name == "a", named))
    flush()
    page.blocks = settle(page.blocks)
    return page


def key_of(value: str) -> int:
    """A 64-bit hash of a role or text."""
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


OWN = 0.25


def slot_key(slot: int, text: int) -> int:
    """A 64-bit key of a text in a slot."""
    mixed = (slot * 0x9E3779B97F4A7C15 ^ text) & 0xFFFFFFFFFFFFFFFF
    return mixed - (1 << 64) if mixed >> 63 else mixed


def parents_of(roles: list[str]) -> list[int]:
    """The place of every role's parent in ``roles``, -1 without one. Roles are in order of their first occurrence, so parents come first."""
    at = {role: i for i, role in enumerate(roles)}
    return [at.get(role.rpartition("/")[0], -1) for role in roles]


def predecessors(roles, classes):
    """Every role that has a class, with the role of its class before it on the page (0 for the first)."""
    last: dict = {}
    for role, kind in zip(roles, classes, strict=True):
        if kind is not None:
            yield role, last.get(kind, 0)
            last[kind] = role


def slots_of(parents, ordered) -> list[int]:
    """The place of the innermost template role around each role, itself included; -1 for none.

    ``ordered`` says which roles are in ordered classes; the template has those of them whose parent is in it (nested).
    """
    slots: list[int] = []
    for i, parent in enumerate(parents):
        around = slots[parent] if parent >= 0 else -1
        slots.append(i if ordered[i] and around == parent else around)
    return slots


def is_fixed(text_pages, slot_pages):
    """Whether a text belongs to the template: it is on enough of the pages that have its slot. Numbers or columns."""
    return (text_pages >= LEAST) & (text_pages >= SHARE * slot_pages)


def chosen(main, plain, fixed, sizes) -> list[int]:
    """The places of the blocks that are a page's text.

    Of the blocks of a main element, template text (``fixed``) is left out at its beginning and end. What stands
    between a page's own blocks, such as a heading that all articles have, is part of the article. If less than
    ``OWN`` of the element's characters is left, the page is one of several addresses of an article: all its blocks
    count, unless the plain blocks outside, without fixed ones, are longer. So do these without a main element.
    """
    inside = [i for i, m in enumerate(main) if m]
    outside = [i for i, p in enumerate(plain) if p and not main[i] and not fixed[i]]
    own = [n for n, i in enumerate(inside) if not fixed[i]]
    kept = inside[own[0] : own[-1] + 1] if own else []
    whole = sum(sizes[i] for i in inside)
    if kept and sum(sizes[i] for i in kept) >= OWN * whole:
        return kept
    return inside if whole >= sum(sizes[i] for i in outside) else outside


def is_plain(block: Block) -> bool:
    return 2 * block.link_chars < len(block.text)


def deduce_template(pages: list[Page]) -> set[str]:
    """Roles of the template of these pages.

    Roles with the same vector of occurrence counts over the pages form a class; roles on a single page of
    several are no template. Classes are ordered: a role stays if on more than half of its pages the same role
    of its class comes before it. And nested: every role's parent is in the template too.
    """
    vectors: dict[str, dict[int, int]] = defaultdict(dict)
    for i, page in enumerate(pages):
        for role, n in Counter(page.roles).items():
            vectors[role][i] = n
    classes = {role: tuple(v.items()) for role, v in vectors.items() if len(v) >= min(2, len(pages))}
    before: dict[str, Counter] = defaultdict(Counter)
    for page in pages:
        roles = list(dict.fromkeys(page.roles))
        for role, previous in predecessors(roles, [classes.get(r) for r in roles]):
            before[role][previous] += 1
    ordered = {role for role, seen in before.items() if 2 * max(seen.values()) > len(vectors[role])}
    template: set[str] = set()
    for page in pages:
        roles = list(dict.fromkeys(page.roles))
        template.update(roles[i] for i in slots_of(parents_of(roles), [r in ordered for r in roles]) if i >= 0)
    return template


def slot_of(role: str, template: set[str]) -> str:
    """The innermost template element around a role."""
    while role and role not in template:
        role = role.rpartition("/")[0]
    return role


def extract_group(htmls: list[str]) -> tuple[list[str], str]:
    """The main texts of all pages of one host, and an id of their template: what ``extract_pages`` does, for a small host."""
    pages = {h: read_page(h) for h in htmls}
    template = deduce_template(list(pages.values()))
    spread: Counter = Counter()
    for page in pages.values():
        found = {(slot_of(b.role, template), b.text) for b in page.blocks}
        spread.update(found | {(slot, None) for slot, _ in found})
    texts = []
    for blocks in (pages[h].blocks for h in htmls):
        slots = [slot_of(b.role, template) for b in blocks]
        fixed = [is_fixed(spread[s, b.text], spread[s, None]) for s, b in zip(slots, blocks, strict=True)]
        texts.append("\n".join(blocks[i].text for i in chosen([b.main for b in blocks], [is_plain(b) for b in blocks], fixed, [len(b.text) for b in blocks])))
    return texts, hashlib.sha1("\n".join(sorted(template)).encode()).hexdigest()


PARSED = (
    "page_id string, url string, host string, digest long, roles array<long>, counts array<int>, parents array<int>,"
    " block_role array<int>, block_main array<boolean>, block_plain array<boolean>, block_key array<long>, block_text array<string>"
)


def _parsed(html: str) -> tuple:
    """The columns of ``PARSED`` that come from the markup."""
    page = read_page(html)
    counts = Counter(page.roles)
    roles = list(counts)
    at = {role: i for i, role in enumerate(roles)}
    return (
        [key_of(r) for r in roles],
        list(counts.values()),
        parents_of(roles),
        [at.get(b.role, -1) for b in page.blocks],
        [b.main for b in page.blocks],
        [is_plain(b) for b in page.blocks],
        [key_of(b.text) for b in page.blocks],
        [b.text for b in page.blocks],
    )


def _block_keys(roles, parents, ordered, block_role, block_key) -> list[tuple[int, int]]:
    """The slot of every block (0 for none), and the key of its text in it."""
    ordered = set(ordered)
    slots = slots_of(parents, [r in ordered for r in roles])
    places = [slots[r] if r >= 0 else -1 for r in block_role]
    found = [int(roles[p]) if p >= 0 else 0 for p in places]
    return [(slot, slot_key(slot, int(key))) for slot, key in zip(found, block_key, strict=True)]


def _counted(columns: list[str], keys_of):
    """A function for mapInPandas: how many rows have each of their keys, added up inside the task."""

    def count(batches):
        counts: Counter = Counter()

        def out():
            return pd.DataFrame([(*k, n) for k, n in counts.items()], columns=[*columns, "n"])

        for batch in batches:
            for row in batch.itertuples(index=False):
                counts.update(keys_of(row))
                if len(counts) > COUNTED:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return count


def host_tables(parsed: DataFrame) -> DataFrame:
    """host, ordered (keys of the roles in ordered classes), template (an id of them), fixed (keys of texts in slots): over all pages of each host.

    Pages with the same markup count once, so copies of an article don't make its text a template. A class is
    known by the sum without carry of the hashes of (page, count). Counts are added up inside tasks before they travel.
    """
    columns = ("host", "digest", "roles", "counts", "parents", "block_role", "block_key")
    distinct = materialise(parsed.select(*columns).dropDuplicates(["host", "digest"]), "distinct-pages")
    hosts = distinct.groupBy("host").agg(F.count("*").alias("n_pages"))
    tokens = distinct.select("host", "digest", F.explode(F.arrays_zip("roles", "counts")).alias("t"))
    vectors = tokens.groupBy("host", F.col("t.roles").alias("role")).agg(
        F.bit_xor(F.xxhash64("digest", "t.counts")).alias("vector"), F.count("*").alias("pages")
    )
    vectors = materialise(vectors.join(hosts, "host").where("pages >= least(2, n_pages)"), "page-vectors")

    by_host = vectors.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("role", "vector"))).alias("classes"))
    known = distinct.select("host", "roles").join(_sent(by_host, vectors), "host")
    known = known.select("host", "roles", F.transform("roles", lambda r: F.try_element_at("classes", r).cast("string")).alias("classes"))
    before = known.mapInPandas(
        _counted(["host", "role", "before"], lambda r: [(r.host, int(a), int(b)) for a, b in predecessors(r.roles, r.classes)]),
        "host string, role long, before long, n long",
    )
    before = before.groupBy("host", "role", "before").agg(F.sum("n").alias("n")).groupBy("host", "role").agg(F.max("n").alias("same"))
    ordered = materialise(before.join(vectors, ["host", "role"]).where("2 * same > pages").select("host", "role"), "page-roles")
    roles = ordered.groupBy("host").agg(F.array_sort(F.collect_list("role")).alias("ordered"))
    roles = materialise(hosts.select("host").join(roles, "host", "left").withColumn("ordered", F.coalesce("ordered", F.array().cast("array<long>"))), "host-roles")

    def keys_of(r):
        found = set(_block_keys(r.roles, r.parents, r.ordered, r.block_role, r.block_key))
        return [(r.host, slot, key, False) for slot, key in found] + [(r.host, slot, 0, True) for slot in {slot for slot, _ in found}]

    placed = distinct.join(_sent(roles, ordered), "host").withColumn("ordered", F.array_intersect("roles", "ordered"))
    spread = placed.select("host", "roles", "parents", "ordered", "block_role", "block_key").mapInPandas(
        _counted(["host", "slot", "key", "whole"], keys_of), "host string, slot long, key long, whole boolean, n long"
    )
    spread = spread.groupBy("host", "slot", "key", "whole").agg(F.sum("n").alias("n")).where(F.col("whole") | (F.col("n") >= LEAST))
    spread = materialise(spread, "slot-texts")
    slots = spread.where("whole").select("host", "slot", F.col("n").alias("slot_pages"))
    fixed = spread.where("not whole").join(slots, ["host", "slot"]).where(is_fixed(F.col("n"), F.col("slot_pages")))
    listed = ordered.select("host").unionByName(fixed.select("host"))
    fixed = fixed.groupBy("host").agg(F.collect_list("key").alias("fixed"))
    tables = roles.join(fixed, "host", "left").withColumn("fixed", F.coalesce("fixed", F.array().cast("array<long>")))
    tables = tables.withColumn("template", F.sha1(F.array_join(F.col("ordered").cast("array<string>"), ",")))
    return _sent(materialise(tables, "host-tables"), listed)


def _sent(by_host: DataFrame, rows: DataFrame) -> DataFrame:
    """``by_host`` marked for broadcast if the rows in its lists are few; else the join splits hosts with many pages."""
    return F.broadcast(by_host) if rows.count() <= SENT_ROWS else by_host


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", group_pages: int = GROUP_PAGES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, template.

    Markup is read once, ``group_pages`` pages at a time (this bounds memory and changes no result). Occurrence
    vectors, order and repeated texts are counted over all pages of a host, however many (``host_tables``); the
    markup itself isn't shuffled. A text on at least ``LEAST`` pages and a ``SHARE`` of the host's pages that
    have its slot belongs to the template, at the beginning and end of article and main elements too. Every page's
    text is extracted whole: the texts in the slots of its article or main element (:func:`chosen`); if it has
    none, the others in all slots that are neither links nor named as something else.

    Null html: empty text. Null url, or none with a host: one nameless host. Repeated rows each give a row.
    An empty table gives no rows. Other columns are not read, whatever their names.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    source = pages.select(
        F.col(page_id).cast("string").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), host.alias("host")
    ).withColumn("digest", F.xxhash64("html"))
    kind = pages.schema[page_id].dataType
    names = [c.split(" ")[0] for c in PARSED.split(", ")]

    def parse(batches):
        for batch in batches:
            for at in range(0, len(batch), group_pages):
                part = batch.iloc[at : at + group_pages]
                rows = zip(part["page_id"], part["url"], part["host"], part["digest"], part["html"], strict=True)
                yield pd.DataFrame([(*r[:4], *_parsed(r[4])) for r in rows], columns=names)

    def choose(roles, parents, ordered, fixed, block_role, main, plain, keys, sizes):
        out = []
        for r, p, o, f, b, m, q, k, n in zip(roles, parents, ordered, fixed, block_role, main, plain, keys, sizes, strict=True):
            f = set(f)
            out.append(chosen(m, q, [key in f for _, key in _block_keys(r, p, o, b, k)], n))
        return pd.Series(out)

    parsed = materialise(source.mapInPandas(parse, PARSED), "parsed-pages")
    found = parsed.join(host_tables(parsed), "host", "left").withColumn("ordered", F.array_intersect("roles", "ordered"))
    sizes = F.transform("block_text", lambda t: F.char_length(t))
    kept = F.pandas_udf(choose, "array<int>")("roles", "parents", "ordered", "fixed", "block_role", "block_main", "block_plain", "block_key", sizes)
    found = found.select("page_id", "url", "block_text", "template", kept.alias("kept"))
    text = F.array_join(F.transform("kept", lambda i: F.get("block_text", i)), "\n")
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "url", text.alias("text"), "template")
