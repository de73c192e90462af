"""Full-text predicates as Spark columns.

The contract: a token is a maximal run of letters and digits, lower-cased, accents folded. Bare terms
are ORed, ``-term`` excludes every token of that word, ``"a phrase"`` must occur token by token. There
is no stemming and there are no stop words. A query with nothing positive selects nothing.

Matching a fixed list of terms does not need the token array at all: a term matches when it stands
between two token borders. Each text is folded once; a byte search then rules out nearly all terms, and
only for those that occur somewhere does a pattern look at the borders.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHAR = r"[\p{L}\p{N}]"
TOKEN = rf"{_CHAR}+"
_GAP = r"[^\p{L}\p{N}]+"


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters with their base letter, then the combining marks, which have none."""
    letters = {}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii() and base[0].islower():
            letters[chr(code)] = base[0]
    marks = "".join(chr(code) for code in range(0x300, 0x370))
    return "".join(letters) + marks, "".join(letters.values())


FOLD_FROM, FOLD_TO = _fold_table()
_FOLD = {ord(a): (FOLD_TO[i] if i < len(FOLD_TO) else None) for i, a in enumerate(FOLD_FROM)}


def fold(text: Column | str) -> Column:
    """Lower case without accents; plain ASCII texts, told by their length in bytes, need no translation."""
    small = F.lower(text)
    return F.when(F.octet_length(text) == F.length(text), small).otherwise(F.translate(small, FOLD_FROM, FOLD_TO))


def tokens(text: Column | str) -> Column:
    """All tokens in order. For a fixed term list prefer :func:`matches` or :func:`matched_positions`."""
    return F.regexp_extract_all(fold(text), F.lit(TOKEN), F.lit(0))


def words_of(term: str) -> list[str]:
    """The tokens of a query term: the same rule, on the driver, for a handful of words."""
    return re.findall(r"[^\W_]+", term.lower().translate(_FOLD))


@dataclass(frozen=True)
class TextQuery:
    """A parsed search string."""

    terms: tuple[str, ...] = ()
    phrases: tuple[tuple[str, ...], ...] = ()
    banned_terms: tuple[str, ...] = ()
    banned_phrases: tuple[tuple[str, ...], ...] = ()


def parse_search(search: str) -> TextQuery:
    terms, phrases, banned, banned_phrases = [], [], [], []
    for minus, quoted, bare in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', search):
        if quoted:
            found = tuple(words_of(quoted))
            if found:
                (banned_phrases if minus else phrases).append(found)
        else:
            (banned if minus else terms).extend(words_of(bare))
    return TextQuery(tuple(dict.fromkeys(terms)), tuple(phrases), tuple(dict.fromkeys(banned)), tuple(banned_phrases))


def _stands(folded: Column, words: Sequence[str]) -> Column:
    """The words occur one after another, between token borders.

    The pattern starts with the literal, so that the engine skips along to it; the border before it is
    looked at last.
    """
    literal = _GAP.join(re.escape(w) for w in words)
    if len(words) == 1:
        pattern = rf"{literal}(?!{_CHAR})(?<!{_CHAR}{literal})"
    else:
        pattern = rf"(?<!{_CHAR}){literal}(?!{_CHAR})"
    return reduce(and_, [folded.contains(w) for w in words]) & F.rlike(folded, F.lit(pattern))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_folded(text: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of the folded text; a null text counts as empty."""
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return _let(whole, lambda raw: _let(fold(raw), body))


def matches(text: Column | str, search: str | TextQuery) -> Column:
    """True where the text satisfies the search string; never null."""
    query = parse_search(search) if isinstance(search, str) else search
    if not query.terms and not query.phrases:
        return F.lit(False)

    def holds(folded: Column) -> Column:
        # With phrases present the bare terms no longer widen the result: every phrase has to occur.
        if query.phrases:
            wanted = reduce(and_, [_stands(folded, p) for p in query.phrases])
        else:
            wanted = reduce(or_, [_stands(folded, [w]) for w in query.terms])
        unwanted = [*query.banned_phrases, *[[w] for w in query.banned_terms]]
        return reduce(and_, [wanted, *[~_stands(folded, u) for u in unwanted]])

    return _with_folded(text, holds)


def matches_any(text: Column | str, searches: Iterable[str]) -> Column:
    """Disjunction of search strings."""
    return reduce(or_, [matches(text, s) for s in searches], F.lit(False))


def searched_text(*fields: Column | str) -> Column:
    """The text a search reads: all fields, a blank between them."""
    return F.concat_ws(" ", *fields)


def _one_of(folded: Column, term: str) -> Column:
    """A term of several tokens needs one of them; one without any token occurs nowhere."""
    return reduce(or_, [_stands(folded, [w]) for w in words_of(term)], F.lit(False))


def matched_positions(text: Column | str, terms: Sequence[str]) -> Column:
    """Which terms occur, as 1-based positions in the list."""
    return _with_folded(
        text, lambda x: F.array_compact(F.array(*[F.when(_one_of(x, t), F.lit(i)) for i, t in enumerate(terms, 1)]))
    )


def first_position(text: Column | str, terms: Sequence[str]) -> Column:
    """Position of the earliest listed term that occurs, null where none does; later ones are not looked for."""

    def first(folded: Column) -> Column:
        chain = F
        for position, term in enumerate(terms, 1):
            chain = chain.when(_one_of(folded, term), F.lit(position))
        return chain

    return _with_folded(text, first)


def vocabulary(*lists: Iterable[str], without: Iterable[str] = ()) -> list[str]:
    """Term lists put together, each term once and in order, some taken out."""
    dropped = set(without)
    return [t for t in dict.fromkeys(t for terms in lists for t in terms) if t not in dropped]


# ---- track terms on live text: names keep their at-sign, underscores belong to words

_TRACK_CHAR = r"[\p{L}\p{N}_]"


def track_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(rf"@?{_TRACK_CHAR}+"), F.lit(0))


def track_hits(text: Column | str, tracks: Sequence[str]) -> Column:
    """The track terms that occur in the text, as listed and in list order."""

    def occurs(folded: Column, track: str) -> Column:
        word = track.strip().lower().translate(_FOLD)
        literal = re.escape(word)
        # An at-sign always opens a token; a bare word must not follow one, nor another word character.
        before = "" if word.startswith("@") else rf"(?<![\p{{L}}\p{{N}}_@]{literal})"
        return folded.contains(word) & F.rlike(folded, F.lit(rf"{literal}(?!{_TRACK_CHAR}){before}"))

    return _with_folded(
        text, lambda x: F.array_compact(F.array(*[F.when(occurs(x, t), F.lit(t)) for t in tracks]))
    )
