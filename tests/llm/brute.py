"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def shingles(text, size=5):
    words = spaced(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_duplicates(rows, percent=80):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), sorted."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def contamination(text, items):
    """(n_words, n_hit, item ids found) with items (id, text)."""
    words, hit, found = alnum(text), set(), set()
    for item, passage in items:
        wanted = alnum(passage)
        n = min(10, len(wanted))
        windows = {tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def kept_lines(rows, size=5, percent=80):
    """Per document (in id order) the numbers of the lines that match an earlier line."""
    earlier, out = [], {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        for at, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
            own = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
            if not own:
                continue
            if any(100 * len(own & s) >= percent * len(own | s) for s in earlier):
                out.setdefault(doc, []).append(at)
            earlier.append(own)
    return out

