"""Plain-Python counterparts of the operators, and a table of odd rows."""

from __future__ import annotations

import re
import string
import zlib
from collections import defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, bucket int, size long, key string"


def low(text: str | None) -> str:
    return (text or "").translate(LOWER)


def space_words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(low(text))


def plain_words(text: str | None) -> list[str]:
    return PLAIN_WORD.findall(low(text))


def crc(x: object) -> int:
    return zlib.crc32(("" if x is None else str(x)).encode())


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows; extra columns
    whose names operators use inside."""
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the dark wood tonight"
    long_text = " ".join(f"word{i % 997} Other{i}" for i in range(30_000))
    texts = [
        (1, base), (2, base.upper()), (3, base + " extra"), (4, None), (5, ""), (6, "   \n\t "), (7, "one two three"),
        (8, "ONE two  three"), (9, long_text), (10, long_text + " end"), (11, "1234 5678 !!"), (11, "another text here"),
        (11, "another text here"), (None, base), (None, None), (12, "dünne Äpfel für größere Öfen"),
        (13, "DÜNNE Äpfel für größere Öfen"), (14, "<|im_end|> <|endoftext|> don't we'll 'RE x's"),
        (15, "İstanbul Σας 日本語 text 🙂"), (16, base), (-5, base),
    ]
    langs, sources = ["en", None, "de"], ["web", None, "", "book"]
    return [(i, t, langs[k % 3], sources[k % 4], len(t) if t else None, "r", 1, 2, "k") for k, (i, t) in enumerate(texts)]


def components(sets: list[frozenset], linked) -> list[int]:
    """Group number of each set by brute force over all pairs."""
    up = list(range(len(sets)))

    def find(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and linked(len(sets[a] & sets[b]), len(sets[a] | sets[b])):
                up[find(a)] = find(b)
    return [find(x) for x in range(len(sets))]


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = space_words(text)
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def jaccard_rows(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    group = components(sets, lambda i, u: 100 * i >= 75 * u)
    members = defaultdict(list)
    for (doc, _), g in zip(rows, group):
        members[g].append(doc)
    out = []
    for (doc, _), s, g in zip(rows, sets, group):
        known = [x for x in members[g] if x is not None]
        out.append((doc, len(s), min(known) if known else None))
    return out


def phrase_hits(rows: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, items) of (doc_id, text) rows."""
    phrases = defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            phrases[tuple(w[i:i + n])].add("" if item is None else str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for doc, text in rows:
        w = plain_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in phrases:
                    hit |= set(range(i, i + n))
                    found |= phrases[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def key(row) -> tuple:
    return tuple((x is not None, x) if not isinstance(x, (list, dict)) else (True, str(x)) for x in row)
