"""Plain single-machine statements of what the operators return."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
LAST = 1 << 62


def words(text):
    return re.findall(f"[^{BLANK}]+", text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def near_classes(rows):
    """Per row (doc_id, set size, smallest id reachable) of Jaccard links on 5-word shingles."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, text in rows:
        w = words((text or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    postings, up = defaultdict(list), list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            postings[g].append(i)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for x, k in Counter(x for g in s for x in postings[g] if x > i).items():
            if 100 * k >= 75 * (len(s) + len(sets[x]) - k):
                up[find(i)] = find(x)
    least = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        least[root] = min(least.get(root, LAST), LAST if doc is None else doc)
    real = lambda x: None if x == LAST else x
    return [(doc, len(sets[i]), real(least[find(i)])) for i, (doc, _) in enumerate(rows)]


def repeated_words(rows, width=20):
    """Per row (doc_id, words, removed, sha256 of the kept words) and the kept words."""
    first = {}
    order = [(LAST if doc is None else doc, words(text)) for doc, text in rows]
    for doc, w in order:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for (doc, w), (real, _) in zip(order, rows, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < (doc, i):
                gone[i : i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((real, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def repeated_bytes(rows, width=50):
    """Per row (doc_id, bytes, removed, spans, sha256 of the kept bytes)."""
    least = {}
    texts = [(LAST if doc is None else doc, (text or "").encode()) for doc, text in rows]
    for doc, data in texts:
        for i in range(len(data) - width + 1):
            key = data[i : i + width]
            if doc < least.get(key, LAST + 1):
                least[key] = doc
    out = []
    for (doc, data), (real, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if least[data[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((real, len(data), len(data) - len(kept), spans, sha(kept)))
    return out


def exact_classes(rows):
    """Per row (doc_id, keep_id, group size, sha256 of the text without blanks)."""
    norm = [re.sub(f"[{BLANK}]", "", text or "") for _, text in rows]
    groups = defaultdict(list)
    for (doc, text), key in zip(rows, norm, strict=True):
        groups[key].append((-len(text or ""), doc is None, doc or 0, doc))
    return [(doc, min(groups[key])[3], len(groups[key]), sha(key)) for (doc, _), key in zip(rows, norm, strict=True)]


def quality(text):
    """(words, word characters, symbols, equal lines, repeated words, base failed)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    n = len(w)
    return (
        n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
        n < 50 or 100 * len(again) > 50 * n,
    )
