"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def duplicate_words(docs, k=13):
    """``(doc_id, n_words, n_removed, kept_sha256)`` per ``(doc_id, text)``."""
    order = lambda i: float("inf") if i is None else i
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, order(doc_id)), order(doc_id))
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < order(doc_id):
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def components(docs, percent=85):
    """``(doc_id, n_shingles, component_id, kept)`` per ``(doc_id, text)``, all pairs that share a shingle compared."""
    sets = [shingles(t) for _, t in docs]
    inverted = {}
    for i, s in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seen = set()
    for group in inverted.values():
        for a in range(len(group)):
            for b in range(a):
                i, j = group[b], group[a]
                if (i, j) in seen:
                    continue
                seen.add((i, j))
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    x, y = find(i), find(j)
                    if x != y:
                        root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        c = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), c, c is None or c == doc_id))
    return out


def edit_to_stretch(item, text):
    """Smallest edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
