"""Members of cut nodes: the join by differences against all pairs, and how the stored rows grow."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from flowlog.llm import neardup  # noqa: E402


def sets_around(rng, n, percent_changed):
    """Sets that share most of a base, some parts of it missing in many, with additions of their own and common ones."""
    base = rng.sample(range(10_000), rng.randint(20, 60))
    out = []
    for _ in range(n):
        own = {x for x in base if rng.random() > percent_changed / 100}
        own |= {rng.randrange(10_000, 10_060) for _ in range(rng.randint(0, 4))}
        own |= {rng.randrange(20_000, 10**6) for _ in range(rng.randint(0, 4))}
        out.append(own or {1})
    return out


def differences(sets, percent):
    """Tokens and excess as ``_differences`` gives them."""
    held = {}
    for s in sets:
        for x in s:
            held[x] = held.get(x, 0) + 1
    usual = {x for x, n in held.items() if 2 * n > len(sets)}
    tokens = [sorted((usual - s) | {x for x in s - usual if held[x] > 1}) for s in sets]
    excess = [(100 + percent) * len(usual ^ s) - (100 - percent) * len(s) for s in sets]
    return [np.array(t, np.int64) for t in tokens], np.array(excess, np.int64)


def labelled(n, links):
    label = list(range(n))
    for u, v in links:
        a, b = label[u], label[v]
        label = [a if x == b else x for x in label]
    return {frozenset(i for i in range(n) if label[i] == x) for x in label}


@pytest.mark.parametrize("percent", [80, 85])
def test_differences_give_the_components_of_all_pairs(percent):
    rng = random.Random(percent)
    linked = apart_pairs = 0
    for _ in range(60):
        sets = sets_around(rng, rng.randint(2, 50), rng.choice([2, 5, 8, 15, 40]))
        if rng.random() < 0.3:  # a second base, of which the usual shingles are none
            sets += sets_around(rng, rng.randint(1, 20), 4)
        n = len(sets)
        tokens, excess = differences(sets, percent)
        links = {
            (i, j) for i in range(n) for j in range(i)
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
        }
        least = int(excess.argmin())
        near = excess + excess[least] <= 0
        star = [(i, least) for i in np.flatnonzero(near).tolist() if i != least]
        assert all((max(p), min(p)) in links for p in star)
        root = np.where(near, least, np.arange(n))
        values, counts = np.unique(root, return_counts=True)
        apart = root != values[counts.argmax()]
        some = np.flatnonzero([len(t) > 0 for t in tokens])
        found = []
        if len(some):
            found = neardup.difference_links([tokens[i] for i in some], excess[some], root[some], apart[some], percent)
        found = [(int(some[u]), int(some[v])) for u, v in found]
        assert all((max(p), min(p)) in links for p in found)
        assert labelled(n, star + found) == labelled(n, links)
        linked += len(links)
        apart_pairs += n * (n - 1) // 2 - len(links)
    assert linked > 500 and apart_pairs > 500


def template_rows(n, seed):
    """Two templates, copies of which are alike at about 0.68 and at about 0.82."""
    rng = random.Random(seed)
    rows = []
    for name, changes in (("a", 4), ("b", 2)):
        base = [f"{name}{i}" for i in range(205)]
        for i in range(n):
            copy = base[:]
            for at in rng.sample(range(205), changes):
                copy[at] = f"z{name}{i}_{at}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_rows_grow_with_a_template_group_not_with_its_pairs(spark, monkeypatch):
    stored, rows_of = neardup.stored, {}

    def counting(frame, name):
        out = stored(frame, name)
        rows_of[name] = rows_of.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(neardup, "stored", counting)
    seen = []
    for n in (100, 200):
        rows_of.clear()
        rows = template_rows(n, 3)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = neardup.near_duplicates(docs, neardup.Join(leaf=16, local=32, block=1500))
        assert sorted(tuple(r) for r in found.collect()) == sorted(brute.components(rows))
        seen.append(dict(rows_of))
    small, large = seen
    assert small["differences"] > 100  # the nodes were cut
    grown = {name: large[name] / small[name] for name in ("nodes", "clusters", "placed", "sets", "differences", "able")}
    assert max(grown.values()) <= 2.2, (grown, small, large)
