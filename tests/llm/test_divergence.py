"""The divergence audit against a plain version, with blocks that spill often."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from flowlog.llm import divergence

SCHEMA = "lang string, text string, source string, term string, shard int, run string, p int, v string, n string, postings int"


def plain(rows, min_docs=3, top=200):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, text, source in rows]
    docs = [(g, s, ["".join(c.lower() if c < "\x80" else c for c in t) for t in terms]) for g, s, terms in docs]
    found = []
    for lang in {g for g, _, _ in docs}:
        own = [(s, terms) for g, s, terms in docs if g == lang]
        in_docs = Counter(t for _, terms in own for t in set(terms))
        kept = [t for t, n in in_docs.items() if n >= min_docs]
        counts = {s: Counter() for s, _ in own}
        for s, terms in own:
            counts[s].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), Counter())

        def rates(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        rate, q = {s: rates(c) for s, c in counts.items()}, rates(whole)
        for s, p in rate.items():
            pair = [(sum((p[t] - r[t]) ** 2 // r[t] for t in kept), o) for o, r in rate.items() if o != s]
            term = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, items, limit in (("pair", pair, len(pair)), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:limit])]
    return sorted(found)


def table():
    rng = random.Random(11)
    words = ["Alpha", "beta", "GAMMA", "dé", "Éa", "ÉA", "好", "好好", "x1y", "it's", "a_b", "Z", "ß", "tie", "Tie", "[k]", "\U0001f600a"]
    rows = [(None, None, None), ("en", "", "empty"), ("en", None, "none"), ("xx", "only once here", "s"), ("yy", "1 2 3", None)]
    for i in range(120):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", None, "ä", "hot", "hot"])
        rows.append((lang, " ".join(rng.choice(words[: 5 + i % 13]) for _ in range(rng.randint(0, 40))), source))
    rows += [("en", "same same tie", "b")] * 3 + [("de", "Alpha " * 5000, "hot")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "r", 2, "v", "n", 3) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block, shards, chunk", [(1, 3, 5), (40, 1, 1 << 20), (400_000, 7, 1 << 20)])
def test_equals_the_plain_version(spark, monkeypatch, block, shards, chunk):
    monkeypatch.setattr(divergence, "CHUNK_PAIRS", chunk)
    rows = table()
    got = divergence.audit(frame(spark, rows), block_postings=block, shards=shards)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_only_the_top_terms_are_reported(spark):
    rows = table()
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), top=4, min_docs=2).collect())) == plain(rows, 2, 4)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).collect() == []


def test_counts_beyond_64_bits_of_product(spark):
    rates = spark.sql("select 20000000000L as c, 30000000000L as s").select(divergence._rate(divergence.F.col("c"), divergence.F.col("s")))
    assert rates.first()[0] == 1 + 10**9 * (20_000_000_001) // 30_000_000_000


def test_runs_are_in_order_and_merge_to_all_counts():
    blocks = [divergence.Block() for _ in range(3)]
    for i, block in enumerate(blocks):
        block.add(b"en", b"s%d" % (i % 2), b"b a a c " * (i + 1))
        block.add(b"en", b"s2", b"A d")
    runs = [run for block in blocks for _, _, run in block.runs(1)]
    for run in runs:
        terms = divergence._unpacked(run)[1]
        assert terms == sorted(terms)
    found = {term: dict(counts) for term, counts in divergence.merged(runs, 3)}
    assert found == {b"a": {b"s0": 8, b"s1": 4, b"s2": 3}, b"b": {b"s0": 4, b"s1": 2}, b"c": {b"s0": 4, b"s1": 2}, b"d": {b"s2": 3}}
