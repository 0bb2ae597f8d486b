"""The operators against plain versions, on small tables with every odd case."""

from __future__ import annotations

import hashlib
import os
import random
import string
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from flowlog.llm import (  # noqa: E402
    chat,
    components,
    decontaminate,
    mixing,
    neardup,
    pieces,
    quality,
    substrings,
    toxicity,
    urls,
    warc,
    words,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row string, words string, "
    "hash int, size int, spans string, copies int, cls int, block string, doc string, sketch string, kept string"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def prose(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


def texts():
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 30)
    near = base.split()
    near[60] = "changed"
    chain = near[:]
    chain[5] = "again"
    repeated = "\n".join(["one line that comes again and again here"] * 6) + "\n" + prose(rng, 30)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, " ".join(chain)), (5, base.upper()), (5, base.upper()),
        (6, prose(rng, 40) + "\t" + passage + "\n" + prose(rng, 40)), (7, passage + "\x0b" + prose(rng, 9)),
        (8, prose(rng, 12) + "\r\n" + passage), (9, None), (10, ""), (11, "  \n\t "), (12, "one two three"),
        (13, "ONE two three"), (14, "one"), (15, "a b c d e"), (None, base), (None, prose(rng, 25)), (None, None),
        (16, repeated), (17, "x" * 5000), (18, "é ß " * 40), (19, prose(rng, 20000)), (20, "| " * 60 + prose(rng, 60)),
        (21, "Du " * 80), (22, "\n".join(["same words here"] * 30 + [prose(rng, 40)])), (23, "GO!! " * 5 + "\n".join(prose(rng, 9) for _ in range(9))),
        (24, prose(rng, 200).replace(" ", "!! ")),
    ]
    rows += [(30 + i, prose(rng, rng.randint(1, 200), 12)) for i in range(60)]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    sources = ["b", "a", None, "", "b", "b", "ä"]
    odd = ["x", None, "y", "z", 1, 2, "s", 3, 4, "t", "u", "v", None]
    odd[4:6], odd[7:9] = [1, 2], [3, 4]
    data = [(i, t, "en", sources[n % 7], 0, "k", "r", "w", 1, 2, "s", 3, 4, "b", "d", "s", "k") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# quality rules


def plain_quality(doc_id, text):
    text = text or ""
    w = brute.words(text)
    lines = [x for x in text.split("\n") if brute.words(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    n, chars = len(w), sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in text)
    dup = len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    more = symbols * 10 > 4 * n or text.count("!") * 10 > 4 * n or dup * 100 > 40 * len(lines) or not 2 * n <= chars <= 20 * n
    return (doc_id, n, chars, symbols, dup, len(covered), failed, not failed and not more)


def test_quality_report_and_filter(spark):
    docs = frame(spark)
    want = sorted((plain_quality(*r) for r in texts()), key=str)
    assert collected(quality.quality_report(docs)) == want
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        str(r) for r in texts() if plain_quality(*r)[-1]
    )


def test_cascade_asks_the_rule_with_the_best_gain_first(spark):
    docs = frame(spark, [(i, "ab " * 30 if i % 2 else prose(random.Random(i), 60)) for i in range(40)])
    found = quality.estimate(docs, fraction=1.0)
    assert sorted(e.rule.name for e in found) == sorted(r.name for r in quality.RULES)
    assert [e.gain for e in found] == sorted((e.gain for e in found), reverse=True)
    assert {e.rule.name: e.rejected for e in found}["repeats_windows"] == 20
    plan = quality.quality_filter(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# token counts


def greedy(vocabulary, word, longest):
    s, i, n = (*word, 256), 0, 0
    while i < len(s):
        j = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in vocabulary), 0)
        if not j:
            return 0
        i, n = j, n + 1
    return n


@pytest.mark.parametrize("seed", range(5))
def test_automaton_equals_greedy_matching(seed):
    rng = random.Random(seed)
    vocabulary = {tuple(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) + ((256,) if rng.random() < 0.4 else ()) for _ in range(9)}
    automaton = pieces.Automaton(sorted(vocabulary))
    for _ in range(400):
        word = bytes(rng.choice(b"abcd"[: 3 + (seed % 2)]) for _ in range(rng.randint(0, 10)))
        assert automaton.count(word) == greedy(vocabulary, word, 5)


def test_token_counts(spark):
    vocabulary = set(pieces.read_pieces())
    longest = max(map(len, vocabulary))
    want = []
    for doc_id, text in texts():
        counts = [greedy(vocabulary, w.translate(brute.LOWER).encode(), longest) for w in brute.words(text)]
        want.append((doc_id, len(counts), sum(max(c, 1) for c in counts), counts.count(0)))
    assert collected(pieces.token_counts(frame(spark))) == sorted(want, key=str)
    few = pieces.token_counts(frame(spark), pieces=[(97,), (98, 256)])
    assert few.where("n_unknown > 0").count() > 0


# substring dedup


@pytest.mark.parametrize("chunk", [1 << 21, 50])
def test_duplicate_words(spark, chunk, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", chunk)
    want = sorted(brute.duplicate_words(texts()), key=str)
    assert collected(substrings.duplicate_words(frame(spark))) == want
    assert sum(r[2] for r in want) > 300
    unique = [r for n, r in enumerate(texts()) if r[0] is not None and n != 5]
    assert collected(substrings.duplicate_words(frame(spark, unique), k=3, anchor=2)) == sorted(
        brute.duplicate_words(unique, 3), key=str
    )


def test_factors_copy_what_they_say(spark):
    unique = [r for n, r in enumerate(texts()) if r[0] is not None and n != 5]
    own = {i: brute.words(t) for i, t in unique}
    rows = substrings.factors(frame(spark, unique), unique=True).where("source IS NOT NULL").collect()
    for r in rows:
        assert r.n >= 13 and r.source < r.key
        assert own[r.key][r.first : r.first + r.n] == own[r.source][r.source_first : r.source_first + r.n]


def test_remove_duplicates_cuts_words_and_keeps_bytes(spark):
    docs = frame(spark)
    cut = substrings.remove_duplicates(docs)
    assert cut.columns == docs.columns
    got = {(r.doc_id, hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest()) for r in cut.collect()}
    want = {(i, h) for i, n, gone, h in brute.duplicate_words(texts()) if not gone or gone < n}
    assert got == want
    assert cut.where("doc_id = 6").first().text == dict(texts())[6]  # nothing to cut: every byte stays
    assert substrings.cut(b" a  b\nc d", [{"first": 1, "n": 2}]) == b" a  d"


# mixing


def plain_mix(rows, sources):
    size = [len(brute.words(t)) for _, t in rows]
    total = {}
    for s, n in zip(sources, size, strict=True):
        total[s] = total.get(s, 0) + n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        level = (sum(size) - sum(3 * total[s] for s in capped)) / free
        more = {s for s in names if s not in capped and level * weight[s] > 3 * total[s]}
        if not more:
            break
        capped |= more
    return size, total, {s: 3 * total[s] if s in capped else level * weight[s] for s in names}


def test_mix_meets_targets(spark):
    docs = frame(spark)
    rows = [((r.doc_id, r.text), r.source) for r in docs.collect()]
    size, total, target = plain_mix([r for r, _ in rows], [s for _, s in rows])
    got = mixing.mix_table(docs).collect()
    assert sorted((str(r.doc_id), r.size, r.source_size) for r in got) == sorted(
        (str(i), n, total[s]) for ((i, _), s), n in zip(rows, size, strict=True)
    )
    by_target = {}
    for r in got:
        assert r.taken <= 3 * r["size"]
        assert r["size"] == 0 or r.taken % r["size"] == 0
        by_target.setdefault(round(r.target, 6), []).append(r)
    assert sorted(by_target) == sorted({round(t, 6) for t in target.values()})
    assert collected(mixing.mix_table(docs.repartition(3))) == collected(mixing.mix_table(docs))


def test_mix_taken_is_within_half_a_document(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 90))) for i in range(400)]
    got = mixing.mix_table(frame(spark, rows)).collect()
    taken, targets = {}, {}
    for r in got:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        targets[r.source_size] = r.target
    assert all(abs(taken[s] - targets[s]) <= 45 for s in targets)
    mixed = mixing.mixed(frame(spark, rows))
    assert mixed.columns == [c for c in NAMES if c != "copies"] + ["copies"]
    assert sum(len(brute.words(r.text)) * r.copies for r in mixed.collect()) == sum(r.taken for r in got)


# WARC


def test_archives_round_trip_and_index(spark, tmp_path):
    html = ["<p>a</p>", None, "", "é" * 9, "line\r\n\r\nWARC/1.1\r\nWARC-Type: x", "<p>a</p>", "z" * 100_000, "<p>a</p>"]
    links = ["http://B.example.com/x?q#f", None, "no link", "https://u@a.example.com:80", "http://b.example.com/x?q", "", "://x", "a\r\nb://c"]
    rows = [(i if i != 3 else None, links[i % 8], html[i % 8], "own", i) for i in range(60)] + [(5, links[5], html[5], "own", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, kept int").repartition(4)
    got = warc.archived(pages, str(tmp_path / "w")).collect()
    payload = [(r[0], (r[2] or "").encode()) for r in rows]
    last = {}
    for i, p in payload:
        last[p] = max(last.get(p, -1), -1 if i is None else i)
    import base64

    want = sorted(
        str((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if i == last[p] else "revisit", None if i == last[p] else last[p]))
        for i, p in payload
    )
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    keys = [(r.url_key.encode(), r.captured, -1 if r.page_id is None else r.page_id) for r in got]
    assert keys == sorted(keys)
    seen = {}
    for r in got:
        seen[r.url_key] = seen.get(r.url_key, 0) + 1
        assert r.capture_no == seen[r.url_key]
    assert warc.url_key("http://u@B.example.com:80/x?q#f") == "com,example,b)/x?q"


def test_loser_tree_merges(monkeypatch):
    rng = random.Random(2)
    for _ in range(200):
        runs = [
            sorted(({"url_key": rng.choice("abc"), "captured": str(rng.randint(0, 3)), "page_id": rng.choice([None, 1, 2])} for _ in range(rng.randint(1, 6))), key=warc._key)
            for _ in range(rng.randint(0, 7))
        ]
        assert [warc._key(r) for r in warc.LoserTree(runs)] == sorted(warc._key(r) for run in runs for r in run)


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    got = warc.archived(pages, str(tmp_path / "w"), min_bytes=3).collect()
    assert {r.record_type for r in got} == {"response"}


# URL filters


def test_cascade_is_exact_in_any_number_of_lots(spark):
    keys = [(f"k{i}", i % 7 == 0) for i in range(5000)] + [(None, True), ("", False)]
    universe = spark.createDataFrame(keys, "key string, listed boolean")
    filters = urls.cascade(universe, shard_keys=300)
    rows = spark.createDataFrame([(k, "x", 1) for k, _ in keys] * 2, "key string, shard string, first int")
    for lot_bytes in (1 << 20, 2000, 1):
        found = urls.with_listed(rows, "key", filters, lot_bytes=lot_bytes).collect()
        assert len(found) == 2 * len(keys)
        assert {r.key for r in found if r.listed} == {k for k, yes in keys if yes and k is not None}
    assert filters.levels.agg({"level": "max"}).first()[0] >= 2
    none = urls.cascade(universe.withColumn("listed", universe.listed & ~universe.listed))
    assert not [r for r in urls.with_listed(rows, "key", none).collect() if r.listed]


def test_url_rules(spark):
    links = [
        ("http://www.Example.com/en/x?a#b", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://a.example.com/en/x", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("ftp://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://x.com", "x.com", "", None, "allow"),
        ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        ("http://x.net/de/1", "x.net", "/de/1", None, "block"),
        ("http://y.net/de/1://z", "y.net", "/de/1://z", None, "allow"),
        ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
        ("http://É.org?x/y", "É.org", "", None, "allow"),
        ("no link", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "k") for i, (u, *_) in enumerate(links)], "page_id long, url string, listed string")
    got = collected(urls.judged(pages))
    assert got == sorted(((i, *rest) for i, (_, *rest) in enumerate(links)), key=str)


# chat formatting


def test_preference_examples(spark):
    ok = [("p", 0, "system", "s"), ("p", 1, "user", "u"), ("p", 1, "user", "u")]
    chosen = ok + [("p", 2, "assistant", "good"), ("p", 3, "user", None), ("p", 4, "assistant", ""), ("only", 0, "user", "x"), ("same", 0, None, None), (None, 0, "user", "x")]
    rejected = ok + [("p", 2, "assistant", "bad"), ("same", 0, None, None), ("late", 0, "assistant", "é")]
    schema = "pair_id string, turn int, role string, text string"
    frames = [spark.createDataFrame(r, schema).selectExpr("*", "1 AS side", "'x' AS prompt") for r in (chosen, rejected)]
    got = {r.pair_id: r for r in chat.preference_examples(*frames).collect()}
    assert set(got) == {"p", "only", "same", "late"}
    p = got["p"]
    assert (p.prompt_turns, p.prompt) == (2, "<|system|>\ns\n<|end|>\n<|user|>\nu\n<|end|>\n")
    assert p.chosen == "<|assistant|>\ngood\n<|end|>\n<|user|>\n\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert [p.chosen[r.begin : r.end] for r in p.chosen_trained] == ["good\n<|end|>\n", "\n<|end|>\n"]
    assert [p.rejected[r.begin : r.end] for r in p.rejected_trained] == ["bad\n<|end|>\n"]
    assert (got["same"].prompt_turns, got["same"].chosen, got["same"].rejected) == (1, "", "")
    assert (got["only"].prompt_turns, got["only"].rejected) == (0, "")
    assert got["late"].rejected == "<|assistant|>\né\n<|end|>\n"
    plan = chat.preference_examples(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# near duplicates


def near_rows(seed):
    """Groups of near copies around many texts, one of them large, besides odd cases."""
    rng = random.Random(seed)
    rows = texts()
    at = 1000
    for group in range(12):
        base = prose(rng, rng.randint(60, 160), 2000).split()
        for _ in range(60 if group == 0 else 4):
            copy = base[:]
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"z{rng.randint(0, 999)}"
            rows.append((at, " ".join(copy)))
            at += rng.randint(1, 5)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("join", [neardup.Join(), neardup.Join(leaf=8, local=16)])
def test_near_duplicates(spark, join):
    rows = near_rows(1)
    want = sorted(brute.components(rows), key=str)
    assert collected(neardup.near_duplicates(frame(spark, rows), join)) == want


def template_rows(n, seed, words=505, changes=5):
    """One text with a few words changed in each copy: most pairs are just below the threshold, few above."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(words)]
    rows = []
    for i in range(n):
        copy = base[:]
        for at in rng.sample(range(words), changes):
            copy[at] = f"z{i}_{at}"
        rows.append((i, " ".join(copy)))
    return rows


def test_near_duplicates_in_a_large_template_group(spark):
    rows = template_rows(300, 6)
    want = sorted(brute.components(rows), key=str)
    assert len({c for _, _, c, _ in want}) == 33
    assert collected(neardup.near_duplicates(frame(spark, rows), neardup.Join(leaf=32, local=64))) == want


def test_cut_nodes_come_before_the_recall_is_lost():
    rng = random.Random(1)
    for percent in (80, 85, 90):
        join = neardup.Join(percent=percent)
        s, two, met, n = join.threshold, 1 / join.threshold - 1, 0.0, 4000
        for _ in range(n):  # a sketch of a pair at the threshold, and its chance in the trees
            share = sum(rng.random() < s for _ in range(neardup.COORDINATES)) / neardup.COORDINATES
            never = 0.0
            for _ in range(join.levels):
                miss = 1 - share * (1 - never)
                never = (1 - two) * miss + two * miss**2
            met += (1 - never**join.trees) / n
        assert join.levels >= 2 and met >= join.recall - 0.001


def test_drop_near_duplicates_keeps_one_of_each(spark):
    rows = near_rows(2)
    docs = frame(spark, rows)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    parts = brute.components(rows)
    groups = {}
    for (doc_id, text), (_, n, c, _) in zip(rows, parts, strict=True):
        groups.setdefault((c, n > 0 or (doc_id, text)), []).append((doc_id, text))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    full = [(i, t) for i, t in got if brute.words(t)]
    named = {c for (c, _), members in groups.items() if c is not None and brute.words(members[0][1])}
    assert sorted(i for i, _ in full if i is not None) == sorted(named)
    assert len(full) == len(named) + 1  # the text whose only id is null
    assert len(got) - len(full) == len({(i, t) for i, t in rows if not brute.words(t)})


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(120)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}


# decontamination


def test_runs_of_a_word_are_not_taken_for_an_item(monkeypatch):
    item = decontaminate._items([{"item_id": 1, "text": "w " * 16 + "a b c d e f g h"}])[0]
    index, verified = decontaminate.Index([item]), []
    exact = decontaminate.edit_end
    monkeypatch.setattr(decontaminate, "edit_end", lambda *args: verified.append(1) or exact(*args))
    run, = words.hashed_words(pa.array(["w " * 300]), lower=True)
    assert len(index.candidates(run)) > 100 and index.leaks(run) == {} and not verified
    found, = words.hashed_words(pa.array(["x " + "w " * 16 + "a b c d e f g"]), lower=True)
    assert index.leaks(found) == {0: {0: (1, 1, 23)}}


def test_edit_end_stops_at_the_least_distance_and_lacking_is_a_lower_bound():
    rng = random.Random(6)
    for _ in range(3000):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        text = [rng.randrange(8) for _ in range(rng.randint(0, 60))]
        distance, end = decontaminate.edit_end(item, text)
        assert decontaminate.edit_end(item, text, distance) == (distance, end)
        assert decontaminate.Item(1, item).lacking(text) <= distance


def test_leaks_are_found_with_their_exact_distance(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.choice([8, 9, 12, 17, 25, 40, 55, 90, 130]), 3000)) for i in range(60)]
    items += [(60, items[0][1]), (61, None), (62, ""), (63, "too short to be sampled"), (64, "three Short words"), (None, prose(rng, 30, 3000))]
    docs, planted = [], {}
    for d in range(150):
        text = prose(rng, rng.randint(0, 80), 3000).split()
        if d % 3 == 0:
            item, body = items[rng.randrange(60)]
            body = body.split()
            for _ in range(rng.randint(0, len(body) // 10)):
                at = rng.randrange(len(body))
                kind = rng.randrange(3)
                body[at : at + (kind != 0)] = [] if kind == 1 else [f"e{rng.randint(0, 99)}"]
            at = rng.randint(0, len(text))
            text[at:at] = body
            planted[d] = item
        docs.append((d, "\n".join(text).upper() if d % 2 else " ".join(text)))
    docs += [(910, "a b too short to sampled c"), (911, "three short x words"), (912, "x three short words"), (913, "too short be")]
    docs += [(None, items[1][1]), (900, None), (901, ""), (902, items[2][1]), (902, items[2][1])]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, distance string")
    found = decontaminate.contaminated(frame(spark, docs), benchmark)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = found.collect()
    low = lambda t: brute.words((t or "").translate(brute.LOWER))
    by_doc = dict(docs)
    for r in got:
        if r.item_id is not None and r.doc_id is not None:
            item = low(dict(items)[r.item_id])
            own = low(by_doc[r.doc_id])
            assert r.distance == brute.edit_to_stretch(item, own) <= len(item) // 5
            assert brute.edit_to_stretch(own[r.first_word : r.first_word + r.n_words], item) <= r.distance
    pairs = {(r.doc_id, r.item_id) for r in got}
    want = {
        (d, i)
        for d, t in docs
        for i, x in items
        if low(x) and low(t) and brute.edit_to_stretch(low(x), low(t)) <= len(low(x)) // 5
    }
    assert {(d, i) for d, i in planted.items()} | {(910, 63), (912, 64)} <= want
    assert not {(911, 64), (913, 63)} & want
    assert pairs <= want and len(pairs & want) >= 0.99 * len(want)
    assert sum(r.doc_id == 902 for r in got) == 2
    clean = decontaminate.drop_contaminated(frame(spark, docs), benchmark)
    assert clean.columns == NAMES
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in pairs}


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, 20, 3000)) for i in range(30)]
    docs = frame(spark, [(i, prose(rng, 9) + " " + t) for i, t in items])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = collected(decontaminate.contaminated(docs, benchmark))
    kept = collected(decontaminate.drop_contaminated(docs, benchmark))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    assert len(list(decontaminate.item_blocks(benchmark))) > 3
    found = decontaminate.contaminated(docs, benchmark)
    assert str(found._jdf.queryExecution().optimizedPlan()).count("ArrowEvalPython") == 1  # other passes are written
    assert collected(found) == whole and len(whole) == 30
    assert collected(decontaminate.drop_contaminated(docs, benchmark)) == kept


def edited(rng, body, edits):
    body = list(body)
    for _ in range(edits):
        at = rng.randrange(len(body))
        kind = rng.randrange(3)
        body[at : at + (kind != 0)] = [] if kind == 1 else [f"e{rng.randint(0, 99)}"]
    return body


@pytest.mark.parametrize("n", [1, 4, 5, 7, 8, 9, 11, 12, 17, 18, 23, 24, 26, 35, 36, 47, 48, 60, 71, 72, 90, 130])
def test_items_meet_passages_with_all_edits_allowed(n):
    """Passages of ``n`` words with ``n // 5`` random edits, between other words."""
    rng = random.Random(n)
    items = [[f"w{rng.randint(0, 3000)}" for _ in range(n)] for _ in range(300)]
    texts = [
        prose(rng, rng.randint(0, 40), 3000).split() + edited(rng, item, n // 5) + prose(rng, 40, 3000).split()
        for item in items
    ]
    own = words.hash_texts(0, [" ".join(x).encode() for x in items])
    hashes = [own.hashes[a:b].tolist() for a, b in zip(own.offsets, own.offsets[1:], strict=False)]
    index = decontaminate.Index([decontaminate.Item(i, x) for i, x in enumerate(hashes)])
    found = index.leaks(words.hash_texts(0, [" ".join(x).encode() for x in texts]))
    met = sum(i in found.get(i, {}) for i in range(len(items))) / len(items)
    assert met == 1 if n < decontaminate.WALKED_WORDS else met >= decontaminate.TARGET_RECALL - 0.01


# toxicity


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = prose(rng, rng.randint(5, 150), 400).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randint(0, len(text)), rng.choice(["dreadful", "Vile,", "nasty", "rotten."]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1 if toxic else 0))
    return rows, labels


def test_network_gradients():
    rng = np.random.default_rng(1)
    found = words.hash_texts(0, [b"aa bb cc xyzzy ..."])
    data = np.frombuffer(found.buffer, np.uint8)
    starts, ends = toxicity.cores(data, found.starts, found.ends)
    hashes = words.span_hashes(data, starts, ends)
    net = toxicity.Network.new(hashes[:2])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    own, levels = net.lookup(data, starts, ends, hashes)
    assert sorted(own.tolist()) == [0, 0, 0, 1, 2]
    assert [n.tolist() for _, _, n in levels] == [[2, 2, 2, 5, 1], [1, 1, 1, 4], [3]]
    ids = rng.integers(0, 5, (3, 7))
    ids[0, 5:], ids[2, 2:] = 5, 5
    pull = np.array([1.0, -2.0, 0.5])

    def loss():
        return float(pull @ net.forward(net.gates(net.inputs(own, levels)), ids))

    inputs, keep = net.inputs(own, levels), {}
    gates = net.gates(inputs)
    net.forward(gates, ids, keep)
    grads, _ = net.backward(inputs, gates, ids, keep, pull)
    for name, grad in grads.items():
        flat, g = net.p[name].reshape(-1), np.asarray(grad).reshape(-1)
        for i in rng.integers(0, len(flat), 5):
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - g[i]) < 1e-4


def test_cores_and_trigrams():
    text = "Idiot, (idiot) ... a é! x.y -- \u00bfno? z"
    found = words.hash_texts(0, [text.encode()])
    data = np.frombuffer(found.buffer, np.uint8)
    starts, ends = toxicity.cores(data, found.starts, found.ends)
    own = [found.buffer[a:b].decode() for a, b in zip(starts, ends, strict=True)]
    assert own == ["Idiot", "idiot", "", "a", "é", "x.y", "", "\u00bfno", "z"]
    word, buckets, n = toxicity.ngrams(data, starts, ends)[0]
    assert word.tolist() == list(range(9)) and n.tolist() == [max(1, len(w.encode())) for w in own]
    parts = np.split(buckets, np.cumsum(n)[:-1])
    assert parts[0][2:].tolist() == parts[1][2:].tolist() and parts[2].tolist() == parts[6].tolist()
    assert len({tuple(p) for p in parts}) == 8
    assert [len(w.encode()) for w in own if len(w.encode()) > 2] == [5, 5, 3, 4]
    assert toxicity.ngrams(data, starts, ends)[2][2].tolist() == [3, 3, 1, 2]


def test_windows_cover_and_overlap():
    for n in range(300):
        starts = list(toxicity.window_starts(n))
        covered = {p for s in starts for p in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def plain_logit(net, window):
    """The network over one window, word by word."""
    p, size = net.p, toxicity.HIDDEN
    inputs = []
    for word in window:
        core = word.lower().strip(string.punctuation).encode()
        key = words.hash_texts(0, [core]).hashes if core else words.span_hashes(np.zeros(0, np.uint8), np.zeros(1, int), np.zeros(1, int))
        place = np.flatnonzero(net.vocabulary == key[0])
        own = p["words"][place[0] + 1] if len(place) else np.zeros(toxicity.WORD_DIM)
        marked = b"\x02" + core + b"\x03" * (1 if core else 2)
        grams = []
        for n in toxicity.GRAMS:
            for i in range(len(marked) - n + 1):
                h = (n + sum(int(toxicity._BYTES[j][b]) for j, b in enumerate(marked[i : i + n]))) % 2**64
                grams.append(p["chars"][(h ^ h >> 31) % toxicity.GRAM_VECTORS])
        inputs.append(np.concatenate([own, np.sum(grams, 0) / np.sqrt(len(grams))]))

    def states(way, order):
        h, out = np.zeros(size), {}
        for t in order:
            x, a = inputs[t] @ p["w" + way] + p["c" + way], h @ p["u" + way]
            gate = 1 / (1 + np.exp(-(x + a)))
            z, r = gate[:size], gate[size : 2 * size]
            h = z * h + (1 - z) * np.tanh(x[2 * size :] + r * a[2 * size :])
            out[t] = h
        return out

    forth, back = states("f", range(len(window))), states("b", reversed(range(len(window))))
    both = [np.concatenate([forth[t], back[t]]) for t in range(len(window))]
    weights = np.exp([np.tanh(s @ p["attend"]) @ p["query"] for s in both])
    return float(sum(w * s for w, s in zip(weights / weights.sum(), both, strict=True)) @ p["out"] + p["bias"][0])


def test_scores_equal_a_plain_loop():
    import pyarrow as pa

    rows, labels = toxic_rows(60, 3)
    texts = [t for _, t in rows] + [prose(random.Random(2), 200, 400) + " Vile nasty ... \u00e9t\u00e9!", "!?", "dreadful"]
    windows = [(i, t.split()[s : s + toxicity.WINDOW]) for i, (_, t) in enumerate(rows) for s in toxicity.window_starts(len(t.split()))]
    net = toxicity.train([" ".join(w).encode() for _, w in windows], np.array([i for i, _ in windows]), np.array([y == 1 for _, y in labels]), epochs=3)
    got = toxicity.highest(net, pa.array(texts, pa.string()))
    for text, logit in zip(texts, got, strict=True):
        own = text.split()
        want = max(plain_logit(net, own[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(own)))
        assert abs(want - logit) < 1e-3 * max(1, abs(want))


def test_training_takes_whole_documents_up_to_its_words(spark, monkeypatch):
    rows, labels = toxic_rows(60, 5)
    rows[1] = (1, prose(random.Random(3), 4000, 400))
    trained = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]

    def windows_of(words):
        monkeypatch.setattr(toxicity, "TRAIN_WORDS", words)
        docs, marks = frame(spark, rows + rows[:20]), spark.createDataFrame(labels, "doc_id long, toxic int")
        taken = toxicity.sample(docs, marks).mapInArrow(toxicity._windows, "doc_id long, toxic int, window binary")
        return {(r.doc_id, bytes(r.window)) for r in taken.collect()}

    def plain(ids):
        cut = {i: t.split() for i, t in rows if i in ids}
        return {(i, " ".join(w[s : s + 48]).encode()) for i, w in cut.items() for s in toxicity.window_starts(len(w))}

    assert windows_of(10**6) == plain(trained)
    assert windows_of(3900) == plain(set(trained) - {1})


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows(900, 7)
    rows += [(None, "fine words"), (5000, None), (5001, ""), (5001, ""), (5002, prose(random.Random(1), 5000, 400) + " vile nasty")]
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels + [(3, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    network = toxicity.train_on(docs, marks)
    got = toxicity.scored(docs, network).collect()
    assert len(got) == len(rows)
    label = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    right = sum(r.predicted == label[r.doc_id] for r in held) / len(held)
    assert right >= 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[5002].predicted == 1 and by_id[5000].score == by_id[5001].score < 0.5
    again = {r.doc_id: r.score for r in toxicity.scored(docs.repartition(2), network).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-5 for r in got)
    assert toxicity.train_on(docs, marks.where("toxic = 0")) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}


# empty tables


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    results = [
        quality.quality_report(docs),
        quality.quality_filter(docs),
        pieces.token_counts(docs),
        substrings.duplicate_words(docs),
        substrings.remove_duplicates(docs),
        mixing.mix_table(docs),
        mixing.mixed(docs),
        warc.archived(pages),
        toxicity.scored(docs, toxicity.train_on(docs, labels)),
        decontaminate.contaminated(docs, benchmark),
        decontaminate.contaminated(frame(spark), benchmark),
        decontaminate.drop_contaminated(docs, benchmark),
        urls.judged(pages),
        chat.preference_examples(turns.withColumnRenamed("conv_id", "pair_id"), chat.answers_swapped(turns)),
        neardup.near_duplicates(docs),
        neardup.drop_near_duplicates(docs),
        components.connected(spark.createDataFrame([], "u long, v long")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


# words


def test_hashed_words_are_the_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(words, "BUFFER_BYTES", 500)
    column = pa.array([t for _, t in texts()], pa.string())
    seen = {}
    for found in words.hashed_words(column):
        for i in range(len(found)):
            a, b = found.offsets[i : i + 2]
            own = [found.buffer[s:e].decode() for s, e in zip(found.starts[a:b], found.ends[a:b], strict=True)]
            assert own == brute.words(texts()[found.first + i][1])
            for word, h in zip(own, found.hashes[a:b].tolist(), strict=True):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    a, b = (next(iter(words.hashed_words(pa.array([t]), lower=True))).hashes.tolist() for t in ("ABC É", "abc É"))
    assert a == b


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13])
def test_windows_stay_inside_texts(k):
    rng = np.random.default_rng(k)
    hashes = rng.integers(0, 3, 200).astype(np.uint64)
    offsets = np.array([0, 0, 1, 3, 10, 10, 60, 61, 200, 200])
    got, at = words.windows(hashes, offsets, k)
    want = [i for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b - k + 1)]
    assert at.tolist() == want
    names = {}
    for h, i in zip(got.tolist(), want, strict=True):
        assert names.setdefault(tuple(hashes[i : i + k].tolist()), h) == h
    assert len(set(names.values())) == len(names)
