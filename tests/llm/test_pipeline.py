"""The pipeline against the plain versions of its stages, and the registered queries on whole small tables."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from test_operators import SCHEMA, frame, near_rows, plain_quality, prose  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

DATA = "/root/testdata/sf0.001"
low = lambda t: brute.words((t or "").translate(brute.LOWER))


def plain_stages(rows, items):
    """Ids, and words of the texts, that each stage but the last keeps of rows with unique ids."""
    kept = [r for r in rows if plain_quality(*r)[-1]]
    yield kept
    kept = [r for r, c in zip(kept, brute.components(kept, percent=80), strict=True) if c[3]]
    yield kept
    first = {}
    for i, t in sorted(kept):
        w = brute.words(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    cut = []
    for i, t in kept:
        w = brute.words(t)
        gone = {p for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for p in range(j, j + 13)}
        left = [x for p, x in enumerate(w) if p not in gone]
        if left:
            cut.append((i, " ".join(left)))
    kept = cut
    yield kept
    wanted = [low(t) for _, t in items if low(t)]
    clean = []
    for i, t in kept:
        own = low(t)
        have = set(own)
        near = [x for x in wanted if sum(y in have for y in x) >= 0.75 * len(x)]
        if not any(brute.edit_to_stretch(x, own) <= len(x) // 5 for x in near):
            clean.append((i, t))
    yield clean


def kept_words(df):
    return sorted((r.doc_id, " ".join(brute.words(r.text))) for r in df.collect())


def compare(spark, docs, rows, items, sf_dir):
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], plain_stages(rows, items), strict=True):
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns, name
        assert kept_words(docs) == sorted((i, " ".join(brute.words(t))) for i, t in want), name
    return docs


def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = compare(spark, docs, rows, items, DATA)
    mixed = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean.collect()}
    assert all(1 <= r.copies <= 3 for r in mixed)
    assert clean.where("n_chars <> length(text)").count() == 0


def test_stages_on_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    rows = [r for n, r in enumerate(near_rows(3)) if r[0] not in (None, 5)]
    items = [(i, prose(rng, 25, 2000)) for i in range(10)]
    rows += [(9000 + i, prose(rng, 30) + "\n" + t + " " + prose(rng, 30)) for i, t in items]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    compare(spark, frame(spark, rows), rows, items, str(tmp_path))


def test_near_duplicates_from_four_fifths(spark, tmp_path):
    """Pairs with a similarity from 0.80 up to 0.85 are near duplicates for the stage, those below 0.80 are not."""
    rng = random.Random(4)
    rows, lost = [], set()
    for i in range(60):
        own = prose(rng, 104, 5000).split()  # 100 shingles
        n = rng.choice((4, 6, 9, 11, 12, 20))  # shingles that only one of the two has
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[: 104 - n] + [f"x{j}" for j in range(n)]))]
        if 100 * (100 - n) >= 80 * (100 + n):
            lost.add(2 * i + 1)
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows), str(tmp_path))
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows} - lost
    assert lost == {r[0] for r in brute.components(rows, percent=80) if not r[3]}
    assert lost > {r[0] for r in brute.components(rows) if not r[3]}


def test_stages_take_empty_and_repeated_rows(spark, tmp_path):
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    text = prose(random.Random(1), 90)
    docs = frame(spark, [(1, text), (1, text), (2, text + " more"), (None, text), (None, None), (3, "")])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
    assert [r.doc_id for r in docs.collect()] == [1]


def test_registered_with_the_library():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_mix_sources", "op5_warc_index", "op8_url_filters", "op9_preference_pairs"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = entry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, result.fetchall()))


def test_queries_equal_plain_versions(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    for name, plain in (("op3_substring_dedup", brute.duplicate_words), ("op10_minhash_neardup", brute.components)):
        assert sorted(map(tuple, entry.queries()[name](spark, DATA).collect())) == sorted(plain(docs))
