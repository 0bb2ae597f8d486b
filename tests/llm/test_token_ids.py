"""Token-id files against the library's ids, and exact round trips of the coder."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from flowlog.llm import mixcoder, tokenfile, vocab
from flowlog.llm.storage import new_path

ODD = [
    None, "", " ", " a", "a ", "\n", "\na", "a\n", "a\n b", "a\x00b c", "\x00 a", "x  y", "x \n\n y", "it's  'so\t\tend", "a\x1c b", "!\x1c!",
    "　a", "a \n\n b", "é ß 好 好", "<|endoftext|> a <|endoftext|>", "a\r\nb\x85c", "w" * 5000, "…—“x”", "\U0001f600 ​ z",
]


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocab.place(vocab.BYTE_BPE))
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij'.,") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_pieces_have_the_ids_of_the_whole():
    rng = random.Random(3)
    mixed = ["".join(rng.choice("ab'!. \n\t\x1c 　é1") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    texts = [t or "" for t in ODD] + mixed
    assert [np.frombuffer(x, "<u4").tolist() for x in vocab.Encoder().encode(texts)] == plain_ids(texts)


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(vocab, "REMEMBERED", 50)
    encoder, rng = vocab.Encoder(), random.Random(4)
    for _ in range(5):
        texts = [prose(rng, 40) for _ in range(6)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == plain_ids(texts)
        assert len(encoder.known) <= 50


def test_the_library_gets_many_new_pieces_as_one_text(monkeypatch):
    encoder, rng, given = vocab.Encoder(), random.Random(5), []
    ask = encoder.ask
    monkeypatch.setattr(encoder, "ask", lambda texts: (given.extend(texts), ask(texts))[1])
    texts = [prose(rng, 500).replace(" abc", "\nabc") + end for end in ("", " ", "\n", "é", "\t x", "\0")]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts[:4])] == plain_ids(texts[:4])
    assert len(given) < 20 < len(encoder.known)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == plain_ids(texts)


def blocks_of(rng):
    yield np.zeros(1, np.uint32)
    yield np.full(4096, 7, np.uint32)
    yield rng.integers(0, 2**32, 5000, dtype=np.uint32)
    yield np.arange(4096, dtype=np.uint32)[::-1].copy()
    yield np.tile(rng.integers(0, 50257, 37), 400).astype(np.uint32)
    yield (rng.zipf(1.2, 30_000) % 50257).astype(np.uint32)
    yield np.array([0, 2**32 - 1] * 3000, np.uint32)


def test_blocks_round_trip(monkeypatch):
    monkeypatch.setattr(mixcoder, "LANES", 3)
    for ids in blocks_of(np.random.default_rng(1)):
        packed = tokenfile.pack_file(1, 2, 3, [(5, ids.astype("<u4").tobytes())])
        ((head, index, found),) = tokenfile.unpack_files([packed])
        assert head == (1, 2, 1, -(-len(ids) // 4096), 3) and (found == ids).all() and index["ids"].tolist() == [len(ids)]


def test_contexts_are_learned():
    ids = np.tile(np.random.default_rng(2).integers(0, 50257, 100), 41)[:4096].astype("<u4")
    assert sum(map(len, tokenfile.pack_blocks(ids))) < len(ids) // 4  # two bits an id


def test_damage_is_noticed():
    packed = tokenfile.pack_file(0, 0, 0, [(None, np.arange(100, dtype="<u4").tobytes())])
    for at in range(8, len(packed), 3):
        bad = bytearray(packed)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            list(tokenfile.unpack_files([bytes(bad)]))
    with pytest.raises(ValueError):
        list(tokenfile.unpack_files([packed[:-1]]))


SCHEMA = "doc_id long, text string, tie int, content string, part int, value string, ids int"


def expected(rows):
    found, start = [], 0
    ordered = sorted(zip(rows, plain_ids([t for _, t in rows]), strict=True), key=lambda r: (r[0][0] is not None, r[0][0] or 0))
    for (doc_id, _), ids in ordered:
        raw = np.array([*ids, 2], "<u4").tobytes()
        found.append((doc_id, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    return found


def test_written_files_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "FILE_IDS", 3000)
    rng = random.Random(7)
    rows = [(100 - i, t) for i, t in enumerate(ODD)] + [(1000 + i, prose(rng, rng.randint(1, 300))) for i in range(80)]
    rows += [(-5, prose(rng, 9000)), (None, "one"), (7, None)]
    frame = spark.createDataFrame([(i, t, 1, "c", 2, "v", 3) for i, t in rows], SCHEMA).repartition(5)
    path = new_path(spark, "ids")
    got = tokenfile.written(frame, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)
    back = tokenfile.read_ids(spark, path).collect()
    assert len({(r.part, r.number) for r in back}) > 4
    by_id = dict(zip([i for i, _ in rows], plain_ids([t for _, t in rows]), strict=True))
    assert all(np.frombuffer(r.ids, "<u4").tolist() == by_id[r.doc_id] + [2] for r in back)


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, None), (None, None), (0, "x")]
    got = tokenfile.written(spark.createDataFrame([(i, t, 1, "c", 2, "v", 3) for i, t in rows], SCHEMA)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 0, 1, 1, 1]
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert sorted(r.ids_crc32 for r in got) == sorted(r[3] for r in expected(rows))


def test_empty_table(spark):
    assert tokenfile.written(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_a_whole_table(spark):
    from flowlog.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    got = queries.op11_token_ids(spark, sf_dir).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)
