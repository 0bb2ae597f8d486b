"""The alignment of two tokenizers against a plain version over byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from flowlog.llm import alignment, vocab

SCHEMA = "doc_id long, text string, row int, a string, b string, n int, pair string, best int, n_best string"

ODD = [
    None, "", " ", "a", " a", "  a  b ", "\n\nline\n", "tab\there", "é好\U0001f600", "<|endoftext|> </s> <unk> <0x0A>", "▁ ▁a", "a\x00b", "x" * 700,
    "No spaces,just;marks!!!", "ﬁ ½ Ａ", "a\r\nb", " nb", "the the the cat", "the cat", "the", "ａｂｃ １２３", "don't can't",
]


def tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocab.place(vocab.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocab.place(alignment.PIECE_BPE))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    for t in text:
        if not t:
            yield [], [], [], []
            continue
        ids = a.encode(" " + t, add_special_tokens=False).ids
        pieces = [bytes(of[c] for c in a.id_to_token(i)) for i in ids]
        found = b.encode(t)
        names = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in found]
        whole = b" " + t.encode()
        yield (ids, pieces, found, names) if b"".join(pieces) == whole == b"".join(names) else ([], [], [], [])


def ranges(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(rows):
    docs = []
    for (doc_id, _), (ids, pieces, found, names) in zip(rows, tokens([t for _, t in rows]), strict=True):
        ra, rb = ranges(pieces), ranges(names)
        links = [(x, y) for x, (s, e) in zip(ids, ra) for y, (s2, e2) in zip(found, rb) if s < e2 and s2 < e]
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, low = [], 0
        for end in ends:
            groups.append(tuple(",".join(str(i) for i, (s, e) in zip(t, r) if low <= s and e <= end) for t, r in ((ids, ra), (found, rb))))
            low = end
        docs.append((doc_id, len(ids), len(found), groups, links))
    held = Counter(pair for *_, links in docs for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join("|".join(g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        best = sum(held[pair] == most[pair[0]] for pair in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(held[pair] for pair in links), digest))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", 2, "p", 3, "x") for r in rows], SCHEMA).repartition(4)


def table():
    rng = random.Random(2)
    rows = list(enumerate(ODD)) + [(None, "the cat"), (None, None), (5, "the cat"), (5, "the cat")]
    words = ["the", "Cat", "ünï", "好", "42", "it's", "\n", "  ", "…", "antidisestablishment", "\t", "e-mail", "x" * 40]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(40)]
    return [*rows, (900, "long words " * 150)]


@pytest.mark.parametrize("remembered, lot_pairs", [(0, 10**6), (7, 20), (10**5, 60)])
def test_equals_the_plain_version(spark, monkeypatch, remembered, lot_pairs):
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    rows = table()
    got = alignment.report(frame(spark, rows), lot_pairs=lot_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_windows_are_words_and_are_remembered():
    worker = alignment.Aligner(vocab.BYTE_BPE, alignment.PIECE_BPE)
    (a, b), = worker.tokens(["red apples, red apples"])
    windows = worker.aligned(a, b)
    assert len(windows) > 2 and len(worker.windows) < len(windows)
    assert sum(w[0] for w in windows) == len(";".join(w[2] for w in windows).split(";"))


def test_words_go_to_the_libraries_once():
    worker = alignment.Aligner(vocab.BYTE_BPE, alignment.PIECE_BPE)
    library, asked = worker.b, []

    class Asked:
        def encode(self, texts, **options):
            asked.extend(texts)
            return library.encode(texts, **options)

        def __getattr__(self, name):
            return getattr(library, name)

    worker.b = Asked()
    plain_text, odd = "red apples\nred apples", "two  blanks"
    first = [list(worker.rows([t]))[0] for t in (plain_text, odd)]
    assert sorted(asked) == ["\nred", "apples", "red", odd]
    asked.clear()
    assert [list(worker.rows([t]))[0] for t in (plain_text, odd)] == first and asked == [odd]


def test_empty_table(spark):
    assert alignment.report(frame(spark, [])).collect() == []


def test_query_on_a_whole_table(spark):
    from flowlog.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect() if len(r.text or "") < 4000]
    short = [r[0] for r in rows]
    docs = queries.table(spark, sf_dir, "documents").where(queries.F.col("doc_id").isin(short))
    assert sorted(map(tuple, alignment.report(docs).collect()), key=str) == plain(rows)
