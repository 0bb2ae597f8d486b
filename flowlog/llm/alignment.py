"""Alignment of two tokenizers' tokens over the same text, and how usual each linked pair of ids is.

Each text is tokenised whole by A (byte-level BPE, of a blank and the text) and by B (BPE with byte fallback, which adds
the blank). Ends of tokens are offsets in bytes. Where an A token and a B token both end and the next token of either
begins with a blank, the document is cut: between two such anchors lies a window, in practice a word, whose alignment depends on
its ids alone. Inside a window, shared ends cut the tokens into groups, and an A token is linked with every B token whose byte
range overlaps its own.

Windows repeat. Neither vocabulary merges across a single blank or line end between words (for B that is looked up in its pieces,
for A see ``vocab``), so both always end before one: a text cut there has the same tokens as the whole, and a worker asks for and
aligns each such word once and remembers the first ``REMEMBERED`` by their text. Texts with other white space, or with a
word whose tokens are not its bytes, are tokenised whole and their windows remembered by their tuples of ids.

The documents that hold a linked pair of ids are counted over all documents. The pairs' counts then go back to the documents in lots
of at most ``LOT_PAIRS`` pairs, each broadcast and its sums written before the next, so memory does not grow with the pairs.

Defined results: texts that are null or empty, or whose tokens do not join to a blank and the text, have no tokens: zeros and an
empty digest. Strings of special tokens are plain text. Repeated rows are documents of their own and keep their id, null
included. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlog.llm import vocab
from flowlog.llm.pieces import byte_of
from flowlog.llm.storage import stored

#: BPE with byte fallback, 32,000 ids.
PIECE_BPE = "piece_bpe_32k.model"
REMEMBERED = 450_000
#: Pairs of ids whose counts are broadcast at a time.
LOT_PAIRS = 1_000_000
_LOT_CHARS = 1 << 20

#: Groups, links, groups as text, and the linked pairs (A id in the high 32 bits) as bytes of 64-bit integers.
Window = tuple[int, int, str, bytes]
#: A tokens and B tokens of a word, and what its alignment has.
Word = tuple[int, int, int, int, str, bytes]


def align(a: list[int], b: list[int], length_a: list[int], length_b: list[int]) -> Window:
    """The alignment of tokens that cover the same bytes."""
    if len(a) == len(b) and [length_a[x] for x in a] == [length_b[y] for y in b]:  # each is a group of its own
        both = list(zip(a, b, strict=True))
        return len(a), len(a), ";".join([f"{x}|{y}" for x, y in both]), _pairs([x << 32 | y for x, y in both])
    groups, pairs = [], []
    i = j = first_a = first_b = 0
    end_a, end_b = length_a[a[0]], length_b[b[0]]
    while True:
        pairs.append(a[i] << 32 | b[j])
        if end_a == end_b:
            groups.append(f"{','.join(map(str, a[first_a : i + 1]))}|{','.join(map(str, b[first_b : j + 1]))}")
            i, j = i + 1, j + 1
            first_a, first_b = i, j
            if i == len(a):
                return len(groups), len(pairs), ";".join(groups), _pairs(pairs)
            end_a += length_a[a[i]]
            end_b += length_b[b[j]]
        elif end_a < end_b:
            i += 1
            end_a += length_a[a[i]]
        else:
            j += 1
            end_b += length_b[b[j]]


def _pairs(pairs: list[int]) -> bytes:
    return struct.pack(f"={len(pairs)}q", *pairs)


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the windows met so far."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str) -> None:
        import sentencepiece

        self.a = vocab.encoder(vocabulary_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocab.place(vocabulary_b))
        code = byte_of()
        ids = self.a.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            known = all(c in code for c in token)
            self.bytes_a[i] = bytes(code[c] for c in token) if known else token.encode()
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.blank_a, self.blank_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.sizes_a, self.sizes_b = self.length_a.tolist(), self.length_b.tolist()
        self.windows: dict[tuple[bytes, bytes], Window] = {}
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        #: Whether no piece of B has a blank after something else, or a line end.
        self.by_words = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.words: dict[str, Word | None] = {}

    def by_word(self, texts: list[str]) -> Iterator[list[Word] | None]:
        """The words of each text in order; None for one that has to be tokenised whole."""
        cut = [t.replace("\n", " \n").split(" ") if self.by_words and t and vocab.plain(" " + t) else None for t in texts]
        known = self.words
        missing = list(set().union(*(set(c).difference(known) for c in cut if c)))
        known |= zip(missing, self._new_words(missing), strict=True)
        for words in cut:
            found = list(map(known.__getitem__, words)) if words else None
            yield None if found and None in found else found
        for _ in range(len(known) - REMEMBERED):  # the last to come are the rarest
            known.popitem()

    def _new_words(self, words: list[str]) -> Iterator[Word | None]:
        """A blank and each word, or a word that begins with a line end, aligned; None where tokens are not the bytes."""
        whole = [w if w.startswith("\n") else " " + w for w in words]
        found = self.a.tokenizer.encode_batch_fast(whole, add_special_tokens=False)
        for text, tokens, b in zip(whole, found, self.b.encode(words, num_threads=1), strict=True):
            a, raw = tokens.ids, text.encode()
            if raw[:1] == b"\n" and b and self.bytes_b[b[0]] == b" ":
                del b[0]  # the blank that B adds
            if b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b)):
                yield len(a), len(b), *align(a, b, self.sizes_a, self.sizes_b)
            else:
                yield None

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids by A and by B, both empty where their bytes are not a blank and the text."""
        none = np.empty(0, np.uint32)
        for text, raw, b in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts, num_threads=1), strict=True):
            a = np.frombuffer(raw, "<u4")
            whole = b" " + text.encode()
            same = text and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole
            if same and b"".join(map(self.bytes_b.__getitem__, b)) == whole:
                yield a, np.array(b, np.uint32)
            else:
                yield none, none

    def cut(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        """Where windows end, in A tokens and in B tokens."""
        ends_a, ends_b = self.length_a[a].cumsum(), self.length_b[b].cumsum()
        next_a, next_b = (np.append(blank[1:], True) for blank in (self.blank_a[a], self.blank_b[b]))
        ready_a, ready_b = np.flatnonzero(next_a), np.flatnonzero(next_b)
        # Anchors are ends that both have, verified by their byte offsets.
        _, at_a, at_b = np.intersect1d(ends_a[ready_a], ends_b[ready_b], assume_unique=True, return_indices=True)
        return (ready_a[at_a] + 1).tolist(), (ready_b[at_b] + 1).tolist()

    def aligned(self, a: np.ndarray, b: np.ndarray) -> list[Window]:
        """The document's windows in order."""
        cut_a, cut_b = self.cut(a, b)
        raw_a, raw_b = a.tobytes(), b.tobytes()
        ends = list(zip([0, *cut_a], cut_a, [0, *cut_b], cut_b, strict=False))
        keys = [(raw_a[4 * i : 4 * j], raw_b[4 * k : 4 * m]) for i, j, k, m in ends]
        found = list(map(self.windows.get, keys))
        if None in found:
            ids_a, ids_b, lengths = a.tolist(), b.tolist(), (self.sizes_a, self.sizes_b)
            for n, window in enumerate(found):
                if window is None:
                    i, j, k, m = ends[n]
                    found[n] = self.windows.get(keys[n]) or align(ids_a[i:j], ids_b[k:m], *lengths)
                    if len(self.windows) < REMEMBERED:
                        self.windows[keys[n]] = found[n]
        return found

    def rows(self, texts: list[str]) -> Iterator[list[Word]]:
        """The aligned words or windows of each text in order, none where its tokens are not a blank and the text."""
        for text, words in zip(texts, self.by_word(texts), strict=True):
            if words is None:
                (a, b), = self.tokens([text])
                windows = self.aligned(a, b) if len(a) else []
                # The tokens of the text stand in its first window.
                words = [(*((len(a), len(b)) if not n else (0, 0)), *w) for n, w in enumerate(windows)]
            yield words


@functools.cache
def aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    """One aligner a worker, so that tasks after one another share what it remembers."""
    return Aligner(vocabulary_a, vocabulary_b)


_DDL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, n array<int>"
)


def _aligning(vocabulary_a: str, vocabulary_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner(vocabulary_a, vocabulary_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch["doc_id"]
            for first, texts in vocab.lots([t or "" for t in batch["text"].to_pylist()], _LOT_CHARS):
                rows, keys, times, bounds = [], [], [], [0]
                for words in worker.rows(texts):
                    n_a, n_b, groups, links, names, pairs = zip(*words, strict=True) if words else ((),) * 6
                    held, often = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
                    digest = hashlib.sha256(";".join(names).encode()).hexdigest() if words else ""
                    rows.append((sum(n_a), sum(n_b), sum(groups), sum(links), digest))
                    keys.append(held)
                    times.append(often.astype(np.int32))
                    bounds.append(bounds[-1] + len(held))
                key, ends = np.concatenate(keys), pa.array(bounds, pa.int32())
                lists = [(key >> 32).astype(np.int32), key.astype(np.int32), np.concatenate(times)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(rows))),
                        doc_ids.slice(first, len(rows)),
                        *[pa.array(column) for column in zip(*rows, strict=True)],
                        *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in lists],
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"],
                )
                row += len(rows)

    return run


def align_documents(
    docs: DataFrame, vocabulary_a: str = vocab.BYTE_BPE, vocabulary_b: str = PIECE_BPE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per document: its counts, the digest of its groups, and the distinct pairs it links: A id, B id, links."""
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return own.mapInArrow(_aligning(vocabulary_a, vocabulary_b), _DDL)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, documents, best``: the documents that hold a pair linked, and whether no pair of its A id is in more."""
    counted = stored(_links(aligned).groupBy("pair").agg(F.count("*").alias("documents")), "counted")
    a = F.shiftright("pair", 32).alias("a")
    most = counted.groupBy(a).agg(F.max("documents").alias("most"))
    rated = counted.select("*", a).join(most, "a")
    return rated.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _links(aligned: DataFrame) -> DataFrame:
    links = aligned.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("x"))
    pair = F.shiftleft(F.col("x.a").cast("long"), 32).bitwiseOR(F.col("x.b").cast("long"))
    return links.select("row", pair.alias("pair"), F.col("x.n").alias("n"))


def report(docs: DataFrame, lot_pairs: int = LOT_PAIRS, **options) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    aligned = stored(align_documents(docs, **options), "aligned")
    pairs = stored(pair_counts(aligned), "pairs")
    lots = max(1, -(-pairs.count() // lot_pairs))
    sums = None
    for lot in range(lots):
        part = F.broadcast(pairs.where(F.pmod(F.xxhash64("pair"), F.lit(lots)) == lot))
        met = _links(aligned).join(part, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("documents")).alias("count_sum"),
        )
        met = stored(met, "sums") if lots > 1 else met
        sums = met if sums is None else sums.unionByName(met)
    if lots > 1:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = aligned.drop("a", "b", "n").join(sums, "row", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")], "groups_sha256",
    )
