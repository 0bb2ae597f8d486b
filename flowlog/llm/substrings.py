"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``k`` consecutive words of one document. A reference block indexes all windows whose smallest
inner ``anchor``-gram hashes into it, each with the first document (smallest id) and place that has it;
equal windows share that anchor, so they meet in one block. Consecutive windows with one anchor travel as
one run, and a block parses every run greedily: a factor is copied from one earlier document for as long
as the copy goes on, and where it ends, at a factor's or a run's boundary, the window across the
boundary is looked up by itself. Factors of at least ``k`` words become duplicate spans; spans of several blocks that touch or
overlap merge at the document.

Only windows first seen in a chunk of documents are sent, so a passage that a third of all documents share
reaches its block once per chunk. Windows are compared by 56 bits of hash besides their block.

Defined results: null and empty texts, and texts under ``k`` words, have no window and lose nothing. A null
id counts as larger than all others. Rows with equal ids never remove each other's words. Repeated rows
stay, each judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlog.llm.storage import partitions
from flowlog.llm.words import WORD, Words, hashed_words, mix, windows

WINDOW_WORDS = 13
ANCHOR_WORDS = 5
HASH_BYTES = 7
#: Windows of a chunk: what a task holds before it sends them on, as 8-byte numbers.
CHUNK_WINDOWS = 1 << 21
#: Blocks per shuffle partition; a block is what a task indexes at once.
BLOCKS_PER_PARTITION = 4
_RUN_LIMIT = 255
_LAST = 2**63 - 1
_SPACE_WORD = re.compile(WORD.encode())


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours; the last ``width - 1`` places see fewer."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = np.minimum(out[:-step], out[step:])
        have += step
    return out


class _Chunk:
    """Windows of some documents, sorted into blocks."""

    def __init__(self, k: int, anchor: int, blocks: int, keyed: bool) -> None:
        self.k, self.anchor, self.blocks, self.keyed = k, anchor, blocks, keyed
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, words: Words, docs: np.ndarray, keys: np.ndarray) -> None:
        hashes, at = windows(words.hashes, words.offsets, self.k)
        if not len(at):
            return
        anchors, places = windows(words.hashes, words.offsets, self.anchor)
        dense = np.full(len(words.hashes), 2**64 - 1, np.uint64)
        dense[places] = anchors
        smallest = sliding_min(dense, self.k - self.anchor + 1)[at]
        text = np.searchsorted(words.offsets, at, side="right") - 1
        start = at - words.offsets[text]
        self.parts.append((hashes, smallest, docs[text], keys[text], start))
        self.size += len(at)

    def rows(self) -> Iterator[dict]:
        """Runs by block, and the spans that a smaller document of the same chunk already decides."""
        if not self.parts:
            return
        hashes, smallest, docs, keys, start = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = np.argsort(hashes, kind="stable")
        edge = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
        least = np.empty(len(hashes), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(docs[order], edge), np.diff(edge, append=len(hashes)))
        repeated = docs > least
        del order, least
        yield from self._spans(repeated, keys, start)
        kept = np.flatnonzero(~repeated)
        hashes, smallest, docs, keys, start = (x[kept] for x in (hashes, smallest, docs, keys, start))
        # a run: consecutive windows of a document with one anchor, at most _RUN_LIMIT
        new = np.ones(len(hashes), bool)
        new[1:] = (
            (smallest[1:] != smallest[:-1])
            | (start[1:] != start[:-1] + 1)
            | (keys[1:] != keys[:-1])
            | (docs[1:] != docs[:-1])
        )
        first = np.flatnonzero(new)
        lengths = np.diff(first, append=len(hashes))
        if (lengths > _RUN_LIMIT).any():
            pieces = -(-lengths // _RUN_LIMIT)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = np.repeat(first, pieces) + nth * _RUN_LIMIT
            lengths = np.minimum(np.repeat(lengths, pieces) - nth * _RUN_LIMIT, _RUN_LIMIT)
        block = (mix(smallest[first]) % np.uint64(self.blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        first, lengths, block = first[order], lengths[order], block[order]
        ends = np.cumsum(lengths)
        index = np.arange(len(hashes)) + np.repeat(first - (ends - lengths), lengths)
        narrow = hashes[index].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
        docs, keys, start = docs[first], keys[first], start[first]
        bounds = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            base = int(docs[a:b].min())
            yield {
                "block": int(block[a]),
                "runs": b - a,
                "base": base,
                "docs": _narrow((docs[a:b].view(np.uint64) - np.uint64(base % 2**64))),
                "keys": keys[a:b].tobytes() if self.keyed else None,
                "starts": _narrow(start[a:b].astype(np.uint64)),
                "lengths": lengths[a:b].astype(np.uint8).tobytes(),
                "hashes": narrow[ends[a] - lengths[a] : ends[b - 1]].tobytes(),
            }

    def _spans(self, repeated: np.ndarray, keys: np.ndarray, start: np.ndarray) -> Iterator[dict]:
        at = np.flatnonzero(repeated)
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (start[at[1:]] != start[at[1:] - 1] + 1) | (keys[at[1:]] != keys[at[1:] - 1])
        first = np.flatnonzero(new)
        n = np.diff(first, append=len(at)) + self.k - 1
        yield {
            "block": -1,
            "runs": len(first),
            "keys": keys[at[first]].tobytes(),
            "starts": start[at[first]].astype(np.uint64).tobytes(),
            "lengths": n.astype(np.uint64).tobytes(),
        }


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.uint64)


_RUNS = pa.schema(
    [
        ("block", pa.int64()),
        ("runs", pa.int64()),
        ("base", pa.int64()),
        ("docs", pa.binary()),
        ("keys", pa.binary()),
        ("starts", pa.binary()),
        ("lengths", pa.binary()),
        ("hashes", pa.binary()),
    ]
)
_RUNS_DDL = "block long, runs long, base long, docs binary, keys binary, starts binary, lengths binary, hashes binary"
_FACTORS_DDL = "key long, first long, n long, source long, source_first long"


def _runs(k: int, anchor: int, blocks: int, keyed: bool):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(k, anchor, blocks, keyed)
        for batch in batches:
            docs = batch["doc"].to_numpy()
            keys = batch["key"].to_numpy()
            for words in hashed_words(batch["text"]):
                last = words.first + len(words)
                chunk.add(words, docs[words.first : last], keys[words.first : last])
                if chunk.size >= CHUNK_WINDOWS:
                    yield from _batches(chunk.rows())
        yield from _batches(chunk.rows())

    return send


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    for row in rows:
        some.append(row)
        if len(some) == 64:
            yield pa.RecordBatch.from_pylist(some, schema=_RUNS)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=_RUNS)


def _local_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(row[c], np.int64)) for c in ("keys", "starts", "lengths")],
                ["key", "first", "n"],
            )


def parse_block(
    hashes: np.ndarray, runs: np.ndarray, docs: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors of a block's runs against the windows of earlier documents in the block.

    One entry per window: its hash, run, document and first word, runs in order. Gives for each factor its
    first window, number of windows, the document it copies, the first word there, and its run.
    """
    # The index: for each window the smallest document that has it, and the first place there.
    order = np.lexsort((starts, docs, hashes))
    edge = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
    head = order[np.maximum.accumulate(np.where(edge, np.arange(len(order)), 0))]
    source = np.empty(len(hashes), np.int64)
    place = np.empty(len(hashes), np.int64)
    source[order], place[order] = docs[head], starts[head]
    copied = source < docs
    # A factor goes on while the next window is copied from the next word of the same document.
    goes_on = np.zeros(len(hashes), bool)
    goes_on[1:] = (
        copied[1:]
        & copied[:-1]
        & (runs[1:] == runs[:-1])
        & (source[1:] == source[:-1])
        & (place[1:] == place[:-1] + 1)
    )
    first = np.flatnonzero(copied & ~goes_on)
    stop = np.flatnonzero(copied & ~np.append(goes_on[1:], False)) + 1
    return first, stop - first, source[first], place[first], runs[first]


def _factors(k: int, spans_only: bool):
    def parse(table: pa.Table) -> pa.Table:
        docs, keys, starts, lengths, hashes = [], [], [], [], []
        for row in table.to_pylist():
            n = row["runs"]
            own = (_wide(row["docs"], n) + np.uint64(row["base"] % 2**64)).view(np.int64)
            docs.append(own)
            keys.append(np.frombuffer(row["keys"], np.int64) if row["keys"] is not None else own)
            starts.append(_wide(row["starts"], n).view(np.int64))
            lengths.append(np.frombuffer(row["lengths"], np.uint8).astype(np.int64))
            wide = np.zeros((len(row["hashes"]) // HASH_BYTES, 8), np.uint8)
            wide[:, :HASH_BYTES] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, HASH_BYTES)
            hashes.append(wide.view(np.uint64)[:, 0])
        doc, key, start, length = (np.concatenate(x) for x in (docs, keys, starts, lengths))
        run = np.repeat(np.arange(len(length)), length)
        word = np.arange(len(run)) - np.repeat(np.cumsum(length) - length, length) + start[run]
        first, n, source, place, of = parse_block(np.concatenate(hashes), run, doc[run], word)
        words = n + k - 1
        begin = word[first]
        if spans_only and len(first):
            # the windows across the boundary of two factors of a run are in the index themselves
            new = np.ones(len(first), bool)
            new[1:] = (of[1:] != of[:-1]) | (begin[1:] > begin[:-1] + n[:-1])
            head = np.flatnonzero(new)
            words = np.add.reduceat(n, head) + k - 1
            begin, source, place, of = begin[head], source[head], place[head], of[head]
        return pa.table({"key": key[of], "first": begin, "n": words, "source": source, "source_first": place})

    return parse


def _keyed(docs: DataFrame, doc_id: str, text: str, unique: bool) -> DataFrame:
    """Id for the order of documents, key of the row, text; the key tells rows with one id apart."""
    number, words = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(number, F.lit(_LAST)).alias("doc"),
        (F.coalesce(number, F.lit(_LAST)) if unique else F.xxhash64(number, words)).alias("key"),
        words.alias("text"),
    )


def _is_unique(docs: DataFrame, doc_id: str) -> bool:
    repeated = docs.groupBy(F.col(f"`{doc_id}`").alias("id")).count().where("count > 1 OR id IS NULL")
    return repeated.isEmpty()


def factors(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = WINDOW_WORDS,
    anchor: int = ANCHOR_WORDS,
    spans_only: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Factors of at least ``k`` words that a document copies from one with a smaller id.

    Columns: key of the row, first word and number of words, source document and its first word.
    Factors decided inside one chunk, and all with ``spans_only``, come merged to spans; the former
    have no source. ``unique`` says that ids are neither null nor repeated; they are the keys then.
    """
    if not 0 < anchor <= k:
        raise ValueError("an anchor has between one and k words")
    spark = docs.sparkSession
    blocks = BLOCKS_PER_PARTITION * partitions(spark)
    sent = _keyed(docs, doc_id, text, unique).select("doc", "key", "text")
    sent = sent.mapInArrow(_runs(k, anchor, blocks, not unique), _RUNS_DDL)
    # Both kinds of rows come from one pass: local spans travel as blocks of their own, spread by content.
    dealt = sent.withColumn("lot", F.when(F.col("block") < 0, -1 - F.pmod(F.hash("keys"), F.lit(blocks))).otherwise(F.col("block")))

    def either(table: pa.Table) -> pa.Table:
        if table["block"][0].as_py() >= 0:
            return parse(table)
        parts = [
            [np.frombuffer(row[c], np.int64) for c in ("keys", "starts", "lengths")] for row in table.to_pylist()
        ]
        key, first, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        none = pa.nulls(len(key), pa.int64())
        return pa.table({"key": key, "first": first, "n": n, "source": none, "source_first": none})

    parse = _factors(k, spans_only)
    return dealt.groupBy("lot").applyInArrow(either, _FACTORS_DDL)


def with_spans(docs: DataFrame, kept: list[Column], doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Columns ``kept`` of each row, over ``row`` and ``text``, beside its duplicate spans ``(first, n)`` of words,
    null if it has none. Nothing else of the row is dealt out for it."""
    unique = _is_unique(docs, doc_id)
    found = factors(docs, doc_id, text, spans_only=True, unique=unique, **options)
    spans = found.groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("spans"))
    return _keyed(docs, doc_id, text, unique).select("key", *kept).join(spans, "key", "left").drop("key")


def _mask(n: int, spans: list[dict]) -> np.ndarray:
    """Which of ``n`` words no span covers."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, [s["first"] for s in spans], 1)
    np.add.at(steps, [s["first"] + s["n"] for s in spans], -1)
    return np.cumsum(steps[:-1]) == 0


def _digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True):
        words = (text or b"").split()
        kept = words if not own else [words[i] for i in np.flatnonzero(_mask(len(words), own))]
        out.append(
            {
                "n_words": len(words),
                "n_removed": len(words) - len(kept),
                "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
            }
        )
    return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


def cut(text: bytes, spans: list[dict]) -> bytes:
    """``text`` without the words of the spans and the space after each; the rest keeps its bytes."""
    places = [m.span() for m in _SPACE_WORD.finditer(text)]
    kept = _mask(len(places), spans)
    bounds = [0, *(a for a, _ in places[1:]), len(text)]
    pieces = [text[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(kept)]
    return b"".join(pieces)


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array(
        [
            text if text is None or not own else cut(text, own)
            for text, own in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True)
        ],
        pa.binary(),
    ).cast(pa.string())


def duplicate_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: words, removed words, and the SHA-256 of the kept words joined by spaces."""
    digest = F.arrow_udf(_digest, "struct<n_words: long, n_removed: long, kept_sha256: string>")
    kept = [F.col("row")[doc_id].alias("doc_id"), F.col("text")]
    judged = with_spans(docs, kept, doc_id, text, **options)
    return judged.select("doc_id", digest("text", "spans").alias("x")).select("doc_id", "x.*")


def remove_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with their duplicate words cut out; one that loses all its words goes."""
    judged = with_spans(docs, [F.col("row")], doc_id, text, **options)
    # So that the planner does not ask it twice, once for the filter on its result.
    cut_once = F.arrow_udf(_cut, "string").asNondeterministic()
    judged = judged.withColumn("cut", cut_once(F.col("row")[text].cast("string"), "spans"))
    left = judged.where(F.col("spans").isNull() | F.col("cut").rlike(WORD))
    return left.select(*[(F.col("cut") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
