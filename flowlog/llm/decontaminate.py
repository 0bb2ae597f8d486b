"""Benchmark passages in documents, under word edits.

An item is found in a document if some stretch of it has an edit distance of at most a fifth of the item's
words (A-Z read as a-z). Candidates come from the CGK random walk, which maps edit distance to Hamming distance: step
``t`` writes the word it stands on and moves on if bit ``t`` of that word's hash is set, so two walks over
texts that differ in one word soon run in step again. Bit-sampling LSH keys a window by the words written at a
few sampled steps, at which the walk is still inside the window for sure. Windows are as long as two thirds of the item or somewhat
less, by size class; all windows of an item are indexed, and those of a document that begin at every word, every fourth or every
eighth are looked up. Independent walks are repeated until ``TARGET_RECALL`` is met for passages with as many edits as
are allowed; every candidate is then verified by exact edit distance. Items under ``WALKED_WORDS`` words are too short
for sampling: one word more of edits than allowed would be needed to spoil each of ``n // 5 + 1`` parts of an item, so
their parts are looked up as they are, and none is missed.

The index of the benchmark is broadcast in blocks of at most about ``BLOCK_WORDS`` words, each over all documents; with
more than one, each pass is written before the next block is indexed, and its index let go.

Defined results: null or empty texts, and items without words, match nothing. Items of one to four words are found
where they stand verbatim. Items and rows that repeat are each reported; rows keep null ids. An empty table on either
side gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlog.llm.storage import stored
from flowlog.llm.words import WORD, Words, hashed_words, mix, stream, windows

#: Items of fewer words are looked up by their parts, others by walks.
WALKED_WORDS = 8
#: Chance that a passage with the most edits allowed meets its item, for each item length.
TARGET_RECALL = 0.99
#: Window sizes in words: the stride at which documents are looked up, and the chance that one walk more finds a passage
#: with the most edits allowed, as measured on the item length of the class that is found least.
CLASSES = {4: (1, 0.44), 8: (4, 0.23), 12: (4, 0.37), 16: (4, 0.37), 24: (8, 0.24), 32: (8, 0.35), 48: (8, 0.35)}
#: Words sampled from each walk.
SAMPLES = 4
BLOCK_WORDS = 200_000
#: Windows that walk together.
_TOGETHER = 1 << 13
_FILTER_BITS = 22


def window_words(n: int) -> int:
    """Window size for an item of ``n`` words."""
    return max(size for size in CLASSES if 3 * size <= 2 * n)


def walks(size: int) -> int:
    """Independent walks over windows of ``size`` words."""
    return math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - CLASSES[size][1]))


def parts(n: int) -> list[tuple[int, int]]:
    """First word and number of words of the parts of an item of ``n`` words, one more than its allowed edits."""
    cuts = np.linspace(0, n, n // 5 + 2).astype(int).tolist()
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def sampled_steps(walk: int, size: int) -> list[int]:
    """Steps of a walk over ``size`` words whose words make its key; no step takes it past the window."""
    order = np.argsort(stream(1000 * walk + size, size), kind="stable")
    return sorted(order[:SAMPLES].tolist())


def walk_keys(
    hashes: np.ndarray, starts: np.ndarray, sizes: list[int], walk: int
) -> dict[int, np.ndarray]:
    """Keys of the windows of each size at ``starts``; all sizes share one walk."""
    sampled = {size: sampled_steps(walk, size) for size in sizes}
    steps = max(s[-1] for s in sampled.values()) + 1
    padded = np.append(hashes, np.zeros(steps + 1, np.uint64))
    moves = [mix(padded ^ seed) for seed in stream(77 + walk, (steps - 1) // 64 + 1)]
    factor = stream(78, 1)[0] | np.uint64(1)
    keys = {size: np.full(len(starts), (size << 16) + walk, np.uint64) for size in sizes}
    bit = np.empty(_TOGETHER, np.uint64)
    for low in range(0, len(starts), _TOGETHER):
        at = starts[low : low + _TOGETHER].copy()
        own = bit[: len(at)]
        for t in range(steps):
            reading = [size for size in sizes if t in sampled[size]]
            if reading:
                word = padded[at]
                for size in reading:
                    key = keys[size][low : low + _TOGETHER]
                    key *= factor
                    key += word
            np.take(moves[t >> 6], at, out=own, mode="clip")
            own >>= np.uint64(t & 63)
            own &= np.uint64(1)
            at += own.view(np.int64)
    return {size: mix(key) for size, key in keys.items()}


def edit_end(item: list[int], text: list[int], least: int = 0) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to a stretch of ``text``, and where the first such stretch ends.

    ``least`` is a distance known to be the smallest possible; nothing is looked at past a stretch that has it.
    """
    n = len(item)
    if n <= least:
        return n, 0
    has: dict[int, int] = {}
    for i, word in enumerate(item):
        has[word] = has.get(word, 0) | 1 << i
    all_bits, top = (1 << n) - 1, 1 << n - 1
    up, down, score = all_bits, 0, n
    best, end = n, 0
    for j, word in enumerate(text, 1):
        eq = has.get(word)
        if eq is None:  # a word that the item lacks; up and down have no bit in common
            plus = all_bits ^ up
            if plus & top:
                score += 1
            plus = plus << 1 & all_bits
            up = all_bits & ~(down | plus)
            down &= plus
            continue
        x = eq | down
        d = (((x & up) + up) ^ up) | x
        plus = down | (~(d | up) & all_bits)
        minus = d & up
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & all_bits  # row 0 stays 0: a stretch may begin anywhere
        minus = minus << 1 & all_bits
        up = minus | (~(d | plus) & all_bits)
        down = d & plus
        if score < best:
            best, end = score, j
            if best <= least:
                break
    return best, end


@dataclass
class Item:
    item_id: int | None
    words: list[int]

    def __post_init__(self) -> None:
        self.counts = Counter(self.words)
        self.vocabulary = frozenset(self.words)

    def lacking(self, region: list[int]) -> int:
        """Of the item's words, each as often as it has it, how many the region lacks; at least, where that is many."""
        distinct = len(self.vocabulary.difference(region))
        if distinct > len(self.words) // 5:
            return distinct
        has = Counter(region)
        return sum(n - has[word] for word, n in self.counts.items() if has[word] < n)


def _part_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    return mix(hashes ^ stream(79, size)[-1])


def _own_word(item: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place in ``Index.holds`` of a word of an item."""
    return (mix(hashes + item.astype(np.uint64) * stream(80, 1)[0]) >> np.uint64(64 - _FILTER_BITS)).view(np.int64)


class Index:
    """Keys of all windows of some items for all walks, and of the parts of short items."""

    def __init__(self, items: list[Item]) -> None:
        self.items = items
        keys, owners, offsets = [], [], []
        by_size: dict[int, list[int]] = {}
        by_part: dict[int, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            if len(item.words) >= WALKED_WORDS:
                by_size.setdefault(window_words(len(item.words)), []).append(i)
            else:
                for first, size in parts(len(item.words)):
                    by_part.setdefault(size, []).append((i, first))
        self.sizes, self.part_sizes = sorted(by_size), sorted(by_part)
        for size, own in by_size.items():
            hashes = np.concatenate([np.array(items[i].words, np.uint64) for i in own])
            lengths = np.array([len(items[i].words) for i in own])
            first = np.repeat(np.cumsum(lengths) - lengths, lengths)
            place = np.arange(len(hashes)) - first
            starts = np.flatnonzero(place <= np.repeat(lengths, lengths) - size)
            for walk in range(walks(size)):
                keys.append(walk_keys(hashes, starts, [size], walk)[size])
                owners.append(np.repeat(np.array(own), lengths)[starts])
                offsets.append(place[starts])
        for size, own in by_part.items():
            flat = np.array([items[i].words[first : first + size] for i, first in own], np.uint64).reshape(-1)
            keys.append(_part_keys(windows(flat, np.arange(len(own) + 1) * size, size)[0], size))
            owners.append(np.array([i for i, _ in own]))
            offsets.append(np.array([first for _, first in own]))
        found = [np.concatenate(x) for x in (keys, owners, offsets)] if keys else [np.empty(0, np.uint64)] * 3
        order = np.argsort(found[0], kind="stable")
        self.keys, self.owners, self.offsets = (x[order] for x in found)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.lengths = np.array([len(item.words) for item in items], np.int64)
        self.holds = np.zeros(1 << _FILTER_BITS, bool)
        if items:
            all_words = np.concatenate([np.array(item.words, np.uint64) for item in items])
            self.holds[_own_word(np.repeat(np.arange(len(items)), self.lengths), all_words)] = True

    def _met(self, starts: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rows of first word in the buffer, item and first word in the item, for the windows whose keys are indexed."""
        hit = np.flatnonzero(self.filter[(keys >> np.uint64(64 - _FILTER_BITS)).view(np.int64)])
        low = np.searchsorted(self.keys, keys[hit])
        n = np.searchsorted(self.keys, keys[hit], side="right") - low
        which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(starts[hit], n)
        return np.stack([start, self.owners[which].astype(np.int64), self.offsets[which].astype(np.int64)], 1)

    def candidates(self, words: Words) -> np.ndarray:
        """Rows of text, item and first word of the item in the text, each once."""
        lengths = np.diff(words.offsets)
        place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], lengths)
        left = np.repeat(lengths, lengths) - place
        found = []
        strides = sorted({CLASSES[size][0] for size in self.sizes})
        for stride, wider in zip(strides, [*strides[1:], None], strict=False):
            # windows at multiples of a wider stride are looked up for all sizes at once
            sizes = [s for s in self.sizes if CLASSES[s][0] <= stride]
            at = place % stride == 0 if wider is None else (place % stride == 0) & (place % wider > 0)
            starts = np.flatnonzero(at & (left >= sizes[0]))
            for walk in range(max(map(walks, sizes))):
                for size, keys in walk_keys(words.hashes, starts, [s for s in sizes if walk < walks(s)], walk).items():
                    fits = left[starts] >= size
                    found.append(self._met(starts[fits], keys[fits]))
        for size in self.part_sizes:
            hashes, starts = windows(words.hashes, words.offsets, size)
            found.append(self._met(starts, _part_keys(hashes, size)))
        if not found:
            return np.empty((0, 3), np.int64)
        rows = np.concatenate(found)
        text = np.searchsorted(words.offsets, rows[:, 0], side="right") - 1
        begin = rows[:, 0] - words.offsets[text] - rows[:, 2]
        return np.unique(np.stack([text, rows[:, 1], begin], 1), axis=0)

    def _promising(self, words: Words, rows: np.ndarray) -> np.ndarray:
        """The candidates without most of those whose region lacks more words of the item than edits are allowed."""
        kept = [rows[:0]]
        for at in range(0, len(rows), _TOGETHER):
            text, item, begin = rows[at : at + _TOGETHER].T
            n, first = self.lengths[item], words.offsets[text]
            low = np.maximum(first, first + begin - 2 * (n // 5))
            size = np.minimum(words.offsets[text + 1], first + begin + n + 2 * (n // 5)) - low
            place = np.cumsum(size) - size
            word = words.hashes[np.arange(size.sum()) + np.repeat(low - place, size)]
            own = np.add.reduceat(self.holds[_own_word(np.repeat(item, size), word)], place, dtype=np.int64)
            kept.append(rows[at : at + _TOGETHER][own >= n - n // 5])
        return np.concatenate(kept)

    def leaks(self, words: Words) -> dict[int, dict[int, tuple[int, int, int]]]:
        """By text and item: the smallest distance, and first word and number of words of the stretch."""
        out: dict[int, dict[int, tuple[int, int, int]]] = {}
        seen: dict[tuple[int, int], int] = {}
        for text, item, begin in self._promising(words, self.candidates(words)).tolist():
            own = self.items[item].words
            n, slack = len(own), len(own) // 5
            if begin - seen.get((text, item), -(10**9)) <= slack // 2:
                continue  # the stretch just verified covers it
            a, b = words.offsets[text : text + 2].tolist()
            low, high = max(a, a + begin - 2 * slack), min(b, a + begin + n + 2 * slack)
            region = words.hashes[low:high].tolist()
            if self.items[item].lacking(region) > slack:
                continue  # each word of the item that the region lacks is an edit
            distance, end = edit_end(own, region)
            if distance > slack:
                continue
            seen[text, item] = begin
            back, length = edit_end(own[::-1], region[end - 1 :: -1] if end else [], distance)
            assert back == distance
            hit = (distance, low - a + end - length, length)
            best = out.setdefault(text, {})
            best[item] = min(best.get(item, hit), hit)
        return out


def _items(rows) -> list[Item]:
    ids, texts = [r["item_id"] for r in rows], pa.array([r["text"] for r in rows], pa.string())
    out = []
    for words in hashed_words(texts, lower=True):
        for i in range(len(words)):
            a, b = words.offsets[i : i + 2]
            if b > a:
                out.append(Item(ids[words.first + i], words.hashes[a:b].tolist()))
    return out


_LEAK = pa.struct(
    [("item_id", pa.int64()), ("distance", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64())]
)
_LEAKS_DDL = "array<struct<item_id: long, distance: long, first_word: long, n_words: long>>"


def _finder(shared):
    def find(texts: pa.Array) -> pa.Array:
        index = shared.value
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for words in hashed_words(texts, lower=True):
            for text, hits in index.leaks(words).items():
                out[words.first + text] = [
                    {"item_id": index.items[i].item_id, "distance": d, "first_word": first, "n_words": n}
                    for i, (d, first, n) in sorted(hits.items())
                ]
        return pa.array(out, pa.list_(_LEAK))

    # So that the planner does not ask it twice, once for a filter on its result.
    return F.arrow_udf(find, _LEAKS_DDL).asNondeterministic()


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[Item]]:
    """The items in blocks of about ``BLOCK_WORDS`` words, one at the driver at a time."""
    rows = benchmark.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).where("text IS NOT NULL")
    words = rows.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).collect()[0][0] or 0
    blocks = max(1, -(-2 * words // BLOCK_WORDS))
    for block in range(blocks):
        items = _items(rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect())
        if items:
            yield items


def _passes(docs: DataFrame, benchmark: DataFrame, text: str) -> Iterator[tuple[Column, Broadcast, bool]]:
    """For each block, an array of its items found in each text, the index in use, and whether it is the last."""
    blocks = item_blocks(benchmark)
    items = next(blocks, None)
    while items is not None:
        shared, items = docs.sparkSession.sparkContext.broadcast(Index(items)), next(blocks, None)
        yield _finder(shared)(F.col(f"`{text}`").cast("string")), shared, items is None


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and benchmark item found in it, with the best stretch and its distance."""
    passes = []
    for found, shared, last in _passes(docs, benchmark, text):
        rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), found.alias("leaks")).select("doc_id", F.inline("leaks"))
        if not last:
            rows = stored(rows, "leaks")
            shared.unpersist()
        passes.append(rows)
    if not passes:
        none = F.lit(None).cast(_LEAKS_DDL).alias("leaks")
        return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), none).select("doc_id", F.inline("leaks"))
    return reduce(DataFrame.unionAll, passes)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no benchmark item is found."""
    for found, shared, last in _passes(docs, benchmark, text):
        docs = docs.where(F.size(found) == 0)
        if not last:
            docs = stored(docs, "clean")
            shared.unpersist()
    return docs
