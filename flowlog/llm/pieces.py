"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces of a word, counted without building them: a trie of the vocabulary in
which every node has a failure link, the node at which matching goes on once the longest pieces so far
are popped, and the number of pieces that are popped on the way. One step per byte and link; each pop
pays for the bytes before it, so a word costs time linear in its length. A word in which no piece fits
at some place is unknown and counts as one token.

The vocabulary is a JSON file of a public byte-level tokenizer with an end-of-word mark; its path is a parameter
and it is read on the driver. Words are lower-cased (A-Z). Word counts repeat, so tasks remember the counts of
up to ``REMEMBERED`` words.

Defined results: null and empty texts have no words and no tokens. Repeated rows are counted each. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
END_OF_WORD = "</w>"
REMEMBERED = 300_000
#: Symbol after the last byte of a word, and the number of symbols.
_END, _SYMBOLS = 256, 257


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: itself, or 256 and up for unprintable ones."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_pieces(path: str = VOCABULARY, end: str = END_OF_WORD) -> list[tuple[int, ...]]:
    """The vocabulary's pieces as symbols: bytes, and the end of a word."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    code = byte_of()
    pieces = []
    for piece in vocabulary:
        body = piece.removesuffix(end)
        if body and all(c in code for c in body):
            pieces.append(tuple(code[c] for c in body) + ((_END,) if piece != body else ()))
    return pieces


class Automaton:
    """Trie with failure links; ``children`` maps ``node * _SYMBOLS + symbol`` to a node, the root is 0."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]) -> None:
        self.children: dict[int, int] = {}
        is_piece = [False]
        order: list[tuple[int, int, int]] = []  # node, parent, symbol
        for piece in pieces:
            node = 0
            for symbol in piece:
                edge = node * _SYMBOLS + symbol
                child = self.children.get(edge)
                if child is None:
                    child = self.children[edge] = len(is_piece)
                    is_piece.append(False)
                    order.append((child, node, symbol))
                node = child
            is_piece[node] = bool(piece)
        depth = [0] * len(is_piece)
        for node, parent, _ in order:
            depth[node] = depth[parent] + 1
        #: Where to go on, -1 if nothing fits, and how many pieces are popped.
        self.fail, self.popped = [-1] * len(is_piece), [0] * len(is_piece)
        for node, parent, symbol in sorted(order, key=lambda e: depth[e[0]]):
            if is_piece[node]:
                self.fail[node], self.popped[node] = 0, 1
                continue
            at, pops = self.fail[parent], self.popped[parent]
            while at >= 0 and at * _SYMBOLS + symbol not in self.children:
                pops += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.popped[node] = self.children[at * _SYMBOLS + symbol], pops

    def count(self, word: bytes) -> int:
        """Number of pieces of a word; 0 if it is unknown."""
        children, fail, popped = self.children, self.fail, self.popped
        node = pieces = 0
        for symbol in (*word, _END):
            while (child := children.get(node * _SYMBOLS + symbol)) is None:
                pieces += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = child
        while node:
            pieces += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return pieces


class _Counts(dict):
    """Counts by lower-cased word, worked out when first asked for."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.automaton.count(word)
        return found


_kept: dict[int, _Counts] = {}


def _counter(shared, key: int):
    def count(texts: pa.Array) -> pa.Array:
        if key not in _kept:
            _kept.clear()
            _kept[key] = _Counts(Automaton(shared.value))
        look = _kept[key].__getitem__
        words, tokens, unknown = [], [], []
        for text in texts.cast(pa.binary()).to_pylist():
            found = list(map(look, (text or b"").lower().split()))
            missed = found.count(0)
            words.append(len(found))
            tokens.append(sum(found) + missed)
            unknown.append(missed)
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (words, tokens, unknown)], ["n_words", "n_tokens", "n_unknown"]
        )

    return F.arrow_udf(count, "struct<n_words: long, n_tokens: long, n_unknown: long>")


def token_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    pieces: Iterable[tuple[int, ...]] | None = None,
) -> DataFrame:
    """One row per document: words, word-piece tokens, and words that no pieces make up."""
    pieces = read_pieces() if pieces is None else list(pieces)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    count = _counter(shared, hash(tuple(pieces)))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), count(F.col(f"`{text}`").cast("string")).alias("x")
    ).select("doc_id", "x.*")
