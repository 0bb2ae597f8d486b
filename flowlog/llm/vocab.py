"""Ids of texts by a public byte-level tokenizer, with the ids of repeated pieces of text remembered.

The vocabulary file's path is a parameter. The library splits a text at white space before it looks for merges,
and white space goes with the word after it, so a text cut before each run of white space has the same ids as the whole.
Such pieces repeat: a worker asks the library once for each and remembers the first ``REMEMBERED`` of them. Texts are cut, pieces
looked up and ids put together in Arrow, so only new pieces are strings of Python.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Byte-level BPE with 50,257 ids.
BYTE_BPE = "byte_bpe_50k.json"
REMEMBERED = 1_500_000
#: Texts looked at together, in characters; one longer text is by itself.
BATCH_CHARS = 1 << 24
#: New pieces the library is given as one text.
_JOINED = 500

# The characters of the Unicode property White_Space, by code point.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACE = "".join(f"\\u{c:04x}" for c in _SPACES)
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: White space besides single blanks and single line ends between words.
_ODD = [chr(c) for c in _SPACES if c not in (0x0A, 0x20)] + ["  ", "\n\n", " \n", "\n "]


def place(name: str) -> str:
    """Path of a public vocabulary file; a name with a folder is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def plain(text: str) -> bool:
    """Whether a text has no white space but single blanks and single line ends, and no NUL."""
    return "\0" not in text and not any(odd in text for odd in _ODD)


def pieces(text: str) -> list[str]:
    """The text cut before each run of white space. A piece that begins with NUL is what follows the NUL, one that
    begins with a line end is itself, and any other stands for a blank and itself."""
    if not plain(text):
        return ["\0" + piece for piece in _PIECE.findall(text)]
    return ("\0" + text).replace("\n", " \n").split(" ")


def spelled(piece: str) -> str:
    """The text a piece of ``pieces`` stands for."""
    if piece.startswith("\0"):
        return piece[1:]
    return piece if piece.startswith("\n") else " " + piece


def _cut(texts: list[str]) -> pa.ListArray:
    """The pieces of each text."""
    if all(map(plain, texts)):
        return pc.split_pattern(pa.array([("\0" + t).replace("\n", " \n") for t in texts], pa.string()), " ")
    return pa.array([pieces(t) for t in texts], pa.list_(pa.string()))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Ids one after another as lists of so many each."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, counts.cumsum()), pa.int32()), pa.array(ids, pa.uint32()))


class Encoder:
    """Ids as little-endian bytes of ``dtype``; special tokens in a text are plain text."""

    def __init__(self, vocabulary: str = BYTE_BPE, dtype: str = "<u4") -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(place(vocabulary))
        self.tokenizer.encode_special_tokens = True
        self.dtype = dtype
        ids = self.tokenizer.get_vocab()
        #: Bytes of each id's token, whose characters stand for a byte each.
        self.sizes = np.zeros(max(ids.values()) + 1, np.int64)
        self.sizes[list(ids.values())] = list(map(len, ids))
        #: Pieces that are remembered, and their ids.
        self.known = pa.array([], pa.string())
        self.ids = _lists(np.empty(0, np.uint32), np.empty(0, np.int64))

    def ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, straight from the library, one after another, and how many each has."""
        found = [f.ids for f in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def ask_joined(self, own: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """What ``ask`` gives, for pieces that stand for white space and a word. The library takes many as one text, as it
        cuts that where each of them begins; their ids are told apart by their bytes."""
        if not len(own):
            return self.ask([])
        bounds = pa.array([*range(0, len(own), _JOINED), len(own)], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(bounds, own), " ")
        ids, _ = self.ask([(" " + t).replace(" \n", "\n") for t in joined.to_pylist()])
        sizes = pc.binary_length(own).to_numpy() + pc.invert(pc.starts_with(own, "\n")).to_numpy(zero_copy_only=False)
        ends, bytes_to = sizes.cumsum(dtype=np.int64), self.sizes[ids].cumsum()
        last = np.searchsorted(bytes_to, ends)
        if len(ids) != last[-1] + 1 or (bytes_to[last] != ends).any():  # of another kind of vocabulary
            return self.ask([spelled(p) for p in own.to_pylist()])
        return ids, np.diff(last, prepend=-1)

    def _new(self, missing: pa.Array) -> tuple[pa.Array, pa.ListArray]:
        """The pieces in some order, and their ids."""
        apart = pc.or_(pc.starts_with(missing, "\0"), pc.is_in(missing, pa.array(["", "\n"])))
        single, others = missing.filter(apart), missing.filter(pc.invert(apart))
        parts = self.ask([spelled(p) for p in single.to_pylist()]), self.ask_joined(others)
        ids, counts = map(np.concatenate, zip(*parts, strict=True))
        return pa.concat_arrays([single, others]), _lists(ids, counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not texts:
            return []
        cut = _cut(texts)
        words = cut.flatten().dictionary_encode()
        places = pc.index_in(words.dictionary, value_set=self.known)
        if places.null_count:
            new, ids = self._new(words.dictionary.filter(places.is_null()))
            self.known, self.ids = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.ids, ids])
            places = pc.index_in(words.dictionary, value_set=self.known)
        found = self.ids.take(places.take(words.indices))
        ends = found.offsets.to_numpy()[cut.offsets.to_numpy()].tolist()
        flat = found.flatten().to_numpy().astype(self.dtype, copy=False)
        if len(self.known) > REMEMBERED:  # the last to come are the rarest
            self.known, self.ids = (pa.concat_arrays([x[:REMEMBERED], x[:0]]) for x in (self.known, self.ids))
        return [flat[a:b].tobytes() for a, b in itertools.pairwise(ends)]


@functools.cache
def encoder(vocabulary: str = BYTE_BPE, dtype: str = "<u4") -> Encoder:
    """One encoder a worker, so that tasks after one another share what it remembers."""
    return Encoder(vocabulary, dtype)


def lots(texts: list[str], chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``chars`` characters, with the index of the first."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]
