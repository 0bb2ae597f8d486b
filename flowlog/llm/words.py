"""Words of Arrow text columns as 64-bit hashes, computed over whole byte buffers with numpy.

A word is a maximal run of bytes other than space and ``\\t``..``\\r`` (``[^\\x20\\x09-\\x0D]+``); these are
also the bytes ``bytes.split()`` splits at. Equal words have equal hashes; two different words share one
with a chance of about 2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The words of a text, as the patterns of Java, Python and RE2 write them.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are hashed together up to about this many bytes; one longer text is hashed by itself.
BUFFER_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers that look random, the same in every process."""
    first = np.uint64((seed * 0xD1342543DE82EF95 + 1) & (2**64 - 1))
    with np.errstate(over="ignore"):
        return mix(first + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER))


_BYTE = stream(1, 256)
_BYTE_LOWER = _BYTE[_LOWER]


class _Powers:
    """Powers of the odd multiplier and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = 1 << max(20, (n - 1).bit_length())
            both = []
            for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 2**64)):
                table = np.full(self.size, base, np.uint64)
                table[0] = 1
                both.append(np.multiply.accumulate(table))
            self.forward, self.inverse = both
        return self.forward, self.inverse


_powers = _Powers()


@dataclass
class Words:
    """The words of consecutive texts.

    ``hashes`` has one entry per word; the words of text ``i`` are ``offsets[i]`` to ``offsets[i + 1]``.
    ``starts`` and ``ends`` are byte positions in ``buffer``.
    """

    first: int  # index of the first text in the column
    buffer: bytes
    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of the bytes from each start up to its end; ``lower`` reads A-Z as a-z."""
    forward, inverse = _powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = (_BYTE_LOWER if lower else _BYTE)[data]
    values *= forward[: len(data)]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def hash_texts(first: int, texts: list[bytes], lower: bool = False) -> Words:
    """The words of texts that are hashed together."""
    buffer = b"\n".join(texts) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(space.view(np.int8), prepend=1, append=1))
    starts, ends = edges[0::2], edges[1::2]
    hashes = span_hashes(data, starts, ends, lower)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    return Words(first, buffer, hashes, np.searchsorted(starts, bounds), starts, ends)


def hashed_words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a string column, null as empty text, a buffer of whole texts at a time.

    ``lower`` reads A-Z as a-z. Texts come in their order, each in one buffer.
    """
    texts: list[bytes] = []
    first = size = 0
    for i, text in enumerate(column.cast(pa.binary())):
        value = text.as_py() or b""
        texts.append(value)
        size += len(value) + 1
        if size >= BUFFER_BYTES:
            yield hash_texts(first, texts, lower)
            texts, first, size = [], i + 1, 0
    if texts:
        yield hash_texts(first, texts, lower)


def windows(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive words of one text, and the index of each one's first word."""
    if len(hashes) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    factors = stream(k, 16)
    whole, length, power, level = None, 0, hashes, 0
    rest = k
    size = 1
    while rest:  # binary decomposition of k, a doubled run at a time
        if rest & 1:
            if whole is None:
                whole, length = power, size
            else:
                n = len(hashes) - length - size + 1
                whole = whole[:n] * (factors[8 + level] | np.uint64(1)) + power[length : length + n]
                length += size
        rest >>= 1
        if rest:
            n = len(power) - size
            power = power[:n] * (factors[level] | np.uint64(1)) + power[size : size + n]
            power = power ^ (power >> np.uint64(29))
            size *= 2
            level += 1
    # windows that begin in the last k - 1 words of a text reach into the next one
    inside = np.ones(len(whole) + k, bool)
    lengths = np.diff(offsets)
    for back in range(1, k):
        ends = offsets[1:][lengths >= back] - back
        inside[ends[ends < len(inside)]] = False
    at = np.flatnonzero(inside[: len(whole)])
    return mix(whole[at]), at
