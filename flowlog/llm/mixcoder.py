"""Adaptive context mixing and range coding of id blocks, many blocks side by side in numpy.

A block is coded by itself: first its alphabet with a frequency class per id, then the ids by a model that starts anew. Ids are
numbered by their place in the alphabet. Three orders predict each id. Orders 2 and 1 name the id that came last after the
same two ids, or the same one, and know how often in a row it was right; order 0 is the block's frequencies. The
code space is their mixture: order 2's id, order 1's and all ids by order 0 get shares by weights, one set for each pair of
confidences and whether both name the same id. Weights start even and move with every id towards what proved right. A
64-bit range coder that gives out 32 bits at a time codes the share, and order 0's id where that is needed. All arithmetic is on
integers, so every machine decodes alike.

A block holds ``BLOCK_IDS`` ids at most. Step ``t`` codes the id ``t`` of all blocks, a lane each; lanes do not see one another.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096
#: Blocks coded side by side.
LANES = 2048

_BITS = 12  # of an id's place in the alphabet; what stands above it in a context's entry is its confidence
_MASK = BLOCK_IDS - 1
_CONTEXTS = 8192  # hashed contexts of order 2
_SURE = 7
_STATES = 128  # both confidences, and whether both predict the same
_RATE = 5
_LEAST, _MOST = 1024, 64512  # where weights end, of 65536
_SCALE_BITS = 13  # of order 0's frequencies
_SCALE = 1 << _SCALE_BITS

_WORD = np.uint64(1 << 32)
_LOW = np.uint64(0xFFFFFFFF)
_32, _16, _ZERO = np.uint64(32), np.uint64(16), np.uint64(_SCALE_BITS)


def classes(counts: np.ndarray) -> np.ndarray:
    """Frequency class of ids that come ``counts`` times, 0 to 23: two classes a doubling."""
    doubling = np.frexp(counts.astype(np.float32))[1] - 1
    return np.minimum(2 * doubling + (2 * counts >= 3 << doubling), 23).astype(np.uint8)


def frequencies(kinds: np.ndarray) -> np.ndarray:
    """Order 0's frequencies of an alphabet by class: each is 1 at least, and all are ``_SCALE`` together."""
    weights = np.where(kinds & 1, 3, 2).astype(np.int64) << (kinds >> 1)
    spare = _SCALE - len(kinds)
    extra = weights * spare // weights.sum()
    extra[np.argmax(weights)] += spare - extra.sum()
    return extra + 1


class _Model:
    """What all lanes know so far: entries of contexts, weights of the mixture, and the last two ids."""

    def __init__(self, lanes: int) -> None:
        self.first = np.zeros(lanes * BLOCK_IDS, np.int16)
        self.second = np.zeros(lanes * _CONTEXTS, np.int16)
        self.weight2 = np.full(lanes * _STATES, 1 << 15, np.int64)
        self.weight1 = np.full(lanes * _STATES, 1 << 15, np.int64)
        lane = np.arange(lanes)
        self.base1, self.base2, self.base = lane * BLOCK_IDS, lane * _CONTEXTS, lane * _STATES
        self.last = np.zeros(lanes, np.int64)
        self.mark = np.zeros(lanes, np.int64)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares of 65536 of order 2's id and, of what is left, of order 1's."""
        self.at1 = self.base1[:n] + self.last[:n]
        self.at2 = self.last[:n] * 5
        self.at2 += self.mark[:n]
        self.at2 &= _CONTEXTS - 1
        self.at2 += self.base2[:n]
        e1, e2 = self.first.take(self.at1), self.second.take(self.at2)
        self.c1, self.c2 = e1 & _MASK, e2 & _MASK
        self.n1, self.n2 = e1 >> _BITS, e2 >> _BITS
        state = self.n2 << 4
        state += self.n1 << 1
        state += self.c1 == self.c2
        self.state = self.base[:n] + state
        self.p2, self.p1 = self.weight2.take(self.state), self.weight1.take(self.state)
        return self.p2, self.p1

    def learn(self, n: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take in the ids (``int16``) that came; ``hit2`` and ``hit1`` (0 or 1) say whose share coded them."""
        goal = hit2 * (_MOST - _LEAST)
        goal += _LEAST
        goal -= self.p2
        goal >>= _RATE
        goal += self.p2
        self.weight2[self.state] = goal
        goal = hit1 * (_MOST - _LEAST)
        goal += _LEAST
        goal -= self.p1
        goal >>= _RATE
        goal *= 1 - hit2
        goal += self.p1
        self.weight1[self.state] = goal
        for entries, at, named, sure in ((self.first, self.at1, self.c1, self.n1), (self.second, self.at2, self.c2, self.n2)):
            sure = sure - (sure >= _SURE)
            sure *= named == ids
            sure += 1
            sure <<= _BITS
            sure += ids
            entries[at] = sure
        self.mark[:n] = self.last[:n]
        self.mark[:n] *= 1223
        self.last[:n] = ids


class _Range:
    """Lower end and width of each lane's range."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.width = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.at = np.zeros(lanes, np.int64)

    def take(self, n: int, share: np.ndarray, hit: np.ndarray) -> None:
        """Go to the lower ``share`` of the range where ``hit`` is 1, to the rest where it is 0."""
        hit, miss = hit.view(np.uint64), (1 - hit).view(np.uint64)
        self.low[:n] += share * miss
        rest = self.width[:n] - share
        rest *= miss
        share *= hit
        share += rest
        self.width[:n] = share

    def narrow(self) -> np.ndarray:
        """Lanes that have to give out a word. A range across a word's bound is cut there."""
        lanes = (self.width < _WORD).nonzero()[0]
        low, width = self.low.take(lanes), self.width.take(lanes)
        self.words = low >> _32
        low &= _LOW
        self.width[lanes] = np.minimum(width, _WORD - low) << _32
        self.low[lanes] = low << _32
        return lanes


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many lanes still have an id at each step."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


def _ranges(kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per lane and id, what is below it in order 0 and its own frequency."""
    own = np.zeros((len(kinds), BLOCK_IDS), np.int64)
    for i, kind in enumerate(kinds):
        own[i, : len(kind)] = frequencies(kind)
    return (own.cumsum(axis=1) - own).astype(np.uint16).reshape(-1), own.astype(np.uint16).reshape(-1)


def encode(blocks: list[np.ndarray], kinds: list[np.ndarray]) -> list[np.ndarray]:
    """The words (``<u4``) that code each block of alphabet places, whose ids have the classes ``kinds``.

    Longer blocks come first.
    """
    if not blocks:
        return []
    lengths = np.array([len(b) for b in blocks])
    ids = np.zeros((lengths[0], len(blocks)), np.int16)
    for i, block in enumerate(blocks):
        ids[: len(block), i] = block
    below, own = _ranges(kinds)
    model, coder = _Model(len(blocks)), _Range(len(blocks))
    out = np.zeros((len(blocks), lengths[0] + 8), np.uint32)
    for t, n in enumerate(_active(lengths).tolist()):
        now = ids[t, :n]
        p2, p1 = model.predict(n)
        hit2 = now == model.c2
        hit1 = now == model.c1
        hit1 &= ~hit2
        other = (~(hit1 | hit2)).nonzero()[0]
        hit2, hit1 = hit2.astype(np.int64), hit1.astype(np.int64)
        coder.take(n, (coder.width[:n] >> _16) * p2.view(np.uint64), hit2)
        share = (coder.width[:n] >> _16) * p1.view(np.uint64)
        share *= (1 - hit2).view(np.uint64)
        coder.take(n, share, hit1)
        place = model.base1.take(other) + now.take(other)
        part = coder.width.take(other) >> _ZERO
        coder.low[other] += part * below.take(place)
        coder.width[other] = part * own.take(place)
        model.learn(n, now, hit2, hit1)
        lanes = coder.narrow()
        at = coder.at.take(lanes)
        out[lanes, at] = coder.words
        coder.at[lanes] = at + 1
    lanes = np.arange(len(blocks))
    for word in (coder.low >> _32, coder.low & _LOW):
        out[lanes, coder.at] = word
        coder.at += 1
    return [out[i, :n].astype("<u4") for i, n in enumerate(coder.at)]


def decode(words: list[np.ndarray], lengths: np.ndarray, kinds: list[np.ndarray]) -> list[np.ndarray]:
    """The alphabet places of blocks of ``lengths`` ids; longer blocks come first."""
    if not words:
        return []
    lengths = np.asarray(lengths)
    columns = max(map(len, words)) + 2
    coded = np.zeros((len(words), columns), np.uint64)
    for i, block in enumerate(words):
        coded[i, : len(block)] = block
    below, own = _ranges(kinds)
    holder = np.repeat(np.tile(np.arange(BLOCK_IDS, dtype=np.int16), len(words)), own)
    model, coder = _Model(len(words)), _Range(len(words))
    code = (coded[:, 0] << _32) | coded[:, 1]
    coded, row = coded.reshape(-1), np.arange(len(words)) * columns
    coder.at += 2
    ids = np.zeros((lengths[0], len(words)), np.int16)
    for t, n in enumerate(_active(lengths).tolist()):
        p2, p1 = model.predict(n)
        share = (coder.width[:n] >> _16) * p2.view(np.uint64)
        hit2 = ((code[:n] - coder.low[:n]) < share).astype(np.int64)
        coder.take(n, share, hit2)
        miss2 = 1 - hit2
        share = (coder.width[:n] >> _16) * p1.view(np.uint64)
        share *= miss2.view(np.uint64)
        hit1 = ((code[:n] - coder.low[:n]) < share).astype(np.int64)
        coder.take(n, share, hit1)
        now = model.c2 - model.c1
        now *= hit2.astype(np.int16)
        now += model.c1
        miss2 -= hit1
        other = miss2.nonzero()[0]
        part = coder.width.take(other) >> _ZERO
        low = coder.low.take(other)
        value = np.minimum((code.take(other) - low) // part, np.uint64(_SCALE - 1)).view(np.int64)
        value += other * _SCALE
        found = holder.take(value)
        now[other] = found
        place = model.base1.take(other) + found
        low += part * below.take(place)
        coder.low[other] = low
        part *= own.take(place)
        coder.width[other] = part
        ids[t, :n] = now
        model.learn(n, now, hit2, hit1)
        lanes = coder.narrow()
        at = coder.at.take(lanes)
        code[lanes] = (code.take(lanes) << _32) | coded.take(row.take(lanes) + at)
        coder.at[lanes] = at + 1
    return [ids[:n, i].copy() for i, n in enumerate(lengths)]
