"""Toxicity scores of a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters the network twice: by its own vector, if it is one of the training words, and by the sum of
the vectors of its character n-grams over the root of their number, so that forms never seen are read by their letters. The first
component of these vectors starts from how much more often the word or n-gram stands in toxic training
documents than in clean ones. A gated
recurrent unit runs over a window of words in either direction, attention pools its states, and a logistic unit gives
the window's score. A text is cut into windows of ``WINDOW`` words, each overlapping the next by half; all
are scored and the highest counts, through a logistic curve fitted on the training documents.

Training is multiple-instance learning on a bounded sample: at most ``TRAIN_DOCS`` clean and toxic documents,
the first by hash of their id, the longest of which are left out while those of a label have more than ``TRAIN_WORDS``
words; of the others, all windows. A toxic document
teaches by its highest window, a clean one by its two highest and a random one. Labels and texts are the only inputs;
documents whose crc32(id) leaves 1 when divided by 3 are held out.

Defined results: null and empty texts have no window and score as the curve does at its lowest training
logit. A null id is not held out and not trained on. Repeated rows are scored each. Without labels of both kinds
every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlog.llm.words import WORD, Words, hash_texts, hashed_words, span_hashes, stream

WINDOW, STRIDE = 48, 24
#: Documents of either label, and words of whole documents a label, that training takes at most.
TRAIN_DOCS, TRAIN_WORDS = (2000, 1000), 1_500_000
#: Training words that have a vector of their own; n-grams share theirs by hash.
WORD_VECTORS, GRAM_VECTORS, GRAMS = 20_000, 1 << 17, (3, 4, 5)
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
EPOCHS, BATCH, RATE, VECTOR_RATE, DROPOUT = 8, 128, 0.01, 0.003, 0.3
PREDICT_FROM = 0.7
#: Windows a task scores together.
TOGETHER = 1024
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = stream(41, max(GRAMS) * 256).reshape(-1, 256)
#: Stand for the ends of a word.
_BEGIN, _END = np.uint8(2), np.uint8(3)


def cores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without ASCII punctuation at their ends, as starts and ends; empty if they are all punctuation."""
    place = np.append(np.flatnonzero(~_PUNCTUATION[data]), len(data))
    first = np.minimum(place[np.searchsorted(place, starts)], ends)
    last = place[np.maximum(np.searchsorted(place, ends) - 1, 0)] + 1
    return first, np.maximum(np.minimum(last, ends), first)


#: n-grams of one length: the words that have any, their buckets word by word, and how many each has.
Level = tuple[np.ndarray, np.ndarray, np.ndarray]


def ngrams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[Level]:
    """Buckets of the character n-grams of words, their ends marked; an empty word has one trigram."""
    padded = np.append(data, np.full(max(GRAMS) + 1, _END))
    levels = []
    for size in GRAMS:
        counts = np.maximum(ends - starts + 3 - size, int(size == 3))
        word = np.flatnonzero(counts)
        n = counts[word]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) - 1  # -1 is the mark before the word
        begin, length = np.repeat(starts[word], n), np.repeat((ends - starts)[word], n)
        h = np.full(len(place), size, np.uint64)
        for j in range(size):
            at = place + j
            byte = padded[np.maximum(begin + at, 0)]
            h += _BYTES[j][np.where(at < 0, _BEGIN, np.where(at >= length, _END, byte))]
        h ^= h >> np.uint64(31)
        levels.append((word, (h % np.uint64(GRAM_VECTORS)).astype(np.int32), n))
    return levels


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters by name. Row ``i + 1`` of ``words`` is the vector of the word with hash ``vocabulary[i]``,
    which are sorted; row 0, of any other word, stays zero."""

    vocabulary: np.ndarray
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    lowest: float = 0.0
    _m: dict = field(default_factory=dict, repr=False)

    @classmethod
    def new(cls, vocabulary: np.ndarray, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        d = WORD_DIM + CHAR_DIM

        def normal_of(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {
            "words": normal_of(len(vocabulary) + 1, WORD_DIM, scale=0.1),
            "chars": normal_of(GRAM_VECTORS, CHAR_DIM, scale=0.1),
            "attend": normal_of(2 * HIDDEN, ATTENTION, scale=0.3),
            "query": normal_of(ATTENTION, scale=0.3),
            "out": normal_of(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        p["words"][0] = 0
        for way in ("f", "b"):
            p["w" + way] = normal_of(d, 3 * HIDDEN, scale=0.3)
            p["u" + way] = normal_of(HIDDEN, 3 * HIDDEN, scale=0.3)
            p["c" + way] = np.zeros(3 * HIDDEN, np.float32)
        return cls(np.sort(vocabulary), p)

    # words to inputs

    def lookup(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, list[Level]]:
        """Vector rows of lower-cased words without edges, and their n-grams."""
        if not len(self.vocabulary):
            own = np.zeros(len(starts), np.int64)
        else:
            place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
            own = np.where(self.vocabulary[place] == hashes, place + 1, 0)
        return own, ngrams(data, starts, ends)

    def inputs(self, own: np.ndarray, levels: list[Level]) -> np.ndarray:
        chars = np.zeros((len(own), CHAR_DIM), self.p["chars"].dtype)
        total = np.zeros(len(own), np.float32)
        for word, buckets, n in levels:
            if len(word):
                chars[word] += np.add.reduceat(self.p["chars"][buckets], np.cumsum(n) - n)
                total[word] += n
        return np.concatenate([self.p["words"][own], chars / np.sqrt(np.maximum(total, 1))[:, None]], 1)

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """What words add to the gates of both directions, and a last row that leaves a state as it is."""
        rows = np.concatenate([inputs @ self.p["wf"] + self.p["cf"], inputs @ self.p["wb"] + self.p["cb"]], 1)
        idle = np.zeros((1, 6 * HIDDEN), np.float32)
        idle[:, [*range(HIDDEN), *range(3 * HIDDEN, 4 * HIDDEN)]] = 30
        return np.concatenate([rows, idle])

    # windows to logits

    def _run(self, gates: np.ndarray, ids: np.ndarray, way: str, keep: list | None) -> Iterator[tuple[int, np.ndarray]]:
        u, low = self.p["u" + way], 0 if way == "f" else 3 * HIDDEN
        h = np.zeros((len(ids), HIDDEN), gates.dtype)
        steps = range(ids.shape[1]) if way == "f" else range(ids.shape[1] - 1, -1, -1)
        for t in steps:
            x = gates[ids[:, t], low : low + 3 * HIDDEN]
            a = h @ u
            zr = _sigmoid(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if keep is not None:
                keep.append((t, h, z, r, n, a[:, 2 * HIDDEN :]))
            h = new
            yield t, h

    def forward(self, gates: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``ids`` are rows of ``gates``, the last one for places past a window's end."""
        states = np.empty((ids.shape[1], len(ids), 2 * HIDDEN), gates.dtype)
        for way, low in (("f", 0), ("b", HIDDEN)):
            trace = None if keep is None else keep.setdefault(way, [])
            for t, h in self._run(gates, ids, way, trace):
                states[t, :, low : low + HIDDEN] = h
        lit = np.tanh(states @ self.p["attend"])
        weights = lit @ self.p["query"]
        weights[ids.T == len(gates) - 1] = -1e9
        weights -= weights.max(0)
        np.exp(weights, out=weights)
        weights /= weights.sum(0)
        pooled = (states * weights[:, :, None]).sum(0)
        if keep is not None:
            keep |= {"states": states, "lit": lit, "weights": weights, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"]

    def backward(self, inputs: np.ndarray, gates: np.ndarray, ids: np.ndarray, keep: dict, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters but the vectors, and of the inputs."""
        p, states, lit, weights = self.p, keep["states"], keep["lit"], keep["weights"]
        g = {"out": keep["pooled"].T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weights[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_score = weights * (d_weight - (weights * d_weight).sum(0))
        g["query"] = np.tensordot(d_score, lit, ((0, 1), (0, 1)))
        d_lit = d_score[:, :, None] * p["query"] * (1 - lit * lit)
        g["attend"] = np.tensordot(states, d_lit, ((0, 1), (0, 1)))
        d_states = d_states + d_lit @ p["attend"].T
        d_gates = np.zeros_like(gates)
        for way, low in (("f", 0), ("b", 3 * HIDDEN)):
            u, at = p["u" + way], 0 if way == "f" else HIDDEN
            d_h = np.zeros((len(ids), HIDDEN), gates.dtype)
            g_u = np.zeros_like(u)
            for t, h, z, r, n, a_n in reversed(keep[way]):
                d_h = d_h + d_states[t, :, at : at + HIDDEN]
                d_n = d_h * (1 - z) * (1 - n * n)
                d_z = d_h * (h - n) * z * (1 - z)
                d_r = d_n * a_n * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_n * r], 1)
                d_x = np.concatenate([d_z, d_r, d_n], 1)
                np.add.at(d_gates[:, low : low + 3 * HIDDEN], ids[:, t], d_x)
                g_u += h.T @ d_a
                d_h = d_h * z + d_a @ u.T
            g["u" + way] = g_u
        d_inputs = np.zeros_like(inputs)
        for way, low in (("f", 0), ("b", 3 * HIDDEN)):
            own = d_gates[:-1, low : low + 3 * HIDDEN]
            g["w" + way], g["c" + way] = inputs.T @ own, own.sum(0)
            d_inputs += own @ p["w" + way].T
        return g, d_inputs

    def step(self, grads: dict[str, np.ndarray], rate: float, t: int) -> None:
        """One step of Adam."""
        for name, g in grads.items():
            m, v = self._m.get(name, (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self._m[name] = m, v
            self.p[name] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -50, 50)))


def window_starts(n: int) -> range:
    """First words of the overlapping windows of ``n`` words; the last one reaches the end."""
    return range(0, max(1, n - STRIDE), STRIDE) if n else range(0)


def _ids(words: np.ndarray, begin: np.ndarray, end: np.ndarray, idle: int) -> np.ndarray:
    """Rows of the words of windows, ``idle`` past their ends."""
    at = begin[:, None] + np.arange(WINDOW)
    inside = at < end[:, None]
    return np.where(inside, words[np.minimum(at, len(words) - 1)], idle)


# training


def train(windows: list[bytes], docs: np.ndarray, toxic: np.ndarray, seed: int = 0, epochs: int = EPOCHS) -> Network:
    """From windows as words joined by spaces, the document of each, and the label of each document."""
    words = hash_texts(0, windows)
    data = _LOWER[np.frombuffer(words.buffer, np.uint8)]
    starts, ends = cores(data, words.starts, words.ends)
    hashes, first_at, row = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[first_at], ends[first_at]
    idle = len(hashes)
    doc_of_word = docs[words.text_of_word()]
    # Words of two documents or more have a vector of their own, the most common ones if they are many.
    in_docs = np.bincount(np.unique(row * len(toxic) + doc_of_word) // len(toxic), minlength=idle)
    often = np.lexsort((hashes, -in_docs))[:WORD_VECTORS]
    network = Network.new(hashes[often[in_docs[often] > 1]], seed)
    counts = np.diff(words.offsets)
    ids = np.full((len(windows), WINDOW), idle, np.int32)
    ids[words.text_of_word(), np.arange(len(row)) - np.repeat(words.offsets[:-1], counts)] = row
    own, levels = network.lookup(data, starts, ends, hashes)
    network.p["words"][:, 0], network.p["chars"][:, 0] = evidence(network, own, levels, row, doc_of_word, toxic)
    del own, levels, row, doc_of_word, words
    rng = np.random.default_rng(seed)
    t = 0

    def logits() -> np.ndarray:
        parts = [slice(low, low + 20_000) for low in range(0, idle, 20_000)]  # words worked out together
        inputs = [network.inputs(*network.lookup(data, starts[x], ends[x], hashes[x])) for x in parts]
        gates = network.gates(np.concatenate([np.empty((0, WORD_DIM + CHAR_DIM), np.float32), *inputs]))
        return np.concatenate([network.forward(gates, ids[i : i + TOGETHER]) for i in range(0, len(ids), TOGETHER)])

    def best(values: np.ndarray) -> np.ndarray:
        """Windows by document and falling logit, as places in that order."""
        return np.lexsort((-values, docs))

    first = np.flatnonzero(np.diff(docs, prepend=-1))  # windows come document by document
    n_windows = np.diff(first, append=len(docs))
    for epoch in range(epochs):
        if epoch == 0:
            chosen = np.unique(np.concatenate([first + rng.integers(0, n_windows) for _ in range(3)]))
        else:
            order = best(logits())
            second = np.minimum(first + 1, first + n_windows - 1)
            clean = np.flatnonzero(~toxic)
            chosen = np.unique(np.concatenate([order[first], order[second[clean]], (first + rng.integers(0, n_windows))[clean]]))
        rng.shuffle(chosen)
        weight = np.where(toxic[docs[chosen]], 0.5 / max(1, toxic[docs[chosen]].sum()), 0.5 / max(1, (~toxic[docs[chosen]]).sum()))
        rate = RATE * (1 - 0.8 * epoch / epochs)
        for low in range(0, len(chosen), BATCH):
            batch = chosen[low : low + BATCH]
            used, local = np.unique(ids[batch], return_inverse=True)
            used = used[used < idle]
            local = local.reshape(len(batch), WINDOW)
            seen, grams = network.lookup(data, starts[used], ends[used], hashes[used])
            seen[rng.random(len(seen)) < DROPOUT] = 0  # so that words are learned by their letters as well
            inputs = network.inputs(seen, grams)
            gates = network.gates(inputs)
            keep: dict = {}
            z = network.forward(gates, local, keep)
            y = toxic[docs[batch]].astype(np.float32)
            scale = (weight[low : low + BATCH] * len(chosen)).astype(np.float32) / len(batch)
            grads, d_inputs = network.backward(inputs, gates, local, keep, (_sigmoid(z) - y) * scale)
            g_words = np.zeros_like(network.p["words"])
            np.add.at(g_words, seen, d_inputs[:, :WORD_DIM])
            g_words[0] = 0
            g_chars = np.zeros_like(network.p["chars"])
            total = np.zeros(len(used), np.float32)
            for word, _, n in grams:
                total[word] += n
            spread = d_inputs[:, WORD_DIM:] / np.sqrt(np.maximum(total, 1))[:, None]
            for word, buckets, n in grams:
                np.add.at(g_chars, buckets, np.repeat(spread[word], n, axis=0))
            t += 1
            network.step(grads, rate, t)
            network.step({"words": g_words, "chars": g_chars}, rate * VECTOR_RATE / RATE, t)
    top = np.maximum.reduceat(logits(), first)
    network.lowest = float(top.min())
    network.slope, network.shift = _curve(top, toxic)
    network._m.clear()
    return network


def evidence(
    network: Network, own: np.ndarray, levels: list[Level], row: np.ndarray, doc: np.ndarray, toxic: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each word vector and each n-gram vector, between -2 and 2: how far the number of toxic documents with
    it departs from what its number of documents lets expect."""
    found = []
    for size, of_word in ((len(network.vocabulary) + 1, None), (GRAM_VECTORS, levels)):
        with_it = np.zeros((2, size))
        order = np.argsort(doc, kind="stable")
        bounds = np.searchsorted(doc[order], np.arange(len(toxic) + 1))
        parts = [] if of_word is None else [(_begin_of(word, n, len(own)), buckets) for word, buckets, n in of_word]
        for d in range(len(toxic)):
            words = np.unique(row[order[bounds[d] : bounds[d + 1]]])
            if of_word is None:
                here = np.unique(own[words])
            else:
                here = np.unique(np.concatenate([_pieces(begin, buckets, words) for begin, buckets in parts]))
            with_it[int(toxic[d]), here] += 1
        share, n = toxic.mean(), with_it.sum(0)
        found.append(2 * np.tanh((with_it[1] - n * share) / np.sqrt(n * share * (1 - share) + 1) / 6))
    found[0][0] = 0
    return found[0].astype(np.float32), found[1].astype(np.float32)


def _begin_of(word: np.ndarray, n: np.ndarray, words: int) -> np.ndarray:
    """Where each word's n-grams begin; the next word's begin is their end."""
    sizes = np.zeros(words + 1, np.int64)
    sizes[word + 1] = n
    return np.cumsum(sizes)


def _pieces(begin: np.ndarray, buckets: np.ndarray, words: np.ndarray) -> np.ndarray:
    n = begin[words + 1] - begin[words]
    return buckets[np.repeat(begin[words], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


def _curve(logits: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve over documents' highest logits, both labels weighing the same, lightly smoothed."""
    slope, shift = 1.0, 0.0
    y = np.where(toxic, 0.99, 0.01)
    w = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    for _ in range(2000):
        error = w * (1 / (1 + np.exp(-np.clip(slope * logits + shift, -50, 50))) - y)
        slope -= 0.5 * float((error * logits).sum())
        shift -= 0.5 * float(error.sum())
    return slope, shift


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        columns = batch["doc_id"].to_pylist(), batch["toxic"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()
        for doc, toxic, text in zip(*columns, strict=True):
            words = (text or b"").split()
            starts = window_starts(len(words))
            out += [{"doc_id": doc, "toxic": toxic, "window": b" ".join(words[i : i + WINDOW])} for i in starts]
        schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("window", pa.binary())])
        yield pa.RecordBatch.from_pylist(out, schema)


def _train_on_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted({row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)})
    number = {doc: i for i, doc in enumerate(dict.fromkeys(doc for doc, _, _ in rows))}
    toxic = np.zeros(len(number), bool)
    for doc, label, _ in rows:
        toxic[number[doc]] = label
    if toxic.any() and not toxic.all():
        network = train([w for _, _, w in rows], np.array([number[doc] for doc, _, _ in rows]), toxic)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame | None:
    """``(doc_id, toxic, text)`` of the bounded sample of labelled documents that are not held out; None if a label is
    missing."""
    known = (
        labels.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{toxic}`").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS[y]) for y in (0, 1)]
    chosen = [tuple(r) for part in picked for r in part.collect()]
    if len({y for _, y in chosen}) < 2:
        return None
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")
    texts = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).join(F.broadcast(ids), "doc_id")  # at most sum(TRAIN_DOCS) ids
    texts = texts.withColumn("n_words", F.regexp_count("text", F.lit(WORD))).where(F.col("n_words") <= TRAIN_WORDS).distinct()
    shortest = Window.partitionBy("toxic").orderBy("n_words", F.xxhash64("doc_id"), "doc_id", "text")
    whole = texts.withColumn("total", F.sum("n_words").over(shortest)).where(F.col("total") <= TRAIN_WORDS)
    return whole.select("doc_id", "toxic", "text")


def train_on(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Network | None:
    """A network trained, in one task, on all windows of the sample; None if a label is missing."""
    whole = sample(docs, labels, doc_id, text, toxic)
    if whole is None:
        return None
    windows = whole.mapInArrow(_windows, "doc_id long, toxic int, window binary")
    found = windows.repartition(1).mapInArrow(_train_on_all, "network binary").collect()
    return pickle.loads(found[0]["network"]) if found else None


# scoring


def word_gates(network: Network, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Gate rows of the distinct words, an idle row last, and each word's row."""
    _, first, row = np.unique(words.hashes, return_index=True, return_inverse=True)
    data = _LOWER[np.frombuffer(words.buffer, np.uint8)]
    starts, ends = cores(data, words.starts[first], words.ends[first])
    inputs = network.inputs(*network.lookup(data, starts, ends, span_hashes(data, starts, ends)))
    return network.gates(inputs), row


def highest(network: Network, texts: pa.Array) -> np.ndarray:
    """The highest window logit of each text; ``network.lowest`` for texts without words."""
    out = np.full(len(texts), network.lowest)
    for words in hashed_words(texts):
        if not len(words.hashes):
            continue
        gates, rows = word_gates(network, words)
        counts = np.diff(words.offsets)
        n = np.where(counts > 0, -(-np.maximum(counts - STRIDE, 1) // STRIDE), 0)
        text = np.repeat(np.arange(len(words)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = words.offsets[text] + nth * STRIDE
        end = np.minimum(words.offsets[text + 1], begin + WINDOW)
        logits = np.concatenate(
            [
                network.forward(gates, _ids(rows, begin[i : i + TOGETHER], end[i : i + TOGETHER], len(gates) - 1))
                for i in range(0, len(begin), TOGETHER)
            ]
        )
        full = np.flatnonzero(n)
        out[words.first + full] = np.maximum.reduceat(logits, (np.cumsum(n) - n)[full])
    return out


def _scorer(shared):
    def score(texts: pa.Array) -> pa.Array:
        network = shared.value
        return pa.array(network.score(highest(network, texts)).astype(np.float64))

    return F.arrow_udf(score, "double")


def scored(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: whether it is held out, its score, and 1 if that is at least ``PREDICT_FROM``."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    if network is None:
        score = F.lit(0.0)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(network)
        score = _scorer(shared)("text")
    rows = own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
