"""Source divergence audit: how far the terms of each source are from those of the other sources of its language.

Term frequencies come from single-pass in-memory indexing. A task reads its documents once and keeps postings (term, source,
occurrences, documents) in memory; when ``BLOCK_POSTINGS`` of them are there, the block is spilled as runs in term order,
one a language and hash shard of the terms, and the next block begins. A shard's runs are then merged by a heap into one
posting list a term. Spilled runs are rows that Spark shuffles, so no local file holds them, and a term of very many
documents is one posting a block and source.

A language keeps the terms of at least ``min_docs`` of its documents. With V of them, and N occurrences of these in a group,
a term of that group has p = 1 + floor(10^9 (count + 1) / (N + V)); a language is a group of all its sources. The divergence of
p from q is the sum of floor((p - q)^2 / q). Terms that neither of two sources has all give the same, so V times that is the
first value of a pair, and corrections are added: for the terms one side has, by source and count (equal counts are
alike), and for terms both sides have, streamed from the merged lists, whose sums a task keeps by pair.

Defined results: null text, language and source are read as ''. Repeated rows are documents of their own. Sources
without terms stand with counts of 0; a language that keeps no term has divergence 0 and no term rows. Ties are ranked by
the item's UTF-8 bytes. An empty table gives an empty result. All arithmetic is exact on integers.
"""

from __future__ import annotations

import heapq
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlog.llm.storage import partitions, stored

#: Postings a task keeps in memory before it spills them.
BLOCK_POSTINGS = 400_000
#: Documents of a language that a term must be in.
MIN_DOCS = 3
#: Ranks of terms that are reported.
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Pairs worked on, and sums of pairs kept, at a time.
CHUNK_PAIRS = 1 << 20

# Letters of ASCII, lower case here, and all that is not ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _packed(sources: list[bytes], terms: list[bytes], source: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> bytes:
    numbers = [x.astype(np.min_scalar_type(int(x.max()))) for x in (source, counts, docs)]
    return pickle.dumps((sources, b"\n".join(terms), *[(x.dtype.str, x.tobytes()) for x in numbers]))


def _unpacked(run: bytes) -> tuple[list[bytes], list[bytes], list[int], list[int], list[int]]:
    """A run's sources, and of each posting in term order: term, place of the source, occurrences, documents."""
    sources, terms, *numbers = pickle.loads(run)
    return sources, terms.split(b"\n"), *[np.frombuffer(data, kind).tolist() for kind, data in numbers]


class Block:
    """Postings of the documents read since the last spill."""

    def __init__(self) -> None:
        self.counts: dict[bytes, defaultdict[bytes, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.docs: dict[bytes, defaultdict[bytes, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.size = 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        terms = _TERM.findall(text.lower())
        counts = self.counts[lang][source]
        before = len(counts)
        counts.update(terms)
        self.docs[lang][source].update(set(terms))
        self.size += len(counts) - before

    def runs(self, shards: int) -> Iterator[tuple[bytes, int, bytes]]:
        """The postings by language and shard, in order of term and source."""
        for lang, by_source in self.counts.items():
            sources = sorted(by_source)
            terms = [t for s in sources for t in by_source[s]]
            if not terms:
                continue
            counts = np.array([n for s in sources for n in by_source[s].values()], np.int64)
            docs = np.array([n for s in sources for n in map(self.docs[lang][s].__getitem__, by_source[s])], np.int64)
            source = np.repeat(np.arange(len(sources)), [len(by_source[s]) for s in sources])
            shard = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % shards
            order = np.array(sorted(range(len(terms)), key=terms.__getitem__))
            order = order[np.argsort(shard[order], kind="stable")]
            bounds = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
            for i, (low, high) in enumerate(pairwise(bounds)):
                if low < high:
                    own = order[low:high]
                    yield lang, i, _packed(sources, [terms[k] for k in own.tolist()], source[own], counts[own], docs[own])


def _indexer(shards: int, block_postings: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spill(block: Block) -> Iterator[pa.RecordBatch]:
            for lang, shard, run in block.runs(shards):
                columns = [pa.array([lang.decode()], pa.string()), pa.array([shard], pa.int32()), pa.array([run], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "run"])

        block = Block()
        for batch in batches:
            columns = [batch[name].cast(pa.binary()).to_pylist() for name in ("lang", "source", "text")]
            for lang, source, text in zip(*columns, strict=True):
                block.add(lang, source, text)
                if block.size >= block_postings:
                    yield from spill(block)
                    block = Block()
        yield from spill(block)

    return index


_MERGED = pa.schema(
    [("lang", pa.string()), ("term", pa.string()),
     ("postings", pa.list_(pa.struct([("source", pa.string()), ("count", pa.int64())])))]
)
_MERGED_DDL = "lang string, term string, postings array<struct<source: string, count: bigint>>"
_MERGED_ROWS = 20_000


def merged(runs: list[bytes], min_docs: int) -> Iterator[tuple[bytes, dict[bytes, int]]]:
    """The terms in enough documents, in order, with the occurrences by source: a heap of the runs' next terms."""
    opened = [_unpacked(run) for run in runs]
    ahead = [iter(terms) for _, terms, *_ in opened]
    heap = [(next(terms), r) for r, terms in enumerate(ahead)]
    heapq.heapify(heap)
    at = [0] * len(opened)
    term, found, in_docs = b"", [], 0

    def counts() -> dict[bytes, int]:
        by_source: Counter = Counter()
        for r, k in found:
            sources, _, source, count, _ = opened[r]
            by_source[sources[source[k]]] += count[k]
        return by_source

    while heap:
        least, r = heap[0]
        if least != term:
            if in_docs >= min_docs:
                yield term, counts()
            term, found, in_docs = least, [], 0
        k = at[r]
        at[r] = k + 1
        found.append((r, k))
        in_docs += opened[r][4][k]
        following = next(ahead[r], None)
        if following is None:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (following, r))
    if in_docs >= min_docs:
        yield term, counts()


def _merger(min_docs: int):
    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = key[0].as_py()
        runs = [run for batch in batches for run in batch["run"].to_pylist()]
        rows: list[dict] = []
        for term, counts in merged(runs, min_docs):
            postings = [{"source": s.decode(), "count": n} for s, n in counts.items()]
            rows.append({"lang": lang, "term": term.decode(), "postings": postings})
            if len(rows) >= _MERGED_ROWS:
                yield pa.RecordBatch.from_pylist(rows, _MERGED)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, _MERGED)

    return merge


def term_frequencies(
    docs: DataFrame, min_docs: int = MIN_DOCS, block_postings: int = BLOCK_POSTINGS, shards: int | None = None
) -> DataFrame:
    """``lang, term, postings`` of the terms each language keeps; ``postings`` has source and occurrences.

    ``docs`` has ``lang``, ``source`` and ``text``, none of them null.
    """
    shards = shards or partitions(docs.sparkSession)
    index = _indexer(shards, block_postings)
    runs = docs.select("lang", "source", "text").mapInArrow(index, "lang string, shard int, run binary")
    return runs.groupBy("lang", "shard").applyInArrow(_merger(min_docs), _MERGED_DDL)


def _rate(count: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + 1) / size), in decimals where 64 bits could overflow."""
    share = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", share, size.cast("decimal(20,0)"))


def _away(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


_PAIRS_DDL = "lang string, source string, item string, value bigint"
_PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that two sources have: rows are a language's term with ``(source, p, p0)`` of each source,
    results are sums by pair, several rows a pair."""
    sums: Counter = Counter()

    def flush() -> pa.RecordBatch:
        rows = [(*pair, value) for pair, value in sums.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS, strict=True)], schema=_PAIRS)

    for batch in batches:
        lists = batch["rated"]
        rated = lists.flatten()
        names = pa.compute.dictionary_encode(rated.field("source"))
        source = names.indices.to_numpy().astype(np.int64)
        p, p0 = (rated.field(f).to_numpy() for f in ("p", "p0"))
        langs = pa.compute.dictionary_encode(batch["lang"])
        sizes = pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
        firsts = np.repeat(sizes.cumsum() - sizes, sizes)
        lang = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
        partners = np.repeat(sizes, sizes)
        ends = partners.cumsum()
        low = 0
        while low < len(partners):
            before = ends[low] - partners[low]
            high = max(low + 1, int(np.searchsorted(ends, before + CHUNK_PAIRS, side="right")))
            many = partners[low:high]
            i = np.repeat(np.arange(low, high), many)
            j = np.arange(len(i)) - np.repeat(many.cumsum() - many, many) + firsts[i]
            i, j = i[i != j], j[i != j]
            pi, pj, zi, zj = p[i], p[j], p0[i], p0[j]
            value = (pi - pj) ** 2 // pj - (pi - zj) ** 2 // zj - (zi - pj) ** 2 // pj + (zi - zj) ** 2 // zj
            n = len(names.dictionary)
            keys, place = np.unique((lang[i] * n + source[i]) * n + source[j], return_inverse=True)
            totals = np.zeros(len(keys), np.int64)
            np.add.at(totals, place, value)
            of, words = langs.dictionary, names.dictionary
            for key, total in zip(keys.tolist(), totals.tolist(), strict=True):
                sums[of[key // n // n].as_py(), words[key // n % n].as_py(), words[key % n].as_py()] += total
            if len(sums) >= CHUNK_PAIRS:
                yield flush()
            low = high
    yield flush()


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS, **options
) -> DataFrame:
    """``lang, source, part, item, value, rank``: per source, part ``pair`` ranks the other sources of its language by the
    divergence from them, part ``term`` the ``top`` terms that are more frequent in it than in the language."""
    own = docs.select(*[
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)
        for name, alias in ((lang, "lang"), (source, "source"), (text, "text"))
    ])
    terms = stored(term_frequencies(own, min_docs, **options), "terms")
    postings = terms.select("lang", "term", F.explode("postings").alias("x")).select("lang", "term", "x.*")
    sizes = postings.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    wholes = terms.groupBy("lang").agg(
        F.count("*").alias("v"), F.sum(F.aggregate("postings", F.lit(0).cast("long"), lambda a, x: a + x["count"])).alias("lang_n")
    )
    groups = own.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(wholes, "lang", "left")
    filled = groups.na.fill(0, ["n", "v", "lang_n"])
    # One row a source; a language without terms has no p at all, and 1 keeps its division defined.
    size, whole = F.greatest(F.col("n") + F.col("v"), F.lit(1)), F.greatest(F.col("lang_n") + F.col("v"), F.lit(1))
    filled = filled.withColumn("size", size).withColumn("whole", whole)
    groups = stored(filled.withColumn("p0", _rate(F.lit(0).cast("long"), F.col("size"))), "groups")

    rated = postings.join(groups, ["lang", "source"]).withColumn("p", _rate(F.col("count"), F.col("size")))
    return _pairs(rated, groups).unionByName(_terms(terms, groups, top))


def _terms(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    total = F.aggregate("postings", F.lit(0).cast("long"), lambda a, x: a + x["count"])
    rows = terms.select("lang", "term", total.alias("lang_count"), F.explode("postings").alias("x"))
    rows = rows.select("lang", "term", "lang_count", "x.*").join(groups, ["lang", "source"])
    rows = rows.withColumn("p", _rate(F.col("count"), F.col("size"))).withColumn("q", _rate(F.col("lang_count"), F.col("whole")))
    rows = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), _away(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    # A row per result: both sources of a pair and their rates of a term that they do not have.
    of = groups.select("lang", "source", "v", "p0")
    to = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = of.join(to, "lang").where("source <> item")
    base = pairs.select("lang", "source", "item", (F.col("v") * _away(F.col("p0"), F.col("q0"))).alias("value"))
    alike = stored(rated.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")), "alike")
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    none = _away(p0, q0)
    out = pairs.join(alike, ["lang", "source"]).select("lang", "source", "item", (F.col("terms") * (_away(p, q0) - none)).alias("value"))
    other = alike.withColumnRenamed("source", "item")
    back = pairs.join(other, ["lang", "item"]).select("lang", "source", "item", (F.col("terms") * (_away(p0, p) - none)).alias("value"))
    lists = rated.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("rated")).where("size(rated) > 1")
    both = lists.select("lang", "rated").mapInArrow(_shared_terms, _PAIRS_DDL)
    every = base.unionByName(out).unionByName(back).unionByName(both)
    return _ranked(every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).cast("int").alias("rank")
    )
