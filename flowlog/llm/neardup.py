"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document's set is its distinct shingles of five lower-cased words; a shorter text is one shingle. Its
sketch is one minwise token per coordinate. Documents with equal sets are one class, and classes are joined
by recursion: at a tree's node one coordinate is chosen, now and then two, ``1 / threshold`` on average,
and every member goes on to the child of its token there. Nodes small enough are compared exhaustively by
sketch; members that look alike are then confirmed on their full sets, recomputed from their texts. A pair
at the threshold keeps meeting with a chance that falls only slowly with depth, and independent trees
bring the chance of never meeting down to ``1 - recall``.

Links are only followed to tell classes apart: inside a node a member already connected is not compared
again, and a node passes on a spanning forest of its links, never all pairs of a group. Nodes with more
members than a task should hold are branched by shuffle; smaller ones in the task that has them. A large
node whose members are as alike on average as linked ones would never end branching, and below ``Join.levels`` the
trees no longer meet the recall: such a node is cut, and its members are joined exactly. Cut nodes of the same
texts are one group over all trees, and a member's set is read once for a group. What most of the group has cancels out: a
member is kept as its differences from that, the shingles it lacks and those few others have too. Members that differ
little link with the one that differs least; the others meet by prefixes of their differences, ordered by rarity in
the group, and are counted on whole differences, which gives the intersection of the whole sets. A group is dealt
into blocks only where its differences are more than ``Join.block``, by parts that cover all pairs of different components.

Defined results: null texts and texts without words have the empty set and link with nothing; null ids are
never the smallest id of a component unless it has no other, then its id is null and all its rows are
kept. Repeated rows are one class. An empty table gives an empty result. Equality of sets and of shingles
is equality of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlog.llm.components import connected
from flowlog.llm.storage import partitions, stored
from flowlog.llm.words import Words, hashed_words, mix, stream, windows

SHINGLE_WORDS = 5
COORDINATES = 64
_LAST = 2**63 - 1
#: Members of a group that one copy of its usual shingles is joined with.
SHARE = 50_000
_TOKENS = stream(17, COORDINATES) | np.uint64(1)
_EMPTY = -1


@dataclass(frozen=True)
class Join:
    """Parameters of the join.

    ``percent``: link if 100 * intersection >= percent * union. ``recall``: chance that a linked pair at
    the threshold meets. ``leaf``: members a node may have to be compared exhaustively. ``local``: members
    a node may have to be branched inside one task, a sketch of 256 bytes each. ``far`` and ``depth``:
    levels branched by shuffle and inside a task, ``levels`` in all at most, after which a node is cut.
    ``block``: differences of cut members that a task compares at a time.
    """

    percent: int = 85
    recall: float = 0.999
    leaf: int = 1024
    local: int = 50_000
    far: int = 8
    depth: int = 48
    block: int = 4_000_000

    @property
    def threshold(self) -> float:
        return self.percent / 100

    @property
    def trees(self) -> int:
        # a pair shares a first node with at least its similarity, and deeper ones about half as often
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold / 1.5)))

    @property
    def levels(self) -> int:
        """The deepest level at which a pair at the threshold still meets with ``recall`` in some tree.

        All trees share the sketch, so the chance is a mean over the numbers of equal tokens that it may have.
        """
        s, two = self.threshold, 1 / self.threshold - 1
        equal = range(self.likely, COORDINATES + 1)
        weights = [math.comb(COORDINATES, k) * s**k * (1 - s) ** (COORDINATES - k) for k in equal]
        never = [0.0] * len(weights)  # by equal tokens: chance that the pair meets at no node of a tree's level
        for level in range(self.far + self.depth):
            for i, k in enumerate(equal):
                miss = 1 - k / COORDINATES * (1 - never[i])
                never[i] = (1 - two) * miss + two * miss**2
            if sum(w * (1 - x**self.trees) for w, x in zip(weights, never, strict=True)) < self.recall:
                return max(1, level)
        return self.far + self.depth

    @property
    def likely(self) -> int:
        """Equal tokens two sketches need to be looked at: 3.5 standard deviations below the threshold."""
        s = self.threshold
        return math.floor(COORDINATES * s - 3.5 * math.sqrt(COORDINATES * s * (1 - s)))


def shingle_sets(words: Words, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    sizes = np.diff(words.offsets)
    sets: list[np.ndarray] = [np.empty(0, np.uint64)] * len(words)
    for length in {*np.unique(sizes[(sizes > 0) & (sizes < k)]).tolist(), k}:
        hashes, at = windows(words.hashes, words.offsets, length)
        text = np.searchsorted(words.offsets, at, side="right") - 1
        chosen = np.flatnonzero(sizes == length if length < k else sizes >= k)
        begin, end = np.searchsorted(text, chosen), np.searchsorted(text, chosen, side="right")
        for i, a, b in zip(chosen.tolist(), begin.tolist(), end.tolist(), strict=True):
            own = np.sort(hashes[a:b])
            sets[i] = own[np.append(True, own[1:] != own[:-1])]
    return sets


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number per set, equal for equal sets; ``-1`` for the empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    keys = np.full(len(sets), _EMPTY, np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        joined = np.concatenate([sets[i] for i in full])
        begin = np.cumsum(sizes[full]) - sizes[full]
        sums = np.add.reduceat(mix(joined), begin)
        found = mix(sums + sizes[full].astype(np.uint64)).view(np.int64)
        keys[full] = np.where(found == _EMPTY, 0, found)
    return keys


def sketches(sets: list[np.ndarray]) -> list[bytes | None]:
    """A minwise token of four bytes per coordinate; none for the empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out: list[bytes | None] = [None] * len(sets)
    full = np.flatnonzero(sizes)
    if len(full):
        joined = np.concatenate([sets[i] for i in full])
        begin = np.cumsum(sizes[full]) - sizes[full]
        tokens = np.empty((len(full), COORDINATES), np.uint32)
        for j, factor in enumerate(_TOKENS):
            tokens[:, j] = np.minimum.reduceat(joined * factor, begin) >> np.uint64(32)
        for i, row in zip(full.tolist(), tokens, strict=True):
            out[i] = row.tobytes()
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in hashed_words(batch["text"], lower=True):
            sets = shingle_sets(words)
            own = batch.slice(words.first, len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    own["doc_id"],
                    own["row_key"],
                    pa.array(np.fromiter(map(len, sets), np.int64, len(sets))),
                    pa.array(set_keys(sets)),
                    pa.array(sketches(sets), pa.binary()),
                ],
                ["doc_id", "row_key", "n_shingles", "cls", "sketch"],
            )


def members(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, a key of id and text, the size and class of its set, and the set's sketch."""
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        _row_key(doc_id, text).alias("row_key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return source.mapInArrow(_describe, "doc_id long, row_key long, n_shingles long, cls long, sketch binary")


def _row_key(doc_id: str, text: str):
    return F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))


def chosen(node: int, threshold: float) -> list[int]:
    """Coordinates a node branches on: one, or two so that ``1 / threshold`` is their mean."""
    draw = stream(node & 0xFFFFFFFFFFFF, 3)
    first = int(draw[0] % np.uint64(COORDINATES))
    if float(draw[1] >> np.uint64(11)) / 2**53 >= 1 / threshold - 1:
        return [first]
    return [first, (first + 1 + int(draw[2] % np.uint64(COORDINATES - 1))) % COORDINATES]


def children(nodes: np.ndarray, coordinate: int, tokens: np.ndarray) -> np.ndarray:
    return mix(nodes ^ mix(tokens.astype(np.uint64) + np.uint64((coordinate + 1) << 33)))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _roots(trees: int, threshold: float):
    roots = stream(23, trees)

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens(batch["sketch"])
            for root in roots:
                for j in chosen(int(root), threshold):
                    node = children(np.full(len(tokens), root), j, tokens[:, j])
                    yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch["cls"]], ["node", "cls"])

    return branch


def _deeper(threshold: float):
    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens(batch["sketch"])
            nodes = batch["node"].to_numpy().view(np.uint64)
            for node in np.unique(nodes):
                at = np.flatnonzero(nodes == node)
                for j in chosen(int(node), threshold):
                    found = children(nodes[at], j, tokens[at, j])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), batch["cls"].take(pa.array(at))], ["node", "cls"]
                    )

    return branch


def _shared(rows: DataFrame) -> DataFrame:
    """The rows of nodes with two members or more, with the number of members."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return stored(rows.join(sizes, "node"), "nodes")


def leaves(tokens: np.ndarray, node: int, join: Join, level: int = 1) -> Iterator[tuple[np.ndarray, bool]]:
    """Members of each small node that the branching below ``node`` ends in, and of each node that is cut (true)."""
    deepest = min(join.depth, max(0, join.levels - level))
    pending = [(np.arange(len(tokens)), node, 0)]
    while pending:
        at, key, depth = pending.pop()
        if len(at) <= join.leaf:
            yield at, False
            continue
        alike = np.zeros(len(at))  # mean share of a member's tokens that another member has
        for j in range(COORDINATES):
            _, own, n = np.unique(tokens[at, j], return_inverse=True, return_counts=True)
            alike += (n[own] - 1) / (len(at) - 1) / COORDINATES
        if depth >= deepest or alike.mean() >= join.threshold:
            yield at, True
            continue
        for j in chosen(key, join.threshold):
            own = tokens[at, j]
            order = np.argsort(own, kind="stable")
            edges = np.flatnonzero(np.diff(own[order]) != 0) + 1
            for group in np.split(order, edges):
                if len(group) > 1:
                    child = children(np.array([key], np.uint64), j, own[group[:1]])
                    pending.append((at[np.sort(group)], int(child[0]), depth + 1))


def grouped(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Component of each of ``n`` members, and links that span them.

    ``linked(u, rest)`` tells which members of ``rest`` link with ``u``. Every member is asked once, for
    those that no other has reached yet.
    """
    component = np.full(n, -1)
    rest = np.arange(n)
    spanning: list[tuple[int, int]] = []
    while len(rest):
        start, rest = int(rest[0]), rest[1:]
        component[start] = start
        queue = [start]
        while queue and len(rest):
            u = queue.pop()
            yes = linked(u, rest)
            if yes.any():
                reached, rest = rest[yes].tolist(), rest[~yes]
                component[reached] = start
                spanning += [(u, v) for v in reached]
                queue += reached
    return component, spanning


def _clusters(join: Join):
    """Groups of look-alikes in the nodes of a lot, and all members of cut nodes, each named by its members."""
    likely = join.likely

    def compare(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        node, cls, level = node[order], table["cls"].to_numpy()[order], table["level"].to_numpy()[order]
        tokens = _tokens(table["sketch"])[order]
        bounds = np.append(np.flatnonzero(np.diff(node, prepend=~node[:1])), len(node))
        sizes = np.diff(bounds)
        twos = bounds[:-1][sizes == 2]
        twos = twos[(tokens[twos] == tokens[twos + 1]).sum(1) >= likely]
        groups = list(np.stack([cls[twos], cls[twos + 1]], 1))
        whole = []
        for a, b in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2], strict=True):
            for leaf, is_cut in leaves(tokens[a:b], int(node[a]) % 2**64, join, int(level[a])):
                if is_cut:
                    whole.append(cls[a:b][leaf])
                    continue
                own = tokens[a:b][leaf]
                component, spanning = grouped(len(leaf), lambda u, rest, own=own: (own[rest] == own[u]).sum(1) >= likely)
                for root in {component[u] for u, _ in spanning}:
                    groups.append(cls[a:b][leaf[component == root]])
        cut = np.repeat([False, True], [sum(map(len, groups)), sum(map(len, whole))])
        return _named(groups + whole).append_column("cut", pa.array(cut))

    return compare


def _named(groups: list[np.ndarray]) -> pa.Table:
    """Rows of groups of classes, each group named by its members, so equal groups fold."""
    if not groups:
        return pa.table({"cluster": pa.array([], pa.int64()), "cls": pa.array([], pa.int64())})
    names = [int(mix(np.add.reduce(mix(g.view(np.uint64)), keepdims=True)).view(np.int64)[0]) for g in groups]
    return pa.table(
        {"cluster": np.repeat(np.array(names, np.int64), [len(g) for g in groups]), "cls": np.concatenate(groups)}
    )


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of some sets, each confirmed on its two whole sets."""
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    parts = np.split(codes, np.cumsum(size)[:-1])
    mark = np.zeros(int(codes.max()) + 1, np.int32)

    def linked(u: int, rest: np.ndarray) -> np.ndarray:
        yes = np.zeros(len(rest), bool)
        fits = np.flatnonzero(100 * np.minimum(size[rest], size[u]) >= percent * np.maximum(size[rest], size[u]))
        if len(fits):
            others = rest[fits]
            mark[parts[u]] = 1
            begin = np.cumsum(size[others]) - size[others]
            both = np.add.reduceat(mark[np.concatenate([parts[i] for i in others])], begin)
            mark[parts[u]] = 0
            yes[fits] = 100 * both >= percent * (size[u] + size[others] - both)
        return yes

    return grouped(len(sets), linked)[1]


def _confirm(join: Join):
    """Spanning forests of the links in the clusters of a lot, confirmed on the full sets."""

    def links(table: pa.Table) -> pa.Table:
        cluster, cls = table["cluster"].to_numpy(), table["cls"].to_numpy()
        order = np.argsort(cluster, kind="stable")
        cluster, cls = cluster[order], cls[order]
        texts = table["text"].combine_chunks().take(pa.array(order))
        sets: list[np.ndarray] = []
        for words in hashed_words(texts, lower=True):
            sets += shingle_sets(words)
        bounds = np.append(np.flatnonzero(np.diff(cluster, prepend=~cluster[:1])), len(cluster))
        left, right = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a < 2:
                continue
            for u, v in spanning_links(sets[a:b], join.percent):
                left.append(cls[a + u])
                right.append(cls[a + v])
        return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})

    return links


def _rows_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The texts of the smallest ids of the wanted classes."""
    number, words = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")
    ids = wanted.select(F.coalesce("first_doc", F.lit(_LAST)).alias("id")).distinct()
    return docs.select(F.coalesce(number, F.lit(_LAST)).alias("id"), words.alias("text")).join(ids, "id", "left_semi")


def _texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One text for each wanted class, looked up by the class's smallest id and told by its set."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in hashed_words(batch["text"], lower=True):
                own = batch["text"].slice(w.first, len(w))
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(shingle_sets(w))), own], ["cls", "text"])

    return _rows_of(docs, wanted, doc_id, text).mapInArrow(keyed, "cls long, text string")


def _sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The set of each wanted class, now and then more than once, besides those of classes with the same id."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in hashed_words(batch["text"], lower=True):
                sets = shingle_sets(w)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(sets)), lists], ["cls", "shingles"])

    return _rows_of(docs, wanted, doc_id, text).mapInArrow(keyed, "cls long, shingles array<long>")


def _confirmed(
    docs: DataFrame, classes: DataFrame, clusters: DataFrame, join: Join, doc_id: str, text: str
) -> DataFrame:
    """Links that span the components of each cluster."""
    wanted = classes.select("cls", "first_doc").join(clusters.select("cls").distinct(), "cls", "left_semi")
    texts = _texts_of(docs, wanted, doc_id, text)
    once = texts.join(wanted.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text"))
    lots = F.lit(8 * partitions(docs.sparkSession))
    links = (
        clusters.join(once, "cls")
        .groupBy(F.pmod("cluster", lots).alias("lot"))
        .applyInArrow(_confirm(join), "u long, v long")
    )
    return stored(links, "links")


def _differences(
    docs: DataFrame, classes: DataFrame, cut: DataFrame, labels: DataFrame, join: Join, doc_id: str, text: str
) -> DataFrame:
    """Members of groups of cut nodes that are still in different components, by their differences.

    The usual shingles ``R`` of a group are those that more than half of its members have, so there are at most twice as
    many as an average member has. ``excess`` is ``(100 + percent) * |set xor R| - (100 - percent) * |set|``: two
    members link if ``2 * (100 + percent)`` times the number of differences they share is at least the sum of
    theirs. ``tokens`` are the differences that can be shared: usual shingles the member lacks, and others that
    two members or more have.
    """
    # A cut node goes to the least of the least members of all cut nodes that share a member with it: nodes of the same
    # texts come together, and every node stays whole, so a member may be in more groups than one.
    heads = cut.groupBy("cluster").agg(F.min("cls").alias("head"))
    least = cut.join(heads, "cluster").groupBy("cls").agg(F.min("head").alias("head"))
    groups = cut.join(least, "cls").groupBy("cluster").agg(F.min("head").alias("group"))
    placed = (
        cut.join(groups, "cluster")
        .select("cls", "group")
        .distinct()
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "group", F.coalesce("root", "cls").alias("root"))
    )
    placed = stored(placed, "placed")
    several = placed.groupBy("group").agg(
        F.count("*").alias("members"), F.min("root").alias("least"), F.max("root").alias("most")
    )
    placed = placed.join(several.where("least < most").select("group", "members"), "group")
    wanted = classes.select("cls", "first_doc").join(placed.select("cls"), "cls", "left_semi")
    sets = _sets_of(docs, wanted, doc_id, text).join(placed, "cls").dropDuplicates(["group", "cls"])
    sets = stored(sets, "sets")
    single = sets.select("group", "members", "cls", F.explode("shingles").alias("shingle"))
    counts = single.groupBy("group", "members", "shingle").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts, "shared")

    copies = F.ceil(F.col("members") / SHARE)
    usual = (
        counts.where("2 * n > members")
        .groupBy("group", "members")
        .agg(
            F.count("*").alias("usual"),
            F.collect_list(F.when(F.col("n") < F.col("members"), F.col("shingle"))).alias("often"),
        )
        .select("group", "usual", "often", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))
    )
    seldom = counts.where("2 * n <= members").select("group", "shingle")
    own = single.join(seldom, ["group", "shingle"]).groupBy("group", "cls").agg(F.collect_list("shingle").alias("own"))
    none = F.array().cast("array<long>")
    size, lacks = F.size("shingles").cast("long"), F.array_except(F.coalesce("often", none), "shingles")
    differ = F.col("n") - F.coalesce("usual", F.lit(0)) + 2 * F.size("lacks")
    found = (
        sets.withColumn("copy", F.pmod("cls", copies))
        .join(usual, ["group", "copy"], "left")
        .join(own, ["group", "cls"], "left")
        .select("group", "cls", "root", "own", "usual", size.alias("n"), lacks.alias("lacks"))
        .select(
            "group",
            "cls",
            "root",
            ((100 + join.percent) * differ - (100 - join.percent) * F.col("n")).alias("excess"),
            F.concat("lacks", F.coalesce("own", none)).alias("tokens"),
        )
    )
    return stored(found, "differences")


def _blocks(rooted: DataFrame, block: int) -> DataFrame:
    """Blocks of about ``block`` differences in which any two members of a group of different components meet.

    Members outside a group's largest component meet each other and those in it; these need not meet
    among themselves.
    """
    counts = rooted.groupBy("group", "root").agg(F.sum(F.size("tokens") + 1).alias("n"))
    largest = counts.groupBy("group").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"))
    half = max(1, block // 2)
    split = largest.where("n > top.n").select(
        "group",
        F.col("top.root").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / half).alias("outer"),
        F.ceil(F.col("top.n") / half).alias("inner"),
    )
    draw = F.xxhash64("cls")
    outer, inner = (F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("outer", "inner"))
    own_outer, own_inner = F.pmod(draw, F.col("outer")), F.pmod(draw, F.col("inner"))
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    among = F.transform(outer, lambda j: pair(F.least(own_outer, j), F.greatest(own_outer, j)))
    across = F.transform(inner, lambda j: pair(own_outer, -1 - j))
    to_outer = F.transform(outer, lambda i: pair(i, -1 - own_inner))
    apart = F.col("root") != F.col("top")
    met = F.explode(F.when(apart, F.concat(among, across)).otherwise(to_outer))
    rows = rooted.join(split, "group").select("group", "cls", "root", "excess", "tokens", apart.alias("apart"), met.alias("at"))
    return rows.select(F.xxhash64("group", "at.a", "at.b").alias("block"), "cls", "root", "excess", "tokens", "apart")


def difference_links(
    tokens: list[np.ndarray], excess: np.ndarray, root: np.ndarray, apart: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that span the components of the members of a block, where one of the two is ``apart``.

    A pair must share ``(excess + excess) / (2 * (100 + percent))`` differences, at least one. Prefixes are as long as
    the smallest excess of the block asks for.
    """
    unit = 2 * (100 + percent)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    _, codes, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(tokens)), size)
    both = counts[codes] > 1
    owner, rank = owner[both], np.argsort(np.argsort(counts, kind="stable"), kind="stable")[codes[both]]
    order = np.lexsort((rank, owner))
    owner, rank = owner[order], rank[order]
    size = np.bincount(owner, minlength=len(tokens))
    begin = np.cumsum(size) - size

    asked = np.maximum(1, -(-(excess + excess.min()) // unit))
    prefix = np.maximum(0, size - asked + 1)
    held = np.flatnonzero(np.arange(len(owner)) - begin[owner] < prefix[owner])
    held = held[np.argsort(rank[held], kind="stable")]
    posted, posted_rank = owner[held], rank[held]
    first = np.searchsorted(posted_rank, np.arange(len(counts) + 1))

    mark = np.zeros(len(counts), bool)
    _, component = np.unique(root, return_inverse=True)
    component = component.copy()
    spanning: list[tuple[int, int]] = []
    for u in np.flatnonzero(apart & (prefix > 0)).tolist():
        met = [posted[first[r] : first[r + 1]] for r in rank[begin[u] : begin[u] + prefix[u]].tolist()]
        others = np.unique(np.concatenate(met))
        others = others[(component[others] != component[u]) & (~apart[others] | (others > u))]
        need = np.maximum(1, -(-(excess[others] + excess[u]) // unit))
        fits = np.minimum(size[others], size[u]) >= need
        others, need = others[fits], need[fits]
        if not len(others):
            continue
        n = size[others]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(begin[others] - (ends - n), n)
        mark[rank[begin[u] : begin[u] + size[u]]] = True
        shared = np.add.reduceat(mark[rank[at]].astype(np.int64), ends - n)
        mark[rank[begin[u] : begin[u] + size[u]]] = False
        for v in others[shared >= need].tolist():
            if component[u] != component[v]:
                component[component == component[v]] = component[u]
                spanning.append((u, v))
    return spanning


def _by_differences(join: Join):
    """The spanning links of a block."""

    def links(table: pa.Table) -> pa.Table:
        lists = table["tokens"].combine_chunks()
        tokens = np.split(lists.flatten().to_numpy(), lists.value_lengths().to_numpy().cumsum()[:-1])
        excess, root, apart = (table[c].to_numpy() for c in ("excess", "root", "apart"))
        found = np.array(difference_links(tokens, excess, root, apart, join.percent), np.int64).reshape(-1, 2)
        cls = table["cls"].to_numpy()
        return pa.table({"u": cls[found[:, 0]], "v": cls[found[:, 1]]})

    return links


def _linked(differences: DataFrame, join: Join) -> DataFrame:
    """Links that span the components of cut members."""
    least = differences.groupBy("group").agg(F.min(F.struct("excess", "cls", "root")).alias("least"))
    # Two members whose excess is 0 or less together link whatever they share, and so do both with the least one.
    near = F.col("excess") + F.col("least.excess") <= 0
    rooted = differences.join(least, "group")
    close = rooted.where(near & (F.col("cls") != F.col("least.cls"))).select(
        F.col("cls").alias("u"), F.col("least.cls").alias("v")
    )
    able = 2 * (100 + join.percent) * F.size("tokens").cast("long") >= F.col("excess") + F.col("least.excess")
    rooted = rooted.where(able & (F.size("tokens") > 0)).withColumn("root", F.when(near, F.col("least.root")).otherwise(F.col("root")))
    blocks = _blocks(stored(rooted.select("group", "cls", "root", "excess", "tokens"), "able"), join.block)
    met = blocks.groupBy("block").applyInArrow(_by_differences(join), "u long, v long")
    return stored(close.unionByName(met), "links")


def _labels(docs: DataFrame, classes: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """``(node, root)`` for each class that links with another."""
    spark = docs.sparkSession
    sketched = classes.select("cls", "sketch")
    nodes = _shared(sketched.mapInArrow(_roots(join.trees, join.threshold), "node long, cls long"))
    small = nodes.where(F.col("size") <= join.local).withColumn("level", F.lit(1))
    large = nodes.where(F.col("size") > join.local)
    for level in range(2, min(join.far + 1, join.levels) + 1):
        if large.isEmpty():
            break
        below = large.join(sketched, "cls").mapInArrow(_deeper(join.threshold), "node long, cls long")
        nodes = _shared(below.distinct())
        small = small.unionByName(nodes.where(F.col("size") <= join.local).withColumn("level", F.lit(level)))
        large = nodes.where(F.col("size") > join.local)
    lots = F.lit(8 * partitions(spark))
    found = (
        small.join(sketched, "cls")
        .groupBy(F.pmod("node", lots).alias("lot"))
        .applyInArrow(_clusters(join), "cluster long, cls long, cut boolean")
        .unionByName(large.select(F.col("node").alias("cluster"), "cls", F.lit(True).alias("cut")))
        .distinct()
    )
    found = stored(found, "clusters")
    clusters, cut = found.where("not cut").drop("cut"), found.where("cut").drop("cut")
    labels = connected(_confirmed(docs, classes, clusters, join, doc_id, text))
    if cut.isEmpty():
        return labels
    more = _linked(_differences(docs, classes, cut, labels, join, doc_id, text), join)
    return connected(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))


def _components(docs: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """Per row: id, key, size and class of the set, and the smallest class and id of its component."""
    rows = stored(members(docs, doc_id, text), "members")
    classes = stored(
        rows.where("n_shingles > 0")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("first_doc"), F.first("sketch").alias("sketch")),
        "classes",
    )
    labels = _labels(docs, classes, join, doc_id, text)
    rooted = (
        classes.select("cls", "first_doc")
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "first_doc", F.coalesce("root", "cls").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    found = rooted.select("cls", "root").join(least, "root")
    return rows.select("doc_id", "row_key", "n_shingles", "cls").join(found, "cls", "left")


def near_duplicates(
    docs: DataFrame, join: Join = Join(), doc_id: str = "doc_id", text: str = "text"  # noqa: B008
) -> DataFrame:
    """One row per document: size of its set, smallest id it can be reached from, and whether it is that."""
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        _components(docs, join, doc_id, text)
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def drop_near_duplicates(
    docs: DataFrame, join: Join = Join(), doc_id: str = "doc_id", text: str = "text"  # noqa: B008
) -> DataFrame:
    """The documents, one of each component: that with the smallest id. Texts without words all stay."""
    rows = _components(docs, join, doc_id, text)
    last = F.coalesce("doc_id", F.lit(_LAST))
    first = rows.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(last, "row_key")).alias("x"))
    keys = first.select("x.row_key").unionByName(rows.where("n_shingles = 0").select("row_key")).distinct()
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key(doc_id, text).alias("row_key")
    )
    kept = keyed.join(keys, "row_key", "left_semi")
    repeated = rows.where("n_shingles > 0").groupBy("row_key").count().where("count > 1")
    if not repeated.isEmpty():  # equal rows of one class: one of them
        twice = repeated.select("row_key")
        once = kept.join(twice, "row_key", "left_semi").groupBy("row_key").agg(F.first("row").alias("row"))
        kept = kept.join(twice, "row_key", "left_anti").unionByName(once)
    return kept.select("row.*")
