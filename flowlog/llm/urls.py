"""URL filters: host and path rules, and an exact host list kept as a Bloom filter cascade.

The cascade answers membership without a join. Its first level is a Bloom filter of the listed keys; the
second one holds the keys of the universe that the first takes for listed, the third the listed keys
that the second takes for unlisted, and so on until a level makes no mistake. As the universe is
complete, every answer about one of its keys is exact. The key space is cut into shards by hash; a shard's
cascade is built in one task from ``SHARD_KEYS`` keys on average, and shards are sent to the rows in lots
of at most ``LOT_BYTES``, one pass over the rows for each lot.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is in no
list. A null key is never listed. Repeated keys are one. Keys are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlog.llm.storage import stored
from flowlog.llm.words import mix, stream

SHARD_KEYS = 250_000
LOT_BYTES = 64 << 20
#: False positives of the first level and of the others.
FIRST_RATE, NEXT_RATE = 0.05, 0.5
_MAX_LEVELS = 64
_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _HOST_PATH, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _HOST_PATH, 2), F.lit(""))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits as ``struct<rule, verdict>``, null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        own = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), own).otherwise(found)
    return found


def _slots(first: np.ndarray, second: np.ndarray, level: int, bits: int, hashes: int) -> Iterator[np.ndarray]:
    salt = stream(500 + level, 2)
    a, b = mix(first ^ salt[0]), mix(second ^ salt[1]) | np.uint64(1)
    for _ in range(hashes):
        yield (a % np.uint64(bits)).astype(np.int64)
        a = a + b


def _encode(first: np.ndarray, second: np.ndarray, level: int, rate: float) -> dict:
    bits = max(64, int(np.ceil(-len(first) * np.log(rate) / np.log(2) ** 2)))
    hashes = max(1, round(bits / max(1, len(first)) * np.log(2)))
    hashes = min(hashes, 16)
    field = np.zeros(bits, bool)
    for slot in _slots(first, second, level, bits, hashes):
        field[slot] = True
    return {"level": level, "bits": bits, "hashes": hashes, "field": np.packbits(field, bitorder="little").tobytes()}


def passes(row: dict, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which keys a level's filter holds, wrongly or not."""
    field = np.frombuffer(row["field"], np.uint8)
    found = np.ones(len(first), bool)
    for slot in _slots(first, second, row["level"], row["bits"], row["hashes"]):
        found &= (field[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
    return found


def build(first: np.ndarray, second: np.ndarray, listed: np.ndarray) -> list[dict]:
    """The levels over one shard's complete keys."""
    levels: list[dict] = []
    encoded, others = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(encoded):
        level = len(levels)
        if level == _MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have equal hashes")
        row = _encode(first[encoded], second[encoded], level, NEXT_RATE if level else FIRST_RATE)
        levels.append(row)
        wrong = others[passes(row, first[others], second[others])]
        encoded, others = wrong, encoded
    return levels


def member(levels: list[dict], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Exact for keys of the universe: listed if the last level in a row that holds the key is an even one."""
    depth = np.zeros(len(first), np.int64)
    inside = np.arange(len(first))
    for row in levels:
        inside = inside[passes(row, first[inside], second[inside])]
        depth[inside] += 1
    return depth % 2 == 1


_LEVELS_DDL = "shard long, level long, bits long, hashes long, field binary"


def _build_shard(table: pa.Table) -> pa.Table:
    first, second = (table[c].to_numpy().view(np.uint64) for c in ("first", "second"))
    levels = build(first, second, table["listed"].to_numpy())
    shard = table["shard"][0].as_py()
    names = ["shard", "level", "bits", "hashes", "field"]
    rows = [{"shard": shard} | row for row in levels]
    return pa.Table.from_pylist(rows, pa.schema([(n, pa.int64()) for n in names[:4]] + [("field", pa.binary())]))


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("first"), F.xxhash64(F.lit("second"), key).alias("second")]


@dataclass
class Cascade:
    """Levels of all shards as a written table; ``shards`` is how the key space is cut."""

    levels: DataFrame
    shards: int

    def lots(self, lot_bytes: int = LOT_BYTES) -> list[list[int]]:
        """Shards in lots of at most ``lot_bytes``, one shard at least."""
        sizes = self.levels.groupBy("shard").agg(F.sum(F.length("field")).alias("n")).orderBy("shard").collect()
        lots: list[list[int]] = []
        size = 0
        for row in sizes:
            if not lots or size + row["n"] > lot_bytes:
                lots.append([])
                size = 0
            lots[-1].append(row["shard"])
            size += row["n"]
        return lots


def cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """From ``universe (key, listed)``, each key once or with one value; null keys are left out."""
    keys = universe.where("key IS NOT NULL").select(*_hashed(F.col("key")), F.coalesce("listed", F.lit(False)).alias("listed"))
    keys = stored(keys.groupBy("first", "second").agg(F.bool_or("listed").alias("listed")), "universe")
    shards = max(1, -(-keys.count() // shard_keys))
    dealt = keys.withColumn("shard", F.pmod("first", F.lit(shards)).cast("long"))
    levels = dealt.groupBy("shard").applyInArrow(_build_shard, _LEVELS_DDL)
    return Cascade(stored(levels, "cascade"), shards)


def _listed(shared, shards: int):
    def judge(first: pa.Array, second: pa.Array) -> pa.Array:
        a, b = first.to_numpy().view(np.uint64), second.to_numpy().view(np.uint64)
        shard = first.to_numpy() % shards
        out = np.zeros(len(a), bool)
        for own in np.unique(shard):
            if levels := shared.value.get(int(own)):
                at = np.flatnonzero(shard == own)
                out[at] = member(levels, a[at], b[at])
        return pa.array(out)

    return F.arrow_udf(judge, "boolean")


def with_listed(rows: DataFrame, key: str, filters: Cascade, name: str = "listed", lot_bytes: int = LOT_BYTES) -> DataFrame:
    """``rows`` with whether ``key`` is listed; exact for keys of the universe, false for null."""
    spark = rows.sparkSession
    lots = filters.lots(lot_bytes)
    if not lots:
        return rows.withColumn(name, F.lit(False))
    own = F.col(f"`{key}`")
    of_lot = {shard: i for i, lot in enumerate(lots) for shard in lot}
    parts = []
    for i, lot in enumerate(lots):
        levels: dict[int, list[dict]] = {}
        for row in filters.levels.where(F.col("shard").isin(lot)).orderBy("shard", "level").collect():
            levels.setdefault(row["shard"], []).append(row.asDict())
        judge = _listed(spark.sparkContext.broadcast(levels), filters.shards)
        part = rows
        if len(lots) > 1:  # a shard without listed keys is in no lot: the first pass has its rows
            shard = F.pmod(F.xxhash64(own), F.lit(filters.shards))
            mine = shard.isin([s for s, l in of_lot.items() if l == i])
            part = rows.where(mine if i else mine | ~shard.isin(list(of_lot)))
        parts.append(part.withColumn(name, F.when(own.isNull(), False).otherwise(judge(*_hashed(own)))))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: host, path, the rule that fits, and the verdict.

    A page that no rule fits is blocked if its host is listed. Listed are the hosts of which the rules
    block at least half of the pages; the universe is the hosts of all pages.
    """
    link = F.col(f"`{url}`").cast("string")
    parts = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"))
    ruled = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.count_if(F.col("fit.verdict") == "block")
    hosts = ruled.where("host <> ''").groupBy(F.col("host").alias("key")).agg((blocked * 2 >= F.count("*")).alias("listed"))
    found = with_listed(ruled, "host", cascade(hosts))
    verdict = F.coalesce("fit.verdict", F.when((F.col("host") != "") & F.col("listed"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
