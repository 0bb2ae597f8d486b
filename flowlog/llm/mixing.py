"""Mixing sources to target weights by hash-threshold histograms.

Every document has a size in words and a hash of its source and id. A source's target is met with
whole copies of all its documents and, for the rest, with those documents whose hash lies below a threshold. The
threshold is found without sorting: sizes are summed by source and hash bucket, the running sum tells
the bucket in which the rest is used up, and only that bucket's documents are summed again by their next
bits, until it holds one hash. The document at the boundary is taken if that comes nearer to the target.
Thresholds are nested: a larger target takes a superset of the documents.

Targets share the total size by the weights; a source stops at ``MAX_COPIES`` times its size, and what it
cannot take is shared again by the weights of the others.

Defined results: null and empty texts have size 0 and are taken 0 words. A null source is a source of its
own, after all others. Rows of equal source and id, repeated or with null id, have one hash and are taken
or left together. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlog.llm.storage import stored
from flowlog.llm.words import WORD

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
HASH_BITS = 60
#: Bits a histogram resolves; a source has at most 2 ** LEVEL_BITS buckets at a time.
LEVEL_BITS = 10
#: Tasks that rank the sources.
RANK_PARTS = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(source: Column, doc_id: Column) -> Column:
    """60 bits of the MD5 of source and id, a null told from an empty name."""
    name = F.concat(F.coalesce(F.concat(F.lit("s"), source), F.lit("")), F.lit("|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` of each source by code point, null last, without bringing all to one task."""
    spread = sources.repartitionByRange(RANK_PARTS, F.col("source").isNull(), F.col("source"))
    spread = stored(spread.withColumn("part", F.spark_partition_id()), "sources")
    counts = dict(sorted((r["part"], r["n"]) for r in spread.groupBy("part").agg(F.count("*").alias("n")).collect()))
    if not counts:
        return spread.select("*", F.lit(0).alias("rank")).drop("part")
    before = zip(counts, accumulate([0, *counts.values()]), strict=False)
    offset = F.create_map(*[F.lit(x) for pair in before for x in pair])[F.col("part")]
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return spread.withColumn("rank", offset + F.row_number().over(order) - 1).drop("part")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, its size and its target, after what capped sources leave is shared by the others."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(ranked(sources).withColumn("weight", weight), "weights")
    cap = F.col("source_size") * MAX_COPIES
    level, before = 0.0, -1
    while True:  # the level only rises, and each round caps at least one more source
        capped = cap < F.lit(level) * F.col("weight")
        total, taken, free, n = sources.agg(
            F.sum("source_size"),
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count_if(capped),
        ).collect()[0]
        if n == before or not free:
            break
        before, level = n, (total - taken) / free
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source its whole copies and the hash below which a document is taken once more."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = wanted.withColumn("copies", F.least(copies, F.lit(MAX_COPIES)).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = stored(plan, "plan")
    # below: words of the documents under the boundary; low: the first hash of the boundary's bucket
    zero = F.lit(0).cast("long")
    bounds = plan.where("rest > 0").select("source", "rest", zero.alias("low"), zero.alias("below"))
    docs = sized
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        buckets = docs.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("hash").alias("first"), F.max("hash").alias("last")
        )
        up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        summed = buckets.withColumn("before", F.coalesce(F.sum("size").over(up_to), zero))
        before = bounds.select("source", "rest", "low", "below").alias("b")
        crossed = summed.alias("s").join(before, F.expr("s.source <=> b.source")).where(
            "below + before < rest AND rest <= below + before + size"
        )
        bounds = stored(
            crossed.select(
                "b.source",
                "rest",
                F.shiftleft("bucket", shift).alias("low"),
                (F.col("below") + F.col("before")).alias("below"),
                "size",
                "first",
                "last",
            ),
            "bounds",
        )
        if bounds.where("first < last").isEmpty():
            break
        same = F.shiftright("hash", shift) == F.shiftright("low", shift)
        near = docs.alias("d").join(bounds.alias("b"), F.expr("d.source <=> b.source") & same)
        docs = stored(near.select("d.source", "d.size", "hash"), "boundary")
    taken = (F.col("rest") - F.col("below")) * 2 >= F.col("size")
    cut = bounds.select("source", (F.col("first") + taken.cast("long")).alias("cut"))
    return (
        plan.alias("p")
        .join(cut.alias("c"), F.expr("p.source <=> c.source"), "left")
        .select("p.source", "source_size", "target", "copies", F.coalesce("cut", F.lit(0)).cast("long").alias("cut"))
    )


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    own = F.col(f"`{source}`").cast("string")
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        own.alias("source"),
        size_of(F.col(f"`{text}`").cast("string")).alias("size"),
        hash_of(own, F.col(f"`{doc_id}`")).alias("hash"),
    )


def mix_table(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words the mix takes of it."""
    sized = stored(sizes(docs, **columns), "sizes")
    plan = stored(thresholds(sized, targets(sized)), "thresholds")
    joined = sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
    copies = F.col("copies") + (F.col("hash") < F.col("cut")).cast("long")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents the mix takes, with ``copies``, how often it takes each; the others go. A ``copies`` of the input is replaced."""
    sized = stored(sizes(docs, doc_id, text, source), "sizes")
    plan = stored(thresholds(sized, targets(sized)), "thresholds")
    own = F.col(f"`{source}`").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        own.alias("source"),
        hash_of(own, F.col(f"`{doc_id}`")).alias("hash"),
    )
    joined = rows.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
    copies = F.col("copies") + (F.col("hash") < F.col("cut")).cast("long")
    taken = joined.withColumn("times", copies).where(F.col("times") > 0)
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "copies"], F.col("times").alias("copies"))
