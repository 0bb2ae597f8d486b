"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a Boolean column over a document's text and words. On a sample, every rule is timed and its
rejections are counted; the cascade then asks the rules in the order of rejections per second and leaves
a document at its first rejection. The order changes the cost, never the verdict: a document is kept if
no rule rejects it.

Null and empty texts have no words and are rejected as too short. Columns of the input are kept,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlog.llm.storage import stored
from flowlog.llm.words import WORD

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Times a sampled document is judged for the estimate of a rule's cost.
REPEATS = 8
#: Characters that mark up rather than spell.
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once and only if the result is asked for."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda line: line.rlike(WORD))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more in the text, its first place included.

    Windows are compared by 64-bit hashes. Sorting hashes with their places puts equal windows side by
    side; the places of such windows, sorted, cover ``min(window, next place - place)`` words each.
    """

    def places(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda e, i: F.struct(
                                e["i"].alias("i"),
                                (
                                    F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                                    | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
                                ).alias("twice"),
                            ),
                        ),
                        lambda e: e["twice"],
                    ),
                    lambda e: e["i"],
                )
            ),
        )

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(window)), F.lit(window))),
            F.lit(0).cast("long"),
            lambda total, n: total + n,
        )

    def counted(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[w[i + k] for k in range(window)])
        )
        return let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
                let(places(h), covered)
            ),
        )

    return let(words, lambda w: F.when(F.size(w) < window, F.lit(0).cast("long")).otherwise(counted(w)))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is true for a document that has to go, and never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


def too_few_words(text: Column, words: Column) -> Column:
    return F.size(words) < MIN_WORDS


def repeats_windows(text: Column, words: Column) -> Column:
    return n_repeat_words(words) * 100 > F.size(words) * MAX_REPEATED_PERCENT


def many_symbols(text: Column, words: Column) -> Column:
    return n_symbols(text) * 10 > F.size(words) * 4


def many_exclamations(text: Column, words: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("!")) * 10 > F.size(words) * 4


def repeats_lines(text: Column, words: Column) -> Column:
    return let(
        lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))) * 100 > F.size(x) * 40
    )


def odd_word_length(text: Column, words: Column) -> Column:
    return (word_chars(words) < F.size(words) * 2) | (word_chars(words) > F.size(words) * 20)


#: What every document has to meet, and what more the cascade asks of it.
BASE_RULES = (Rule("too_few_words", too_few_words), Rule("repeats_windows", repeats_windows))
MORE_RULES = (
    Rule("many_symbols", many_symbols),
    Rule("many_exclamations", many_exclamations),
    Rule("repeats_lines", repeats_lines),
    Rule("odd_word_length", odd_word_length),
)
RULES = BASE_RULES + MORE_RULES


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: int

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def estimate(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", fraction: float = 0.02, rows: int = 500
) -> list[Estimate]:
    """Time and rejections of each rule on at most ``rows`` sampled documents, best gain first.

    Every document is judged ``REPEATS`` times, for a time that can be told from that of an idle job. Only
    the order of the cascade depends on it. Ties keep the order given.
    """
    sample = stored(docs.select(F.col(f"`{text}`").alias("text")).sample(fraction, seed=7).limit(rows), "sample")
    again = F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))
    sample = sample.withColumn("words", split_words(F.col("text"))).withColumn("again", again)

    def seconds(rejects: Column) -> tuple[float, int]:
        asked = sample.agg(F.count_if(rejects).alias("n"), F.sum(F.size("words") + F.col("again")).alias("w"))
        asked.collect()
        start = time.perf_counter()
        n = asked.collect()[0]["n"]
        return time.perf_counter() - start, n // REPEATS

    idle, _ = seconds(F.lit(False))
    found = []
    for rule in rules:
        took, rejected = seconds(rule.rejects(F.col("text"), F.col("words")))
        found.append(Estimate(rule, max(took - idle, 1e-4), rejected))
    return sorted(found, key=lambda e: -e.gain)


def first_rejection(text: Column, words: Column, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not computed."""
    verdict = F
    for rule in rules:
        verdict = verdict.when(rule.rejects(text, words), F.lit(rule.name))
    return F.lit(None).cast("string") if verdict is F else verdict


def quality_filter(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    order = [e.rule for e in estimate(docs, rules, text)]
    source = F.col(f"`{text}`")
    # The words are bound, so that they are split once however many rules read them.
    return docs.where(let(split_words(source), lambda words: first_rejection(source, words, order)).isNull())


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its measures, whether it fails a base rule, and the cascade's verdict."""
    order = [e.rule for e in estimate(docs, MORE_RULES, text)]
    t, w = F.col("text"), F.col("words")
    measured = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        split_words(F.col(f"`{text}`")).alias("words"),
    ).select(
        "doc_id",
        "text",
        "words",
        F.size(w).cast("long").alias("n_words"),
        word_chars(w).alias("word_chars"),
        n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"),
        n_repeat_words(w).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    measures = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measured.withColumn("base_failed", failed).select(
        *measures,
        "base_failed",
        F.when(F.col("base_failed"), False).otherwise(first_rejection(t, w, order).isNull()).alias("kept"),
    )
