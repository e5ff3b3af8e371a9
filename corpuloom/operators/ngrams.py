"""N-gram counts and the algebra of count tables (ngram, cnt)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<s>", "</s>"


def each_ngram(rows: DataFrame, words: str = "words", n: int = 2, *others: str) -> DataFrame:
    """(others, ngram): a row an n-gram. A line of m > 0 words has m + 1: n - 1 marks stand before, one behind.

    The places are exploded and the words taken by their place, so that all of it is compiled code.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    padded = F.concat(F.array_repeat(F.lit(BEGIN), n - 1), F.col(words), F.array(F.lit(END)))
    placed = rows.where(F.size(words) > 0).select(*others, padded.alias("__p"))
    placed = placed.select(*others, "__p", F.explode(F.sequence(F.lit(0), F.size("__p") - n)).alias("__k"))
    return placed.select(*others, F.concat_ws(" ", *(F.get("__p", F.col("__k") + j) for j in range(n))).alias("ngram"))


def ngram_counts(rows: DataFrame, words: str = "words", n: int = 2) -> DataFrame:
    """(ngram, cnt) over all rows with at least one word. Counted map-side first: a frequent n-gram is one row a task."""
    return each_ngram(rows, words, n).groupBy("ngram").agg(F.count("*").alias("cnt"))


def total(counts: DataFrame) -> DataFrame:
    """One row: the grand total of a count table."""
    return counts.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("total"))


def at_least(counts: DataFrame, threshold: int = 5) -> DataFrame:
    """Rows of a count table with a count of at least threshold."""
    return counts.where(F.col("cnt") >= threshold)


def filtered_with_total(counts: DataFrame, threshold: int = 5) -> tuple[DataFrame, DataFrame]:
    kept = at_least(counts, threshold)
    return kept, total(kept)


def merge(*tables: DataFrame, keys: tuple[str, ...] = ("ngram",)) -> DataFrame:
    """The sum of count tables; the order of rows and tables doesn't matter."""
    return reduce(DataFrame.unionByName, tables).groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def in_key_order(counts: DataFrame, *keys: str) -> DataFrame:
    """Ascending by the bytes of the key."""
    return counts.orderBy(*(keys or ("ngram",)))


def by_frequency(counts: DataFrame) -> DataFrame:
    """Most frequent first; equal counts by key, descending."""
    return counts.orderBy(F.desc("cnt"), F.desc("ngram"))


def top(counts: DataFrame, k: int) -> DataFrame:
    """The first k rows of by_frequency(): a top-k, no full sort."""
    return by_frequency(counts).limit(k)


def check_total(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """One row (expected, actual, matches) that compares a header's total with the sum of the counts."""
    return expected.select(F.col("total").alias("expected")).crossJoin(total(counts).select(F.col("total").alias("actual"))).withColumn("matches", F.col("expected") == F.col("actual"))


def dictionary(counts: DataFrame) -> DataFrame:
    """(word, cnt) of a unigram table; repeated words add up."""
    return counts.groupBy(F.col("ngram").alias("word")).agg(F.sum("cnt").alias("cnt"))


#: What may be broadcast: as many bytes of words, counted before, whatever the number of rows.
MOST_BROADCAST = 64 << 20


def hint_if_small(words: DataFrame, column: str, most_bytes: int = MOST_BROADCAST) -> DataFrame:
    """words, to be broadcast if its column and 16 bytes a row were counted to be at most most_bytes; else joined by a shuffle."""
    size = words.agg(F.sum(F.octet_length(column) + F.lit(16)).cast("long")).first()[0] or 0
    return F.broadcast(words) if size <= most_bytes else words
