"""How strongly word v goes with word w: C_wv N^2 / (C_w^2 C_v), also in units of that of w with itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuloom.operators.ngrams import MOST_BROADCAST, hint_if_small

def two_words(counts: DataFrame, key: str = "ngram") -> DataFrame:
    """(w, v, cnt) of a count table's rows whose key is exactly two words."""
    parts = F.filter(F.split(key, r"[ \t\n\x0B\f\r]+", -1), lambda x: x != "")
    return counts.withColumn("__p", parts).where(F.size("__p") == 2).select(F.col("__p")[0].alias("w"), F.col("__p")[1].alias("v"), "cnt")


def score(cnt: Column, n: Column, c_w: Column, c_v: Column) -> Column:
    """mi, of doubles: n * n alone would overflow a long."""
    return cnt * n * n / (c_w * c_w * c_v)


def association(pairs: DataFrame, unigrams: DataFrame, total: int, cutoff: int = 0, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(norm_mi, mi, cnt, w, v) of pairs whose words are both in the dictionary with at least cutoff occurrences.

    norm_mi is mi over that of (w, w): null where that pair isn't there. pairs and unigrams are read twice: give tables.
    The dictionary is broadcast if it was counted to hold at most most_broadcast bytes.
    """
    words = unigrams.where(F.col("cnt") >= cutoff)
    small = hint_if_small(words, "word", most_broadcast) is not words
    hint = F.broadcast if small else (lambda df: df)
    left = hint(words.select(F.col("word").alias("w"), F.col("cnt").cast("double").alias("c_w")))
    right = hint(words.select(F.col("word").alias("v"), F.col("cnt").cast("double").alias("c_v")))
    n = F.lit(float(total))
    scored = pairs.join(left, "w").join(right, "v").withColumn("mi", score(F.col("cnt").cast("double"), n, F.col("c_w"), F.col("c_v")))
    # The pairs (w, w) are at most as many as words: scored on their own and joined like the dictionary.
    same = pairs.where("w = v").select("w", F.col("cnt").cast("double").alias("c_ww")).join(left, "w")
    own = hint(same.select("w", score(F.col("c_ww"), n, F.col("c_w"), F.col("c_w")).alias("own")))
    return scored.join(own, "w", "left").select(F.try_divide("mi", "own").alias("norm_mi"), "mi", "cnt", "w", "v")


def unknown(pairs: DataFrame, unigrams: DataFrame) -> DataFrame:
    """Pairs that association() leaves out since a word isn't in the dictionary."""
    known = unigrams.select(F.col("word"))
    v = pairs.join(known, F.col("v") == F.col("word"), "left_anti")
    return v.unionByName(pairs.join(known, F.col("v") == F.col("word"), "left_semi").join(known, F.col("w") == F.col("word"), "left_anti"))


def in_score_order(scores: DataFrame) -> DataFrame:
    """By w, then mi descending, then v."""
    return scores.orderBy("w", F.desc("mi"), "v")
