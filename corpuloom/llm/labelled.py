"""Folds by id and bounded training samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(id.cast("string")) % folds, F.lit(0))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most_rows: tuple[int, int], most_chars: int, text: str = "text", id: str = "doc_id") -> tuple[list[str], list[int]]:
    """Texts and labels of at most most_rows[y] documents of each class y, none of them in the held-out fold.

    The sample is the labelled ids of least hash, so it is the same whenever the labels are, and its size is bounded
    by most_rows[y] texts of most_chars characters a class. Of a longer text the sample holds a stretch of most_chars
    characters whose place the id's hash draws. Rows without an id or label are ignored; an id with two labels counts as
    1, and of several rows of an id the one with the greatest text is taken.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & (fold(F.col(id), folds) != held_out)).groupBy(F.col(id).alias("__id")).agg(F.max(label).alias("__y"))
    order = (F.xxhash64("__id"), F.col("__id"))
    chosen = known.where("__y = 1").orderBy(*order).limit(most_rows[1]).unionByName(known.where("__y = 0").orderBy(*order).limit(most_rows[0]))
    rows = docs.select(F.col(id).alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    n = F.length("__text")
    start = F.when(n > most_chars, F.pmod(F.xxhash64("__id", F.lit(7)), n - most_chars + 1)).otherwise(0)
    rows = rows.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).groupBy("__id", "__y").agg(F.max("__text").alias("__text"))
    got = rows.select("__id", "__y", F.substr("__text", (start + 1).cast("int"), F.lit(most_chars)).alias("__text"))
    got = got.toArrow().sort_by([("__id", "ascending")])
    return got.column("__text").to_pylist(), got.column("__y").to_pylist()
