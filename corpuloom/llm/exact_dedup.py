"""Exact dedup on a log-structured merge index of text digests.

Memtables (bounded parts of the entries) are folded to one entry a digest - the entry that stays and the number of
entries - and flushed as runs: tables in the shared folder, bucketed and sorted by digest, each with a Bloom filter of
bounded size. When a level has as many runs as the fan-out, they are compacted into one run of the next level: runs
have the same buckets in the same order, so Spark merges them by merge joins without an exchange or a sort. A probe
asks the filters first and doesn't read runs whose filter excludes all that is asked. Hits - digests with more than one
entry - are verified byte by byte: only texts that a filter of the hits lets through are moved, and grouped by the
bytes themselves, each task first folding its own equal texts into one. What two different texts share by digest
alone (never seen with SHA-256, but defined) is told apart by its text from there on.

Equal texts are those identical without the characters of `[\\x20\\x09-\\x0D]`. Of equal texts the row with the most
code points in the original text stays, then the smallest id; among rows that agree in both, all count as the one
that stays. A null text counts as empty, a null id is treated as larger than any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.llm.shared import attach_by_group, delete, filter_of, may_hold, row_key, stored, table_path, without_rows


def stripped(text: Column) -> Column:
    """text without any character of [\\x20\\x09-\\x0D]; null gives the empty string."""
    out = F.coalesce(text, F.lit(""))
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(stripped_text: Column) -> Column:
    return F.unhex(F.sha2(stripped_text, 256))


def entries_of(docs: DataFrame, text: str, id: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(id, digest, chars, row) of every row: what a memtable takes in. Texts are read once and go no further."""
    key = stripped(F.col(text))
    return docs.select(F.col(id).alias("id"), digest(key).alias("digest"), F.coalesce(F.char_length(text), F.lit(0)).alias("chars"), row_key(text).alias("row"))


def best(chars: str = "chars", id: str = "id") -> Column:
    """The entry that stays: most characters, then smallest id, null last."""
    return F.min(F.struct((-F.col(chars)).alias("less"), F.col(id).isNull().alias("none"), F.col(id).alias("id")))


def slot(digest: str = "digest") -> Column:
    return F.xxhash64(digest)


@dataclass
class Run:
    """A table of one row a digest: digest, keep (see best()), group_size."""

    name: str
    path: str
    bloom: DataFrame


class Index:
    """The runs by level, level 0 first."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_out: int = 4):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []
        self.runs_read = 0

    def table(self, run: Run) -> DataFrame:
        self.runs_read += 1
        return self.spark.table(run.name)

    def write(self, rows: DataFrame, bloom: DataFrame | None = None) -> Run:
        """rows of distinct digests as a run: one file a bucket, each sorted by digest. bloom: its filter, if it is known."""
        name = f"run_{uuid.uuid4().hex}"
        path = table_path(self.spark, "run")
        rows.write.bucketBy(self.buckets, "digest").sortBy("digest").option("path", path).saveAsTable(name)
        return Run(name, path, bloom if bloom is not None else filter_of(slot(), self.spark.table(name)))

    def flush(self, memtable: DataFrame) -> None:
        """Entries (digest, chars, id) become a run of level 0. Equal digests are folded map-side, then in their bucket."""
        folded = memtable.groupBy("digest").agg(best().alias("keep"), F.count("*").alias("group_size"))
        self.push(0, self.write(folded.repartition(self.buckets, "digest").sortWithinPartitions("digest")))

    def push(self, level: int, run: Run) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            self.compact(level)

    def compact(self, level: int) -> None:
        """The runs of a level become one of the next; then the old ones go."""
        old = self.levels[level]
        blooms = old[0].bloom
        for run in old[1:]:
            blooms = blooms.unionByName(run.bloom)
        merged = self.write(self.merged(old), blooms.groupBy("place").agg(F.bit_or("bits").alias("bits")))
        self.levels[level] = []
        for run in old:
            self.spark.sql(f"DROP TABLE {run.name}")
            delete(self.spark, run.path)
        self.push(level + 1, merged)

    def merged(self, runs: list[Run]) -> DataFrame:
        """One row a digest of several runs, by full merge joins bucket with bucket; the smaller entry stays."""
        out = self.table(runs[0])
        for run in runs[1:]:
            more = self.table(run).select("digest", F.col("keep").alias("keep_2"), F.col("group_size").alias("size_2"))
            out = out.hint("merge").join(more, "digest", "full").select("digest", F.least("keep", "keep_2").alias("keep"), (F.coalesce("group_size", F.lit(0)) + F.coalesce("size_2", F.lit(0))).alias("group_size"))
        return out

    def runs(self) -> list[Run]:
        return [run for level in reversed(self.levels) for run in level]

    def lookup(self) -> DataFrame:
        """One row a digest over all runs: digest, keep, group_size."""
        return self.merged(self.runs())

    def probe(self, asked: DataFrame) -> DataFrame:
        """Which of the digests (column digest, distinct) some run has. Runs that no digest passes the filter of aren't read."""
        found = []
        for run in self.runs():
            passing = may_hold(asked, slot(), run.bloom).where("may_hold").select("digest")
            if passing.limit(1).count():
                found.append(passing.join(self.table(run).select("digest"), "digest", "left_semi"))
        out = asked.select("digest").where("false")
        for rows in found:
            out = out.unionByName(rows)
        return out.distinct()


def indexed(entries: DataFrame, memtables: int = 2, index: Index | None = None) -> Index:
    """An index of stored entries, flushed in so many memtables and compacted to as few runs as there are levels."""
    index = index or Index(entries.sparkSession, fan_out=memtables)
    for k in range(memtables):
        index.flush(entries.where(F.pmod("row", F.lit(memtables)) == k))
    return index


def verified(docs: DataFrame, entries: DataFrame, hits: DataFrame, text: str, id: str, digest: Callable[[Column], Column]) -> DataFrame:
    """The classes of the hits by the texts' bytes: (digest, body, keep, group_size), one row a class.

    A filter of the row keys of the hits' entries keeps other texts where they are, unstripped and undigested; what
    passes is folded by its bytes, map-side first, and only then joined with the hits.
    """
    hit = entries.join(hits.hint("merge"), "digest", "left_semi").select("row")
    key = stripped(F.col("text"))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), row_key(text).alias("row"))
    rows = may_hold(rows, F.coalesce("row", F.lit(0).cast("long")), filter_of(F.coalesce("row", F.lit(0).cast("long")), hit)).where("may_hold")
    rows = rows.select("id", key.alias("body"), F.coalesce(F.char_length("text"), F.lit(0)).alias("chars")).withColumn("digest", digest(F.col("body")))
    classes = rows.groupBy("digest", "body").agg(best().alias("keep"), F.count("*").alias("group_size"))
    return classes.join(hits.select("digest").hint("merge"), "digest", "left_semi")


def exact_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row a row of docs: id, keep_id, group_size, kept, digest (binary).

    Empty and null texts are one group. Repeated rows with the same id are members of the group each; those with the
    id that stays are all kept. An empty table gives an empty table; other columns are neither read nor returned, so
    clashing names are harmless. digest is a function of the stripped text; a weak one only costs time.
    """
    return with_keepers(docs, text, id, digest).drop("row").withColumnRenamed("id", id)


def with_keepers(docs: DataFrame, text: str, id: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, row)."""
    runs = stored(entries_of(docs, text, id, digest))
    n_rows = runs.count()
    hits = stored(indexed(runs).lookup().where("group_size > 1").select("digest"))
    classes = stored(verified(docs, runs, hits, text, id, digest).withColumn("body", F.sha2("body", 512)))
    ambiguous = classes.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    clean = classes.join(ambiguous, "digest", "left_anti").select("digest", F.col("keep.id").alias("keep_id"), "group_size")
    n_ambiguous = ambiguous.count()
    told = runs
    if n_ambiguous:
        told = runs.join(ambiguous, "digest", "left_anti")
    out = attach_by_group(told, clean, "digest", "group_size", n_rows).select("id", "row", "digest", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    if n_ambiguous:
        key = stripped(F.col(text))
        rows = docs.select(F.col(id).alias("id"), digest(key).alias("digest"), F.sha2(key, 512).alias("body"), row_key(text).alias("row")).join(ambiguous, "digest", "left_semi")
        split = classes.join(ambiguous, "digest", "left_semi").select("body", F.col("keep.id").alias("keep_id"), "group_size")
        out = out.unionByName(attach_by_group(rows, split, "body", "group_size", n_rows).select("id", "row", "digest", "keep_id", "group_size"))
    return out.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "row")


def kept_rows(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of docs that stay, all columns. Of rows that have that id in common and the very text, one stays."""
    found = stored(with_keepers(docs, text, id))
    kept = found.where("kept")
    repeated = kept.where("group_size > 1").groupBy("id", "row").agg(F.count("*").alias("n")).where("n > 1")
    return without_rows(docs, found.where("not kept"), repeated, text, id)
