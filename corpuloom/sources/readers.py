"""Readers: wiki dumps, framed article and sentence streams, lines, count tables, byte ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.functions.text import count_of, key_of



def row_groups(df: DataFrame, most: int) -> int:
    """Row groups of a Parquet table of fewer than `most` files, by their footers; of any other table `most`, nothing read."""
    files, spark = df.inputFiles(), df.sparkSession
    if not 0 < len(files) < most or not all(x.endswith(".parquet") for x in files):
        return most
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        n += reader.getRowGroups().size()
        reader.close()
    return n


def dealt(df: DataFrame) -> DataFrame:
    """df, dealt out over the cores if it is read in fewer parts than there are cores; no row is dropped or changed.

    A row group is read by one task, whatever its size and however many splits its file is cut into: the other splits are
    empty. A table of many files is left as it is.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(max(cores, parts)) if parts < cores or row_groups(df, cores) < cores else df


PAGE = "title string, redirect struct<_title: string, _VALUE: string>, revision array<struct<text: string>>"


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(title, markup, is_redirect) of a wiki XML dump, split by page; a page cut off at the end is left out.

    Of several revisions the last one's text counts; an empty text element is an empty text, none at all a null one.
    """
    raw = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(PAGE).load(path)
    text = F.element_at(F.col("revision"), -1)["text"]
    rows = raw.select(F.btrim("title").alias("title"), text.alias("markup"), F.col("redirect").isNotNull().alias("is_redirect"))
    return rows.where("title is not null or markup is not null")


def article_stream(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(text): articles that end with a line of one form feed. strict: only a line that is nothing but it ends one.

    The plain form streams through files of any size; strict reads whole files, so each must fit a task's memory.
    """
    if strict:
        parts = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?m)^\f$\n?", -1)).alias("text"))
    else:
        parts = spark.read.option("lineSep", "\f\n").text(path).withColumnRenamed("value", "text")
    return parts.select(F.regexp_replace("text", r"\n+\z", "").alias("text")).where("text <> ''")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of text files; without an order, see operators.sentences.lines for lines in order."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def count_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, totals, malformed) of count files: ngram and cnt; the header lines' totals; lines that are neither."""
    raw = spark.read.text(path)
    tabbed = F.contains("value", F.lit("\t"))
    header = ~tabbed & F.col("value").rlike(r"^\s*[0-9]+\s*$")
    counts = raw.where(tabbed).select(key_of(F.col("value")).alias("ngram"), count_of(F.col("value")).alias("cnt"))
    return counts, raw.where(header).select(count_of(F.col("value")).alias("total")), raw.where(~tabbed & ~header).select("value")


def unigram_dictionary(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """((word, cnt) with repeated words added up, total N of the header); a file without a header is an error."""
    counts, totals, _ = count_table(spark, path)
    n = totals.agg(F.sum("total")).first()[0]
    if n is None:
        raise ValueError(f"no total at the head of {path}")
    return counts.groupBy(F.col("ngram").alias("word")).agg(F.sum("cnt").alias("cnt")), int(n)


def byte_range(spark: SparkSession, path: str, start: int, end: int, piece: int = 64 << 20) -> DataFrame:
    """(path, at, content): bytes start up to but not with end of each file, in pieces of at most `piece` bytes.

    at: where the piece stands in its file. A range past a file's end is cut there; a file without any byte of the
    range has one empty piece. Each piece is read on its own by a seek, so files may be of any size.
    """
    if start < 0 or end < start:
        raise ValueError("0 <= start <= end")
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    first, last = F.least(F.lit(start), "length"), F.least(F.lit(end), "length")
    n = F.greatest(F.ceil((last - first) / piece), F.lit(1))
    pieces = files.select("path", first.alias("first"), last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k"))
    pieces = pieces.select("path", (F.col("first") + F.col("k") * piece).alias("at"), F.least("last", F.col("first") + (F.col("k") + 1) * piece).alias("to"))

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for name, at, to in zip(*(c.to_pylist() for c in batch.columns)):
                system, inner = fs.FileSystem.from_uri(name if "://" in name or not name.startswith("file:/") else "file://" + name[5:])
                with system.open_input_file(inner) as f:
                    content = f.read_at(to - at, at) if to > at else b""
                yield pa.record_batch([pa.array([name]), pa.array([at], pa.int64()), pa.array([content], pa.binary())], ["path", "at", "content"])

    return pieces.repartition("path", "at").mapInArrow(read, "path string, at long, content binary")
