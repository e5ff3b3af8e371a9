"""The stateless stages and counts as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.functions.text import split_sentences, tokenize
from corpuloom.operators.collocations import pair_counts, with_context_in_document
from corpuloom.operators.ngrams import each_ngram, ngram_counts


def read_texts(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """(line) of text files as they arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path).withColumnRenamed("value", "line")


def token_stream(lines: DataFrame, line: str = "line", **how) -> DataFrame:
    """Sentence-split and tokenized lines, append mode: (sentence, words)."""
    each = lines.select(F.explode(F.filter(F.split(split_sentences(F.col(line)), "\n", -1), lambda s: s != "")).alias("sentence"))
    return each.withColumn("words", tokenize(F.col("sentence"), **how))


def ngram_stream(lines: DataFrame, n: int = 2, line: str = "line") -> DataFrame:
    """Running n-gram counts, for complete or update mode. The state has a row an n-gram."""
    return ngram_counts(token_stream(lines, line), "words", n)


def collocation_stream(docs: DataFrame, text: str = "line") -> DataFrame:
    """Running pair counts; each row's text is one paragraph, so neighbours never wait for another row."""
    sentences = F.filter(F.split(split_sentences(F.col(text)), "\n", -1), lambda s: s != "")
    return pair_counts(with_context_in_document(docs.select(F.transform(sentences, lambda s: tokenize(s)).alias("sentences"))))


def windowed_counts(rows: DataFrame, time: str, window: str, late: str, words: str = "words", n: int = 1) -> DataFrame:
    """N-gram counts by windows of event time, with a watermark, for append mode."""
    each = each_ngram(rows.withWatermark(time, late), words, n, time)
    return each.groupBy(F.window(time, window), "ngram").agg(F.count("*").alias("cnt"))


def start(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", format: str = "parquet", once: bool = True):
    """Start a query on a file sink (append) or, through foreachBatch, a table replaced each time (complete)."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    if mode == "append":
        return writer.format(format).option("path", sink).start()
    return writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").format(format).save(sink)).start()
