"""Documents to sentences and lines, with their places as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuloom.functions.text import mark_text, split_marked


def sentences(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, para_id, sent_id, sentence): paragraphs and sentences counted from 0; a null text gives no row.

    One pass without a shuffle; whole documents stay on one row until their sentences are told apart.
    """
    out = sentence_lines(docs, text, id)
    out = out.select(id, F.posexplode(F.array_remove(F.split("lines", "\n{2,}", -1), "")).alias("para_id", "__p"))
    return out.select(id, "para_id", F.posexplode(F.array_remove(F.split("__p", "\n", -1), "")).alias("sent_id", "sentence"))


def sentence_lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, lines): each document as sentence lines, an empty line between paragraphs, as text sinks write it."""
    return docs.select(id, mark_text(F.col(text)).alias("__m")).select(id, split_marked(F.col("__m")).alias("lines"))


def lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, line_id, line): the lines of each document from 0; a null text gives no row."""
    return docs.select(id, F.posexplode(F.split(text, "\n", -1)).alias("line_id", "line"))


def number_paragraphs(rows: DataFrame, line: str = "line", id: str = "doc_id", order: str = "line_id") -> DataFrame:
    """rows with para_id: the number of empty lines of the document up to the row."""
    upto = Window.partitionBy(id).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("para_id", F.sum((F.col(line) == "").cast("int")).over(upto))


def short_lines(rows: DataFrame, line: str = "line", most_bytes: int = 8192) -> DataFrame:
    """Rows whose line has fewer bytes than most_bytes. Taken before neighbours are looked at, so those become adjacent."""
    return rows.where(F.octet_length(line) < most_bytes)


def not_blank(rows: DataFrame, line: str = "line") -> DataFrame:
    """Rows whose line has anything but spaces, tabs, line and form feeds and carriage returns."""
    return rows.where(~F.col(line).rlike(r"\A[ \n\r\f\t]*\z"))
