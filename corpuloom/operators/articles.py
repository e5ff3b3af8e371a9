"""Wiki pages to articles: redirects and whole namespaces go, the last revision's text counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuloom.functions.text import namespace, title_slug

IGNORED_NAMESPACES = ("wikipedia", "category", "template")


def without_redirects(pages: DataFrame) -> DataFrame:
    """Rows of pages whose is_redirect isn't true."""
    return pages.where(~F.coalesce(F.col("is_redirect"), F.lit(False)))


def without_namespaces(pages: DataFrame, ignored: tuple[str, ...] = IGNORED_NAMESPACES, title: str = "title") -> DataFrame:
    """Rows whose title isn't in one of the namespaces; any other prefix stays, as do null titles."""
    return pages.where(~F.coalesce(namespace(F.col(title)).isin(*ignored), F.lit(False)))


def articles(pages: DataFrame, ignored: tuple[str, ...] = IGNORED_NAMESPACES) -> DataFrame:
    """pages(title, markup, is_redirect, ...) that are articles: neither redirects nor ignored, with title and markup."""
    return without_namespaces(without_redirects(pages), ignored).where("title is not null and markup is not null")


def rejected(pages: DataFrame) -> DataFrame:
    """Pages that can't be articles for want of a title or a text, with the reason."""
    reason = F.when(F.col("title").isNull(), "no title").when(F.col("markup").isNull(), "no text")
    return pages.withColumn("reason", reason).where("reason is not null")


def with_slugs(rows: DataFrame, order: str = "doc_id", title: str = "title") -> DataFrame:
    """One row a slug, the last in `order`, with the number of articles that share the slug."""
    slugged = rows.withColumn("slug", title_slug(F.col(title)))
    last = Window.partitionBy("slug").orderBy(F.col(order).desc())
    alike = Window.partitionBy("slug")
    return slugged.withColumn("n_alike", F.count("*").over(alike)).withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")
