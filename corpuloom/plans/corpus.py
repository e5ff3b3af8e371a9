"""The whole way from a wiki dump to its statistics, each stage a table that the next ones share."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.operators import articles, association, collocations, markup, ngrams, sentences, tokens
from corpuloom.sources import readers
from corpuloom.sources.writers import stage


@dataclass(frozen=True)
class Settings:
    ignored_namespaces: tuple[str, ...] = articles.IGNORED_NAMESPACES
    ignore_headings: bool = False
    unescape: bool = True
    keep: str = ""
    parens: bool = False
    keep_case: bool = False
    orders: tuple[int, ...] = (1, 2, 3)
    threshold: int = 5
    cutoff: int = 0
    most_line_bytes: int = 8192

    def __post_init__(self):
        if any(n < 1 for n in self.orders):
            raise ValueError("n must be at least 1")


@dataclass
class Corpus:
    """Tables of a finished run. rejects: articles that couldn't be read, with the reason."""

    plaintext: DataFrame
    rejects: DataFrame
    tokens: DataFrame
    counts: dict[int, DataFrame] = field(default_factory=dict)
    collocations: DataFrame | None = None
    association: DataFrame | None = None


def read_articles(spark: SparkSession, dump: str, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, title, markup) of a dump. doc_id is a hash of the title, so that it doesn't depend on how the dump is cut."""
    pages = articles.articles(readers.wiki_pages(spark, dump), settings.ignored_namespaces)
    return pages.select(F.xxhash64("title").alias("doc_id"), "title", "markup")


def tokenized(plaintext: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, para_id, sent_id, words) of (doc_id, text): no shuffle."""
    rows = sentences.short_lines(sentences.sentences(plaintext), "sentence", settings.most_line_bytes)
    return tokens.tokens(rows, "sentence", settings.keep, settings.parens, settings.keep_case).drop("rendered")


def build(spark: SparkSession, dump: str, folder: str, settings: Settings = Settings()) -> Corpus:
    """Runs all stages and leaves their tables in folder."""
    read = markup.textify(read_articles(spark, dump, settings), settings.ignore_headings, unescape=settings.unescape)
    read = stage(read, f"{folder}/articles")
    plaintext = read.where("text is not null").select("doc_id", "title", "text")
    words = stage(tokenized(plaintext, settings), f"{folder}/tokens")
    out = Corpus(plaintext, read.where("error is not null").select("doc_id", "title", "error"), words)
    for n in settings.orders:
        out.counts[n] = stage(ngrams.ngram_counts(words, n=n), f"{folder}/ngrams-{n}")
    unigrams = ngrams.dictionary(out.counts.get(1) or ngrams.ngram_counts(words, n=1))
    used = collocations.pruned(words, unigrams, settings.cutoff) if settings.cutoff > 1 else words
    out.collocations = stage(collocations.collocations(used), f"{folder}/collocations")
    total = ngrams.total(unigrams.withColumnRenamed("word", "ngram")).first()["total"]
    out.association = stage(association.association(out.collocations, unigrams, total, settings.cutoff), f"{folder}/association")
    return out


def frequent(corpus: Corpus, n: int, settings: Settings = Settings()) -> DataFrame:
    """A count table of the corpus without rare n-grams, most frequent first."""
    return ngrams.by_frequency(ngrams.at_least(corpus.counts[n], settings.threshold))
