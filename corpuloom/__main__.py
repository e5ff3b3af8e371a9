"""Command line: each tool reads a path that Spark can read and writes a folder.

    python -m corpuloom articles DUMP OUT [--files]
    python -m corpuloom textify ARTICLES OUT [--ignore-headings] [--rejects BAD]
    python -m corpuloom sentences TEXTS OUT
    python -m corpuloom tokenize LINES OUT [--keep CHARS] [--parens] [--keep-case]
    python -m corpuloom ngrams LINES OUT [-n N]
    python -m corpuloom filter COUNTS OUT [-t T] [--no-total]
    python -m corpuloom sort COUNTS OUT
    python -m corpuloom merge COUNTS COUNTS OUT
    python -m corpuloom truncate FILE START END OUT
    python -m corpuloom collocations SENTENCES OUT
    python -m corpuloom association PAIRS OUT --unigrams COUNTS [-t CUTOFF]
    python -m corpuloom corpus DUMP OUT [-t CUTOFF]

Article and sentence streams are framed by lines of one form feed; lines of a stream keep their order within an article.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.functions.text import words_of
from corpuloom.operators import association, collocations, markup, ngrams, sentences, tokens
from corpuloom.plans import corpus
from corpuloom.sources import readers, workspace, writers


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="corpuloom")
    tools = out.add_subparsers(dest="tool", required=True)

    def tool(name: str, *places: str) -> argparse.ArgumentParser:
        p = tools.add_parser(name)
        for place in places:
            p.add_argument(place, type=int if place in ("start", "end") else str)
        return p

    tool("articles", "path", "out").add_argument("--files", action="store_true")
    p = tool("textify", "path", "out")
    p.add_argument("--ignore-headings", action="store_true")
    p.add_argument("--rejects")
    tool("sentences", "path", "out")
    p = tool("tokenize", "path", "out")
    p.add_argument("--keep", default="")
    p.add_argument("--parens", action="store_true")
    p.add_argument("--keep-case", action="store_true")
    tool("ngrams", "path", "out").add_argument("-n", type=int, default=2)
    p = tool("filter", "path", "out")
    p.add_argument("-t", type=int, default=5)
    p.add_argument("--no-total", action="store_true")
    tool("sort", "path", "out")
    tool("merge", "path", "other", "out")
    tool("truncate", "path", "start", "end", "out")
    tool("collocations", "path", "out")
    p = tool("association", "path", "out")
    p.add_argument("--unigrams", required=True)
    p.add_argument("-t", type=int, default=0)
    tool("corpus", "path", "out").add_argument("-t", type=int, default=0)
    return out


def framed(spark: SparkSession, path: str) -> DataFrame:
    return readers.article_stream(spark, path).withColumn("doc_id", F.monotonically_increasing_id())


def counts(spark: SparkSession, path: str) -> DataFrame:
    return readers.count_table(spark, path)[0]


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    tool = args.tool
    if tool == "articles":
        rows = corpus.read_articles(spark, args.path)
        rows = markup.unescape(rows, "markup")
        writers.write_article_files(rows, args.out, "markup") if args.files else writers.write_article_stream(rows, args.out, "markup")
    elif tool == "textify":
        rows = writers.stage(markup.textify(framed(spark, args.path), args.ignore_headings, "text"), workspace.new_path(spark, "textified"))
        writers.write_article_stream(rows.where("error is null"), args.out)
        if args.rejects:
            rows.where("error is not null").select("doc_id", "error.*").write.json(args.rejects)
    elif tool == "sentences":
        writers.write_sentence_stream(sentences.sentence_lines(framed(spark, args.path)), args.out)
    elif tool == "tokenize":
        rows = tokens.tokens(readers.text_lines(spark, args.path), "line", args.keep, args.parens, args.keep_case)
        rows.select("rendered").write.text(args.out)
    elif tool == "ngrams":
        rows = sentences.not_blank(readers.text_lines(spark, args.path)).withColumn("words", words_of(F.col("line")))
        writers.write_count_table(ngrams.ngram_counts(rows, n=args.n), args.out)
    elif tool == "filter":
        writers.write_count_table(ngrams.at_least(counts(spark, args.path), args.t), args.out, header=not args.no_total)
    elif tool == "sort":
        writers.write_count_table(counts(spark, args.path), args.out, by_frequency=True)
    elif tool == "merge":
        writers.write_count_table(ngrams.merge(counts(spark, args.path), counts(spark, args.other)), args.out)
    elif tool == "truncate":
        writers.write_bytes(readers.byte_range(spark, args.path, args.start, args.end), args.out)
    elif tool == "collocations":
        rows = sentences.short_lines(sentences.lines(framed(spark, args.path)))
        rows = sentences.number_paragraphs(rows).where("line <> ''").withColumn("words", words_of(F.col("line")))
        writers.write_collocations(collocations.collocations(rows, order="line_id"), args.out)
    elif tool == "association":
        unigrams, total = readers.unigram_dictionary(spark, args.unigrams)
        pairs = association.two_words(counts(spark, args.path))
        writers.write_scores(association.association(pairs, unigrams, total, args.t), args.out)
    else:
        corpus.build(spark, args.path, args.out, corpus.Settings(cutoff=args.t))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName("corpuloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
