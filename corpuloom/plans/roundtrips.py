"""Queries over readers, writers and streams (written to the shared folder and read back), and over rows of odd cases.

Each has SQL for the rows that must come back.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuloom.functions import text as T
from corpuloom.operators import articles, association, markup, ngrams, pair_cells, sentences, tokens
from corpuloom.plans import duck
from corpuloom.sources import readers, workspace, writers
from corpuloom.streaming import streams


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def unigrams(spark, sf_dir, where: str = "true") -> DataFrame:
    lines = sentences.lines(table(spark, sf_dir, "documents").where(where))
    return ngrams.ngram_counts(lines.withColumn("words", T.words_of(F.col("line"))), n=1)


def wiki_dump(spark, sf_dir):
    """Documents written as a dump of pages with two revisions each, read as pages."""
    escaped = F.col("text")
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(name))
    redirect = F.when(F.col("doc_id") % 7 == 0, "<redirect title=\"x\"/>").otherwise("")
    page = F.concat(F.lit("<page><title> Page "), F.col("doc_id").cast("string"), F.lit(" </title>"), redirect, F.lit("<revision><text>old</text></revision><revision><text>"), escaped, F.lit("</text></revision></page>"))
    path = workspace.new_path(spark, "dump")

    def rooted(batches):
        yield pa.record_batch([pa.array(["<mediawiki>"])], ["value"])
        yield from batches
        yield pa.record_batch([pa.array(["</mediawiki>"])], ["value"])

    table(spark, sf_dir, "documents").select(page.alias("value")).mapInArrow(rooted, "value string").write.text(path)
    return readers.wiki_pages(spark, path)


def rejected_pages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pages = docs.select("doc_id", F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("P"), F.col("doc_id").cast("string"))).alias("title"), F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("markup"), F.lit(False).alias("is_redirect"))
    return articles.rejected(pages).select("doc_id", "reason")


def article_stream(spark, sf_dir):
    """Framed articles, packed with bzip2 and read back."""
    path = workspace.new_path(spark, "stream")
    writers.write_article_stream(table(spark, sf_dir, "documents"), path, compression="bzip2")
    return readers.article_stream(spark, path)


def article_stream_strict(spark, sf_dir):
    """One article a line of a stream whose articles also hold lines that only end with a form feed."""
    path = workspace.new_path(spark, "strict")
    table(spark, sf_dir, "conversations").select(F.concat(F.col("text"), F.lit(" ends\f\nstill\n\f")).alias("value")).write.text(path)
    return readers.article_stream(spark, path, strict=True)


def sentence_stream(spark, sf_dir):
    path = workspace.new_path(spark, "sentences")
    # Sorted before the sentences are told apart: a sort reads its rows twice, and the texts are as large as the lines.
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    writers.write_sentence_stream(sentences.sentence_lines(docs), path, compression="bzip2")
    return readers.article_stream(spark, path)


def article_files(spark, sf_dir):
    """A file an article, read back by name and content."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("An /Article "), (F.col("doc_id") % 97).cast("string")).alias("title"), "text")
    path = workspace.new_path(spark, "files")
    writers.write_article_files(rows, path)
    found = spark.read.format("binaryFile").load(path)
    return found.select(F.substring_index("path", "/", -1).alias("slug"), F.sha2("content", 256).alias("sha256"))


def in_file_order(spark, path: str) -> DataFrame:
    """(place, line) of the files of a folder in the order of their names.

    Lines are numbered within their piece of a file, where they are read one after the other, and each piece is told
    how many lines stand before it: no task sorts or holds more than its own rows, but for a row a piece.
    """
    each = spark.read.option("lineSep", "\n").text(path).where("value <> ''")
    each = each.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("k"))
    rows = writers.stage(each, workspace.new_path(spark, "numbered"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = rows.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("k").alias("first")).select("file", "start", (before - F.col("first")).alias("shift"))
    return rows.join(F.broadcast(pieces), ["file", "start"]).select(F.col("value").alias("line"), (F.col("k") + F.col("shift") + 1).alias("place"))


def count_table_by_key(spark, sf_dir):
    path = workspace.new_path(spark, "counts")
    writers.write_count_table(unigrams(spark, sf_dir), path)
    return in_file_order(spark, path)


def count_table_by_frequency(spark, sf_dir):
    path = workspace.new_path(spark, "counts")
    writers.write_count_table(unigrams(spark, sf_dir), path, by_frequency=True)
    return in_file_order(spark, path)


def count_table_read(spark, sf_dir):
    """A packed table with a total: its rows and, with a null ngram, its total."""
    path = workspace.new_path(spark, "counts")
    writers.write_count_table(unigrams(spark, sf_dir), path, compression="bzip2")
    counts, totals, _ = readers.count_table(spark, path)
    return counts.unionByName(totals.select(F.lit(None).cast("string").alias("ngram"), F.col("total").alias("cnt")))


#: Lines of count files that are headers, malformed, or odd in their count or key.
ODD_LINES = [("12\ta b", "row"), ("7\tx\r", "row"), ("bad\ty", "row"), ("3\tp\tq", "row"), ("none at all", "malformed"), ("", "malformed"), ("41", "total"), (" 9 ", "total"), ("0\tz", "row"), ("12x\tk", "row")]


def headerless_counts(spark, sf_dir):
    """Counts without a total, among lines that are odd or no counts at all: what kind each line is, and its parts."""
    path = workspace.new_path(spark, "odd")
    writers.write_count_table(unigrams(spark, sf_dir), path, header=False)
    spark.createDataFrame([(x,) for x, _ in ODD_LINES], "value string").write.mode("append").text(path)
    counts, totals, bad = readers.count_table(spark, path)
    none = F.lit(None).cast("string")
    return (
        counts.select(F.lit("row").alias("kind"), "ngram", "cnt")
        .unionByName(totals.select(F.lit("total").alias("kind"), none.alias("ngram"), F.col("total").alias("cnt")))
        .unionByName(bad.select(F.lit("malformed").alias("kind"), F.col("value").alias("ngram"), F.lit(None).cast("long").alias("cnt")))
    )


def unigram_dictionary(spark, sf_dir):
    """The dictionary of two tables in one folder: words of both add up, as do the totals."""
    path = workspace.new_path(spark, "dictionary")
    for k in (0, 1):
        writers.write_count_table(unigrams(spark, sf_dir, f"doc_id % 2 = {k}"), f"{path}/{k}")
    words, n = readers.unigram_dictionary(spark, f"{path}/*")
    return words.withColumn("total", F.lit(n).cast("long"))


def byte_range(spark, sf_dir):
    """Bytes 100 to 2,900 of a file with the ids of all documents, read in pieces."""
    path = workspace.new_path(spark, "bytes")
    ids = table(spark, sf_dir, "documents").select("doc_id").distinct().orderBy("doc_id").coalesce(1)
    ids.select(F.col("doc_id").cast("string")).write.text(path)
    pieces = readers.byte_range(spark, f"{path}/part-*", 100, 2900, piece=700)
    return pieces.select("at", F.col("content").cast("string").alias("content"))


def talk_groups(spark, sf_dir, cutoff=0):
    from corpuloom.plans import catalogue

    return catalogue.talk_groups(spark, sf_dir, cutoff)


def pair_table(spark, sf_dir):
    """Pairs written as `count<TAB>w v` and read as a count table of two words."""
    path = workspace.new_path(spark, "pairs")
    pairs = pair_cells.pair_counts(talk_groups(spark, sf_dir))
    # A sort reads its rows twice.
    writers.write_collocations(writers.stage(pairs, workspace.new_path(spark, "counted")), path, compression="bzip2")
    return association.two_words(readers.count_table(spark, path)[0]).select("w", "v", "cnt")


def score_table(spark, sf_dir):
    """Scores written as five fields and read back, with the place within their word: by falling score, then v."""
    scores = writers.stage(pair_cells.scores(talk_groups(spark, sf_dir, 20)), workspace.new_path(spark, "scored"))
    path = workspace.new_path(spark, "scores")
    writers.write_scores(scores, path)
    schema = "norm_mi double, mi double, cnt long, w string, v string"
    back = spark.read.schema(schema).csv(path, sep="\t", quote="").withColumn("file", F.regexp_extract(F.input_file_name(), "part-([0-9]+)-[^/]*$", 1).cast("int")).withColumn("k", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("w").orderBy("file", "k")).cast("long").alias("place")
    return back.select(F.round("norm_mi", 6).alias("norm_mi"), F.round("mi", 4).alias("mi"), "cnt", "w", "v", place)


def stage_table(spark, sf_dir):
    """A stage's table, written twice and read once."""
    path = workspace.new_path(spark, "stage")
    writers.stage(table(spark, sf_dir, "labels"), path)
    return writers.stage(table(spark, sf_dir, "labels"), path)


def head_rows(spark, sf_dir):
    """The first fifty lines of the documents, which is what the tool is for."""
    return writers.sample_head(sentences.lines(table(spark, sf_dir, "documents")), 50, "doc_id", "line_id")


def stream_of(spark, sf_dir) -> DataFrame:
    path = workspace.new_path(spark, "arriving")
    table(spark, sf_dir, "conversations").select("text").write.text(path)
    return streams.read_texts(spark, path)


def finished(df: DataFrame, spark, mode: str) -> DataFrame:
    path = workspace.new_path(spark, "streamed")
    streams.start(df, path, workspace.new_path(spark, "progress"), mode).awaitTermination()
    return spark.read.parquet(path)


def stream_bigrams(spark, sf_dir):
    """Running bigram counts of lines that arrive as files, when all have arrived."""
    return finished(streams.ngram_stream(stream_of(spark, sf_dir)), spark, "complete")


def stream_tokens(spark, sf_dir):
    rows = finished(streams.token_stream(stream_of(spark, sf_dir)), spark, "append")
    return rows.select("sentence", F.array_join("words", " ").alias("rendered"))


def windowed_counts(spark, sf_dir):
    """Words of the events by windows of an hour of event time."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.array("event_type").alias("words"))
    out = streams.windowed_counts(events, "ts", "1 hour", "2 hours")
    return out.select(F.unix_timestamp("window.start").alias("start"), "ngram", "cnt")


MARKUP_CASES = [
    ("see [[Target|label]] now", "see label now"), ("see [Target|label] now", "see label now"), ("see [[plain]] now", "see plain now"), ("x [http://h.org lbl] y", "x  y"),
    ("x [[fr:Autre]] y", "x  y"), ("a [ b", "a [ b"), ("[a [[b|c] d", "[a [c d"), ("p [[File:z.png|cap]] q", "p \n\ncap\n\n q"), ("p [[image:z.png|thumb|a [[b|c]] d]] q", "p \n\na c d\n\n q"),
    ("a<!-- n\nm -->b", "ab"), ("a<ref>n</ref>b", "ab"), ("a<ref name='x'/>b", "ab"), ("a<br/>b", "a\nb"), ("a<br />b", "a\nb"), ("a<br>b", "a"), ("a<br>", "a\n"),
    ("a {{t|{{u}}}} b", "a  b"), ("a {{never closed", "a "), ("a {single} b", "a {single} b"), ("{| x\n| y\n|}z", "z"), ("a\n | row\nb", "a\n b"), ("a | b", "a | b"),
    ("* a\n* b\n", "a\n\n\nb\n\n\n"), ("- a <!-- c -->x", "a \n\nx"), ("a * b - c", "a * b - c"), (":a : b", "a : b"), ("== H ==\nx", "H\n\n\nx"), ("a = b = c", "a b\n\n c"), ("a = b", "a = b"),
    ("x\n==References==\ny", "x\n"), ("x\n== Further reading ==\ny", "x\n"), ("x\n== Related pages ==\ny", "x\n"), ("x\n==Footnotes==\ny", "x\n"), ("'''b''' ''i'' don't", "b i don't"), ("", ""),
]
BARE_CASES = [("== H ==\nx", "x"), ("a == H == b", "a  b"), ("x\n==References==\ny", "x\n")]
BAD_MARKUP = [("line one\nab <!-- open", 2, 4, "<!-- open"), ("<!-- " + "y" * 40, 1, 1, "<!-- " + "y" * 21 + "..."), ("ok\n\n* item [[a|<!-- b]]", 3, 12, "<!-- b]]"), ("fine", None, None, None)]
ENTITY_CASES = [("&amp;nbsp; &#233; &eacute; &noend", "&nbsp; é é &noend"), ("&#x41;&#X42;&#67;", "ABC"), ("&lt;b&gt; &quot;q&quot; &apos;", "<b> \"q\" '"), ("&hellip;&mdash;&nbsp;&euro;", "…—\xa0€"), ("plain", "plain"), ("&bogus; & &;", "&bogus; & &;"), ("", "")]
SENTENCE_CASES = [
    ("One here. Two here", ["One here.", "Two here"]), ("Ships of the U.K. sail. Done", ["Ships of the U.K. sail.", "Done"]), ("Ann B. Roe Sr. spoke.", ["Ann B. Roe Sr. spoke."]), ("It was grade 5. Then", ["It was grade 5. Then"]),
    ('They said "go." Then', ['They said "go."', "Then"]), ("What? Yes! a; b", ["What?", "Yes!", "a;", "b"]), ("No?! ok", ["No?", "!", "ok"]), ('Stop!" she said', ["Stop!", '" she said']), ("A one.\n\nB two.", ["A one.", "B two."]),
    ("left\nright", ["left right"]), ("a   b \t c", ["a b c"]), ("  \n\n lead", ["lead"]), ("see the U.S.\nnext line", ["see the U.S.", "next line"]), ("for e.g. This one", ["for e.g. This one"]), ("para one\n\n\npara two", ["para one", "para two"]), ("tab\tkept", ["tab\tkept"]),
]
TOKEN_CASES = [
    ("Cats, Dogs: run!", "cats dogs run"), ("In the U.K. e.g. here", "in the u.k. e.g. here"), ("x e.g., y", "x e g y"), ("one (two) three", "one three"), ("a(b)c", "ac"), ("a ) b", "a"), ("a ( b", "a"), ("a (see U.K. law) b", "a u.k. b"),
    ("'tis the dogs' bone", "tis the dogs' bone"), ("gov't ''quoted'' (x)'y", "gov't quoted'' y"), ("1,000,000 and 3.14", "1,000,000 and 3 14"), ("1, 2,x ,3", "1 2 x 3"), ("1,(x)2", "1 2"), ("about 3.5", "about 3.5"), ("Óscar —x– y ”z−w", "Óscar x y z w"), ("...", ""), ("", ""),
]
SIZES = [("512", 512), ("512b", 512), ("2k", 2048), ("500M", 500 << 20), ("1g", 1 << 30)]


def case_rows(spark, cases, name: str) -> DataFrame:
    return spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], f"k long, {name} string")


def markup_cases(spark, sf_dir):
    return markup.textify(case_rows(spark, MARKUP_CASES, "markup")).select("k", "text")


def markup_cases_bare(spark, sf_dir):
    return markup.textify(case_rows(spark, BARE_CASES, "markup"), ignore_headings=True).select("k", "text")


def markup_errors(spark, sf_dir):
    """Where an article that can't be read goes wrong; an article that can be read has nulls."""
    return markup.textify(case_rows(spark, BAD_MARKUP, "markup")).select("k", F.col("error.line").cast("long").alias("line"), F.col("error.col").cast("long").alias("col"), "error.snippet")


def entity_cases(spark, sf_dir):
    return markup.unescape(case_rows(spark, ENTITY_CASES, "text"), "text")


def sentence_cases(spark, sf_dir):
    out = sentences.sentences(case_rows(spark, SENTENCE_CASES, "text"), id="k")
    place = F.row_number().over(Window.partitionBy("k").orderBy("para_id", "sent_id")).cast("long").alias("place")
    return out.select("k", place, "sentence")


def token_cases(spark, sf_dir):
    return tokens.tokens(case_rows(spark, TOKEN_CASES, "line"), "line").select("k", "rendered")


def size_suffixes(spark, sf_dir):
    return spark.createDataFrame([(x, T.parse_size(x)) for x, _ in SIZES], "size string, bytes long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        wiki_dump, rejected_pages, article_stream, article_stream_strict, sentence_stream, article_files, count_table_by_key, count_table_by_frequency, count_table_read, headerless_counts,
        unigram_dictionary, byte_range, pair_table, score_table, stage_table, head_rows, stream_bigrams, stream_tokens, windowed_counts,
        markup_cases, markup_cases_bare, markup_errors, entity_cases, sentence_cases, token_cases, size_suffixes,
    )
    return {f.__name__: f for f in every}


def literal(x) -> str:
    if x is None:
        return "NULL"
    return str(x) if isinstance(x, int) else " || ".join("'" + part.replace("'", "''") + "'" for part in [x]).replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '").replace("\r", "' || chr(13) || '")


def values(rows, names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS t({names})"


def oracle_sql() -> dict[str, str]:
    base = f"WITH {duck.LINES}, {duck.WORDS}, uni AS ({duck.grams(1)})"
    lines = "SELECT cnt || chr(9) || ngram AS line, row_number() OVER (ORDER BY {}) + 1 AS place FROM uni UNION ALL SELECT sum(cnt)::VARCHAR, 1 FROM uni"
    odd = [("row", "a b", 12), ("row", "x", 7), ("row", "y", 0), ("row", "p\tq", 3), ("malformed", "none at all", None), ("malformed", "", None), ("total", None, 41), ("total", None, 9), ("row", "z", 0), ("row", "k", 12)]
    scored = duck.SCORED.format(cutoff=20)
    talks = "talks AS (SELECT row_number() OVER () AS doc_id, text FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM conversations))"
    streamed = f"WITH {talks}, {duck.sentence_steps('talks')}, lines AS (SELECT doc_id, row_number() OVER () AS line_id, sentence AS line FROM sents), {duck.tokens()}"
    return {
        "wiki_dump": "SELECT 'Page ' || doc_id AS title, text AS markup, doc_id % 7 = 0 AS is_redirect FROM documents",
        "rejected_pages": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'no title' ELSE 'no text' END AS reason FROM documents WHERE doc_id % 5 = 0 OR doc_id % 3 = 0 OR text IS NULL",
        "article_stream": "SELECT * FROM (SELECT rtrim(regexp_replace(text, '^[\\n\\r ]+', ''), chr(10)) AS text FROM documents) WHERE text <> ''",
        "article_stream_strict": "SELECT text || ' ends' || chr(12) || chr(10) || 'still' AS text FROM conversations WHERE text IS NOT NULL",
        "sentence_stream": f"WITH {duck.sentence_steps('documents')} SELECT * FROM (SELECT rtrim(x13, chr(10)) AS text FROM s13) WHERE text <> ''",
        "article_files": "SELECT 'an__article_' || (doc_id % 97) || '.txt' AS slug, sha256(arg_max(text, doc_id) || chr(10)) AS sha256 FROM documents GROUP BY doc_id % 97",
        "count_table_by_key": f"{base} {lines.format('ngram')}",
        "count_table_by_frequency": f"{base} {lines.format('cnt DESC, ngram DESC')}",
        "count_table_read": f"{base} SELECT ngram, cnt FROM uni UNION ALL SELECT NULL, sum(cnt)::BIGINT FROM uni",
        "headerless_counts": f"{base} SELECT 'row' AS kind, ngram, cnt FROM uni UNION ALL {values(odd, 'kind, ngram, cnt')}",
        "unigram_dictionary": f"{base} SELECT ngram AS word, cnt, (sum(cnt) OVER ())::BIGINT AS total FROM uni",
        "byte_range": "WITH f AS (SELECT string_agg(doc_id || chr(10), '' ORDER BY doc_id) AS x FROM (SELECT DISTINCT doc_id FROM documents)), g AS (SELECT x, strlen(x) AS n FROM f), p AS (SELECT x, n, unnest(range(4)) * 700 + 100 AS \"at\" FROM g) SELECT p.at::BIGINT AS \"at\", substr(x, p.at + 1, 700) AS content FROM p WHERE p.at < n",
        "pair_table": f"WITH {duck.TALK_STEPS} SELECT w, v, cnt FROM pairs",
        "score_table": f"WITH {duck.TALK_STEPS}, {scored} SELECT round(norm_mi, 6) AS norm_mi, round(mi, 4) AS mi, cnt, w, v, row_number() OVER (PARTITION BY w ORDER BY mi DESC, v) AS place FROM normed",
        "stage_table": "SELECT * FROM labels",
        "head_rows": f"WITH {duck.LINES} SELECT doc_id, line_id, line FROM lines ORDER BY doc_id, line_id LIMIT 50",
        "stream_bigrams": f"{streamed} {duck.grams(2, 'toks')}",
        "stream_tokens": f"{streamed} SELECT s.line AS sentence, array_to_string(words, ' ') AS rendered FROM toks JOIN lines s USING (doc_id, line_id)",
        "windowed_counts": "WITH e AS (SELECT (floor(epoch(ts))::BIGINT // 3600) * 3600 AS start, event_type FROM events) SELECT start, ngram, count(*) AS cnt FROM (SELECT start, unnest([event_type, '</s>']) AS ngram FROM e) GROUP BY ALL",
        "markup_cases": values([(k, b) for k, (_, b) in enumerate(MARKUP_CASES)], "k, text"),
        "markup_cases_bare": values([(k, b) for k, (_, b) in enumerate(BARE_CASES)], "k, text"),
        "markup_errors": values([(k, *rest) for k, (_, *rest) in enumerate(BAD_MARKUP)], "k, line, col, snippet"),
        "entity_cases": values([(k, b) for k, (_, b) in enumerate(ENTITY_CASES)], "k, text"),
        "sentence_cases": values([(k, p, s) for k, (_, found) in enumerate(SENTENCE_CASES) for p, s in enumerate(found, 1)], "k, place, sentence"),
        "token_cases": values([(k, b) for k, (_, b) in enumerate(TOKEN_CASES)], "k, rendered"),
        "size_suffixes": values(SIZES, "size, bytes"),
    }
