import bz2
import glob
import os

import pytest
from pyspark.sql import functions as F

from corpuloom.operators import ngrams
from corpuloom.sources import readers, workspace, writers
from corpuloom.streaming import streams

DUMP = """<mediawiki><page><title>Foo</title><revision><text>first</text></revision><revision><text xml:space="preserve">last  </text></revision></page>
<page><title>R</title><redirect title="X"/><revision><text>r</text></revision></page>
<page><title>R2</title><redirect/><revision><text>r</text></revision></page>
<page><title>Empty</title><revision><text/></revision></page>
<page><title>None</title><revision></revision></page>
<page><title>Cut</title><revision><text>never clo"""


def put(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def read(folder, pattern="part-*"):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{folder}/{pattern}")))


def test_wiki_pages(spark, tmp_path):
    got = {r.title: (r.markup, r.is_redirect) for r in readers.wiki_pages(spark, put(tmp_path / "dump.xml", DUMP)).collect()}
    assert got["Foo"][0].startswith("last") and got["Foo"][1] is False
    assert got["R"][1] and got["R2"][1]
    assert got["Empty"] == ("", False) or got["Empty"] == (None, False)
    assert "Cut" not in got


def test_article_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "\n  one\nline"), (2, "two")], "doc_id int, text string")
    writers.write_article_stream(rows, str(tmp_path / "s"), order="doc_id")
    assert read(tmp_path / "s") == "one\nline\n\n\n\f\ntwo\n\n\n\f\n"
    assert sorted(r.text for r in readers.article_stream(spark, str(tmp_path / "s")).collect()) == ["one\nline", "two"]
    odd = put(tmp_path / "odd.txt", "a\nends with\f\nb\n\f\nc\n")
    assert [r.text for r in readers.article_stream(spark, odd, strict=True).collect()] == ["a\nends with\f\nb", "c"]
    writers.write_sentence_stream(spark.createDataFrame([(1, "a.\nb.\n\nc.\n\n")], "doc_id int, lines string"), str(tmp_path / "t"), order="doc_id")
    assert read(tmp_path / "t") == "a.\nb.\n\nc.\n\n\f\n"


def test_article_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A b", "old"), (2, "a/B", "new"), (3, "C", "c")], "doc_id int, title string, text string")
    writers.write_article_files(rows, str(tmp_path / "d"))
    assert {f: open(tmp_path / "d" / f).read() for f in os.listdir(tmp_path / "d")} == {"a_b.txt": "new\n", "c.txt": "c\n"}


def test_count_tables(spark, tmp_path):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c d", 5)], "ngram string, cnt long")
    writers.write_count_table(counts, str(tmp_path / "k"))
    assert read(tmp_path / "k") == "9\n2\ta\n2\tb\n5\tc d\n"
    writers.write_count_table(counts, str(tmp_path / "f"), by_frequency=True, compression="bzip2")
    packed = sorted(glob.glob(str(tmp_path / "f" / "part-*.bz2")))
    assert "".join(bz2.open(p, "rt").read() for p in packed) == "9\n5\tc d\n2\tb\n2\ta\n"
    back, totals, bad = readers.count_table(spark, str(tmp_path / "f"))
    assert {(r.ngram, r.cnt) for r in back.collect()} == {("a", 2), ("b", 2), ("c d", 5)} and totals.first().total == 9 and bad.count() == 0
    words, n = readers.unigram_dictionary(spark, put(tmp_path / "u.txt", "6\n1\ta\n2\ta\nnonsense\n3\tb\n"))
    assert n == 6 and {(r.word, r.cnt) for r in words.collect()} == {("a", 3), ("b", 3)}
    with pytest.raises(ValueError):
        readers.unigram_dictionary(spark, put(tmp_path / "v.txt", "1\ta\n"))


def test_score_tables(spark, tmp_path):
    pairs = spark.createDataFrame([("b", "a", 1), ("a", "b", 2)], "w string, v string, cnt long")
    writers.write_collocations(pairs, str(tmp_path / "p"))
    assert read(tmp_path / "p") == "2\ta b\n1\tb a\n"
    scores = spark.createDataFrame([(0.5, 2.0, 3, "a", "b")], "norm_mi double, mi double, cnt long, w string, v string")
    writers.write_scores(scores, str(tmp_path / "q"))
    assert read(tmp_path / "q") == "0.5\t2.0\t3\ta\tb\n"
    assert writers.stage(pairs, str(tmp_path / "stage")).count() == 2
    assert writers.sample_head(pairs, 1, "w").first().w == "a"


def test_byte_ranges(spark, tmp_path):
    path = put(tmp_path / "x", "0123456789")
    cut = lambda a, b: bytes(readers.byte_range(spark, path, a, b).first().content)
    assert cut(2, 5) == b"234" and cut(0, 100) == b"0123456789" and cut(8, 99) == b"89" and cut(4, 4) == b""
    with pytest.raises(ValueError):
        readers.byte_range(spark, path, 5, 2)
    pieces = readers.byte_range(spark, path, 1, 9, piece=3)
    assert sorted((r.at, bytes(r.content)) for r in pieces.collect()) == [(1, b"123"), (4, b"456"), (7, b"78")]
    writers.write_bytes(pieces, str(tmp_path / "cut"))
    assert b"".join(open(p, "rb").read() for p in sorted(glob.glob(str(tmp_path / "cut" / "*")))) == b"12345678"


def test_shared_folder(spark):
    class Cluster:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            class _jsc:  # noqa: N801
                @staticmethod
                def sc():
                    return type("c", (), {"getCheckpointDir": lambda self: type("o", (), {"isEmpty": lambda self: True})()})()

    with pytest.raises(RuntimeError):
        workspace.shared_dir(Cluster)
    path = workspace.new_path(spark, "x")
    writers.stage(spark.range(3).toDF("x"), path)
    workspace.delete(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    few = spark.range(5, numPartitions=1).toDF("x")
    assert sorted(r.x for r in readers.dealt(few).collect()) == list(range(5)) and readers.dealt(few).rdd.getNumPartitions() == 4


def test_text_lines(spark, tmp_path):
    assert sorted(r.line for r in readers.text_lines(spark, put(tmp_path / "l", "b\na\n")).collect()) == ["a", "b"]


def test_streams_agree_with_batches(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    texts = ["The cat sat. The dog ran.", "A cat sat! Dogs (some) ran.", "The cat sat."]
    for k, t in enumerate(texts):
        put(tmp_path / "in" / f"{k}.txt", t + "\n")
    lines = streams.read_texts(spark, str(tmp_path / "in"), 1)
    streams.start(streams.ngram_stream(lines), str(tmp_path / "counts"), str(tmp_path / "c1"), "complete").awaitTermination(120)
    batch = ngrams.ngram_counts(streams.token_stream(spark.createDataFrame([(t,) for t in texts], "line string")), n=2)
    got = {(r.ngram, r.cnt) for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    assert got == {(r.ngram, r.cnt) for r in batch.collect()}
    streams.start(streams.token_stream(lines), str(tmp_path / "tokens"), str(tmp_path / "c2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "tokens")).count() == 5
    pairs = streams.collocation_stream(spark.createDataFrame([(texts[0],)], "line string"))
    assert {r.w + r.v for r in pairs.where("w = 'cat'").collect()} == {"catthe", "catcat", "catsat", "catdog", "catran"}


def test_windowed_counts(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", ["a"]), ("2024-01-01 00:00:02", ["a", "b"]), ("2024-01-01 00:10:00", ["a"])], "ts string, words array<string>").withColumn("ts", F.to_timestamp("ts"))
    got = sorted((r.window.start.minute, r.ngram, r.cnt) for r in streams.windowed_counts(rows, "ts", "5 minutes", "1 minute").collect())
    assert got == [(0, "</s>", 2), (0, "a", 2), (0, "b", 1), (10, "</s>", 1), (10, "a", 1)]
