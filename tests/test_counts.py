import pytest
from pyspark.sql import functions as F

from corpuloom.functions.text import words_of
from corpuloom.operators import association, collocations, ngrams, sentences

LINES = ["red cat sat", "red cat", " \t "]
COUNTS = {
    1: {"</s>": 2, "cat": 2, "red": 2, "sat": 1},
    2: {"<s> red": 2, "cat </s>": 1, "cat sat": 1, "red cat": 2, "sat </s>": 1},
    3: {"<s> <s> red": 2, "<s> red cat": 2, "cat sat </s>": 1, "red cat </s>": 1, "red cat sat": 1},
}
GROUPS = [(0, 0, ["a", "b", "a"]), (0, 1, ["c"]), (0, 2, ["d"]), (1, 0, ["a"])]
PAIRS = {"aa": 3, "ab": 2, "ac": 2, "ba": 1, "bb": 1, "bc": 1, "ca": 1, "cb": 1, "cc": 1, "cd": 1, "dc": 1, "dd": 1}


@pytest.fixture()
def words(spark):
    return spark.createDataFrame([(x,) for x in LINES], "line string").withColumn("words", words_of(F.col("line")))


@pytest.fixture()
def neighbours(spark):
    return spark.createDataFrame([(7, p, s, w) for p, s, w in GROUPS], "doc_id int, para_id int, sent_id int, words array<string>")


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(words, n):
    counts = ngrams.ngram_counts(words, n=n)
    assert {r.ngram: r.cnt for r in counts.collect()} == COUNTS[n]
    assert ngrams.total(counts).first().total == 7
    assert {r.ngram: r.cnt for r in ngrams.ngram_counts(words.repartition(5), n=n).collect()} == COUNTS[n]


def test_n_must_be_positive(words):
    with pytest.raises(ValueError):
        ngrams.ngram_counts(words, n=0)


def test_filter_merge_order(words):
    counts = ngrams.ngram_counts(words, n=2)
    kept, total = ngrams.filtered_with_total(counts, 2)
    assert {r.ngram for r in kept.collect()} == {"<s> red", "red cat"} and total.first().total == 4
    assert ngrams.at_least(kept, 2).exceptAll(kept).isEmpty()
    assert [r.ngram for r in ngrams.by_frequency(counts).collect()] == ["red cat", "<s> red", "sat </s>", "cat sat", "cat </s>"]
    assert [r.ngram for r in ngrams.top(counts, 2).collect()] == ["red cat", "<s> red"]
    assert [r.ngram for r in ngrams.in_key_order(counts).collect()] == sorted(COUNTS[2])
    one, two = ngrams.merge(counts, kept), ngrams.merge(kept, counts)
    assert one.exceptAll(two).isEmpty() and {r.ngram: r.cnt for r in one.collect()}["red cat"] == 4
    assert ngrams.check_total(counts, ngrams.total(counts)).first().matches
    assert not ngrams.check_total(counts, ngrams.total(one)).first().matches


def test_byte_order(spark):
    rows = spark.createDataFrame([(x, 1) for x in ["é", "z", "a", "A", "</s>", "a b"]], "ngram string, cnt long")
    assert [r.ngram for r in ngrams.in_key_order(rows).collect()] == ["</s>", "A", "a", "a b", "z", "é"]


def test_empty_counts(words):
    none = ngrams.ngram_counts(words.where("false"), n=2)
    assert none.collect() == [] and ngrams.total(none).first().total == 0


def test_collocations(neighbours):
    got = collocations.collocations(neighbours)
    assert {r.w + r.v: r.cnt for r in got.collect()} == PAIRS
    assert {r.w + r.v: r.cnt for r in collocations.collocations(neighbours.repartition(3)).collect()} == PAIRS


def test_collocations_within_a_row(spark):
    docs = spark.createDataFrame([(1, [["a", "b", "a"], ["c"], ["d"]]), (2, [["a"]]), (3, [])], "doc_id int, sentences array<array<string>>")
    got = collocations.pair_counts(collocations.with_context_in_document(docs))
    assert {r.w + r.v: r.cnt for r in got.collect()} == PAIRS


def test_pruning_changes_no_count_that_stays(neighbours):
    unigrams = ngrams.dictionary(ngrams.ngram_counts(neighbours, n=1))
    kept = collocations.pruned(neighbours, unigrams, 2)
    assert {r.w + r.v: r.cnt for r in collocations.collocations(kept).collect()} == {"aa": 3}
    shuffled = collocations.pruned(neighbours, unigrams, 1, most_broadcast=0)
    assert {r.w + r.v: r.cnt for r in collocations.collocations(shuffled).collect()} == PAIRS


def test_association(neighbours):
    unigrams = ngrams.dictionary(ngrams.ngram_counts(neighbours, n=1))
    pairs = collocations.collocations(neighbours)
    n = ngrams.total(ngrams.ngram_counts(neighbours, n=1)).first().total
    assert n == 10
    got = {r.w + r.v: (r.norm_mi, r.mi) for r in association.association(pairs, unigrams, n).collect()}
    assert got["aa"] == (1.0, pytest.approx(100 / 9))
    assert got["ab"] == (pytest.approx(2.0), pytest.approx(200 / 9)) and got["ac"][0] == pytest.approx(2.0)
    assert [r.w + r.v for r in association.association(pairs, unigrams, n, 2).collect()] == ["aa"]
    without = association.association(pairs.where("not (w = 'a' and v = 'a')"), unigrams, n)
    assert all(r.norm_mi is None for r in without.where("w = 'a'").collect())
    order = [(r.w, r.v) for r in association.in_score_order(association.association(pairs, unigrams, n)).collect()]
    assert order[:3] == [("a", "b"), ("a", "c"), ("a", "a")]
    assert {r.w + r.v for r in association.unknown(pairs, unigrams.where("word <> 'd'")).collect()} == {"cd", "dc", "dd"}


def test_two_words(spark):
    rows = spark.createDataFrame([("a b", 2), ("a", 1), ("a b c", 1), (" a  c ", 3)], "ngram string, cnt long")
    assert [(r.w, r.v, r.cnt) for r in association.two_words(rows).collect()] == [("a", "b", 2), ("a", "c", 3)]


def test_lines_and_paragraphs(spark):
    docs = spark.createDataFrame([(1, "a\nb\n\nc\n\n\nd"), (2, "x"), (3, None), (4, "")], "doc_id int, text string")
    numbered = sentences.number_paragraphs(sentences.lines(docs))
    assert [(r.line, r.para_id) for r in numbered.where("doc_id = 1").orderBy("line_id").collect()] == [("a", 0), ("b", 0), ("", 1), ("c", 1), ("", 2), ("", 3), ("d", 3)]
    assert sentences.not_blank(sentences.lines(docs)).count() == 5
    long = spark.createDataFrame([(1, "é" * 4096), (1, "e" * 8191)], "doc_id int, line string")
    assert [len(r.line) for r in sentences.short_lines(long).collect()] == [8191]
