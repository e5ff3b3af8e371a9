"""The rules of the sentence splitter and the tokenizer, a case each."""

import pytest
from pyspark.sql import functions as F

from corpuloom.functions import text as T
from corpuloom.operators.sentences import sentences

SENTENCES = [
    ("One here. Two here", [["One here.", "Two here"]]),
    ("Ships of the U.K. sail. Done", [["Ships of the U.K. sail.", "Done"]]),
    ("Ann B. Roe Sr. spoke.", [["Ann B. Roe Sr. spoke."]]),
    ("It was grade 5. Then", [["It was grade 5. Then"]]),
    ('They said "go." Then', [['They said "go."', "Then"]]),
    ("What? Yes! a; b", [["What?", "Yes!", "a;", "b"]]),
    ("No?! ok", [["No?", "!", "ok"]]),
    ('Stop!" she said', [["Stop!", '" she said']]),
    ("A one.\n\nB two.", [["A one."], ["B two."]]),
    ("left\nright", [["left right"]]),
    ("a   b \t c", [["a b c"]]),
    ("  \n\n lead", [["lead"]]),
    ("end.", [["end."]]),
    ("see the U.S.\nnext line", [["see the U.S.", "next line"]]),
    ("for e.g. This one", [["for e.g. This one"]]),
    ("para one\n\n\npara two", [["para one"], ["para two"]]),
    ("trailing blank \n\nb", [["trailing blank "], ["b"]]),
    ("tab\tkept", [["tab\tkept"]]),
    ("", []),
    (None, []),
]

TOKENS = [
    ({}, "Cats, Dogs: run!", "cats dogs run"),
    ({}, "In the U.K. e.g. here", "in the u.k. e.g. here"),
    ({}, "x e.g., y", "x e g y"),
    ({}, "one (two) three", "one three"),
    ({}, "a(b)c", "ac"),
    ({}, "a ) b", "a"),
    ({}, "a ( b", "a"),
    ({}, "a (see U.K. law) b", "a u.k. b"),
    ({"parens": True}, "a (b)", "a ( b )"),
    ({"parens": True}, "a ) b ((c", "a ) b ( ( c"),
    ({}, "'tis the dogs' bone", "tis the dogs' bone"),
    ({}, "gov't ''quoted'' (x)'y", "gov't quoted'' y"),
    ({}, "1,000,000 and 3.14", "1,000,000 and 3 14"),
    ({}, "1, 2,x ,3", "1 2 x 3"),
    ({}, "1,(x)2", "1 2"),
    ({}, "about 3.5", "about 3.5"),
    ({"keep": ","}, "a, b", "a , b"),
    ({"keep": ","}, "1,000", "1 , 000"),
    ({"keep": "z+"}, "z + a", "z + a"),
    ({"keep": "'"}, "''tis gov't", "' ' tis gov't"),
    ({"keep": "."}, "The U.S. is. So", "the u.s. is . so"),
    ({"keep_case": True}, "Ab U.S. C", "Ab U.S. C"),
    ({"unicode_case": True}, "ÉCOLE", "école"),
    ({}, "Óscar —x– y ”z−w", "Óscar x y z w"),
    ({}, "...", ""),
    ({}, "", ""),
    ({}, "tabs\tand\x0bmore\x0c", "tabs and more"),
]


def test_sentences(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(SENTENCES)], "doc_id int, text string")
    got = {}
    for r in sentences(docs).collect():
        got.setdefault(r.doc_id, {})[r.para_id, r.sent_id] = r.sentence
    for k, (text, expected) in enumerate(SENTENCES):
        want = {(p, s): x for p, para in enumerate(expected) for s, x in enumerate(para)}
        assert got.get(k, {}) == want, repr(text)


@pytest.mark.parametrize("options", [dict(x) for x in {tuple(o.items()) for o, _, _ in TOKENS}], ids=str)
def test_tokens(spark, options):
    cases = [(t, e) for o, t, e in TOKENS if o == options]
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, t string").orderBy("k")
    got = [r.w for r in rows.select(F.array_join(T.tokenize(F.col("t"), **options), " ").alias("w")).collect()]
    assert got == [e for _, e in cases]


def test_long_runs_of_abbreviations(spark):
    """Runs that a regex must not recurse over; they are one word each, or one sentence."""
    runs = ["a." * 100_000, "Ab." * 100_000, "U.S." + " " * 1_000_000 + "end", "see " + "a." * 50_000 + "bc d", "(" * 20_000 + "x" + ")" * 20_000]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(runs)], "doc_id int, text string")
    words = {r.doc_id: r.w for r in rows.select("doc_id", T.tokenize(F.col("text")).alias("w")).collect()}
    assert words[0] == [runs[0]] and words[1] == [runs[1].lower()] and words[2] == ["u.s.", "end"] and words[3][0] == "see" and words[4] == []
    assert sentences(rows).where("doc_id < 4").count() == 4


def test_null_line(spark):
    assert spark.createDataFrame([(None,)], "t string").select(T.tokenize(F.col("t")).alias("w")).first().w is None


def test_titles(spark):
    rows = spark.createDataFrame([("A  b/C d",), ("Ünder Score",), (None,)], "t string")
    assert [r.s for r in rows.select(T.title_slug(F.col("t")).alias("s")).collect()] == ["a_b_c_d.txt", "ünder_score.txt", None]
    rows = spark.createDataFrame([("Category:X",), ("a: b: c",), ("none",)], "t string")
    assert [r.s for r in rows.select(T.namespace(F.col("t")).alias("s")).collect()] == ["category", "a", None]


def test_count_lines(spark):
    lines = ["12\ta b", "7\tx\r", "bad\ty", "3\tp\tq", "none"]
    rows = spark.createDataFrame([(x,) for x in lines], "t string").select(T.count_of(F.col("t")).alias("n"), T.key_of(F.col("t")).alias("k"))
    assert [(r.n, r.k) for r in rows.collect()] == [(12, "a b"), (7, "x"), (0, "y"), (3, "p\tq"), (0, "")]


@pytest.mark.parametrize("text, size", [("512", 512), ("512b", 512), ("2k", 2048), ("500M", 500 << 20), ("1g", 1 << 30)])
def test_sizes(text, size):
    assert T.parse_size(text) == size


@pytest.mark.parametrize("text", ["", "k", "-1", "1t", "1.5m"])
def test_bad_sizes(text):
    with pytest.raises(ValueError):
        T.parse_size(text)


def test_unescape_goes_one_level(spark):
    row = spark.createDataFrame([("&amp;lt; &lt;b&gt; &quot;&apos;&nbsp;",)], "t string").select(T.unescape_common(F.col("t")).alias("u")).first()
    assert row.u == "&lt; <b> \"'\xa0"
