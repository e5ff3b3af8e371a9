import random
import time

import pytest

from corpuloom.operators import articles, markup

CASES = [
    ("see [[Target|label]] now", "see label now"),
    ("see [Target|label] now", "see label now"),
    ("see [[plain]] now", "see plain now"),
    ("x [http://h.org lbl] y", "x  y"),
    ("x [[fr:Autre]] y", "x  y"),
    ("a [ b", "a [ b"),
    ("p [[File:z.png|cap]] q", "p \n\ncap\n\n q"),
    ("p [[image:z.png|thumb|a [[b|c]] d]] q", "p \n\na c d\n\n q"),
    ("a<!-- n\nm -->b", "ab"),
    ("a<ref>n</ref>b", "ab"),
    ("a<ref name='x'/>b", "ab"),
    ("a<br/>b", "a\nb"),
    ("a<br />b", "a\nb"),
    ("a<br>b", "a"),
    ("a<br>", "a\n"),
    ("a {{t|{{u}}}} b", "a  b"),
    ("a {{never closed", "a "),
    ("a {single} b", "a {single} b"),
    ("{| x\n| y\n|}z", "z"),
    ("a\n | row\nb", "a\n b"),
    ("a | b", "a | b"),
    ("* a\n* b\n", "a\n\n\nb\n\n\n"),
    ("- a <!-- c -->x", "a \n\nx"),
    ("a * b - c", "a * b - c"),
    (":a : b", "a : b"),
    ("== H ==\nx", "H\n\n\nx"),
    ("a = b = c", "a b\n\n c"),
    ("a = b", "a = b"),
    ("x\n==References==\ny", "x\n"),
    ("x\n== Further reading ==\ny", "x\n"),
    ("'''b''' ''i'' don't", "b i don't"),
    ("", ""),
]


@pytest.mark.parametrize("text, expected", CASES)
def test_rules(text, expected):
    assert markup.plain_text(text).lstrip("\n\r ") == expected


@pytest.mark.parametrize("unit", ["[ ", "[[a|", "{{ ", "< ", "* a\n", "a | ", "= a", "="])
def test_long_markup_takes_linear_time(unit):
    began = time.process_time()
    try:
        markup.plain_text(unit * 60_000)
    except RecursionError:
        pass
    assert time.process_time() - began < 10


def test_runs_of_equal_signs_match_as_the_pattern_does():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(["=" * 17, "=" * 20, "=" * 40, "=", "a", " ", "\n"]) for _ in range(rnd.randint(0, 7)))
        at = text.find("=")
        if at >= 0:
            got, want = markup._Article(text, False).heading(at, len(text)), markup.HEADING.match(text, at)
            assert (got and (got.span(), got[2])) == (want and (want.span(), want[2])), text


def test_headings_left_out():
    assert markup.plain_text("== H ==\nx", ignore_headings=True).strip() == "x"


def test_a_bad_article_never_fails_the_job(spark):
    rows = [(1, "T", "fine"), (2, "U", "line one\nab <!-- open"), (3, "V", None), (4, "W", "* x [[a|<!-- b]]"), (5, "X", "[" * 5000 + "]" * 5000)]
    got = {r.doc_id: r for r in markup.textify(spark.createDataFrame(rows, "doc_id int, title string, markup string")).collect()}
    assert got[1].text == "fine" and got[1].error is None
    assert got[2].text is None and (got[2].error.line, got[2].error.col) == (2, 4) and got[2].error.snippet == "<!-- open"
    assert got[3].text is None and got[3].error is None
    assert got[4].text is None or got[4].error is None
    assert (got[5].text is None) != (got[5].error is None)


def test_snippets():
    assert markup.snippet("x" * 29, 0) == "x" * 29
    assert markup.snippet("x" * 40, 0) == "x" * 26 + "..."
    assert markup.place_of("ab\ncd", 4) == (2, 2)


def test_unescape(spark):
    rows = spark.createDataFrame([(1, "&amp;nbsp; &#233; &eacute; &noend"), (2, "plain"), (3, None)], "k int, t string")
    assert {r.k: r.t for r in markup.unescape(rows, "t").collect()} == {1: "&nbsp; é é &noend", 2: "plain", 3: None}


def test_articles(spark):
    pages = spark.createDataFrame(
        [("Foo", "t", False), ("R", "t", True), ("Category:A", "t", False), ("wikipedia:B", "t", False), ("TEMPLATE:C", "t", False), ("File:D.png", "t", False), ("Foo: Bar", "t", False), ("Empty", "", False), ("None", None, False), (None, "t", None)],
        "title string, markup string, is_redirect boolean",
    )
    assert [r.title for r in articles.articles(pages).collect()] == ["Foo", "File:D.png", "Foo: Bar", "Empty"]
    assert sorted(r.reason for r in articles.rejected(pages).collect()) == ["no text", "no title"]
    assert "File:D.png" not in [r.title for r in articles.articles(pages, ("file",)).collect()]
