import pytest


@pytest.fixture()
def documents(spark):
    """A few rows with every kind of trouble: nulls, empty and long texts, ties, repeated rows, clashing columns."""
    long = "alpha beta gamma " * 4000
    rows = [
        (1, "The cat sat on the mat.", "en", "a"),
        (2, "The cat  sat on\tthe mat.", "en", "a"),
        (3, "the CAT sat on the mat.", "en", None),
        (4, None, None, "b"),
        (5, "", "en", "b"),
        (6, " \n\t ", "en", None),
        (7, long, "en", "c"),
        (7, long, "en", "c"),
        (8, long + "delta", "en", "c"),
        (None, "The cat sat on the mat.", "en", "a"),
        (10, "x" * 50_000, "de", "a"),
        (11, "é́ Σίσυφος ΣΑΣ 日本語 <|endoftext|> don't", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "noise", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, id int")


@pytest.fixture()
def no_documents(documents):
    return documents.where("false")
