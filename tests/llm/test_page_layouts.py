import pytest

from corpuloom.llm import html


@pytest.mark.parametrize("tag", ["script", "STYLE", "textarea"])
def test_raw_elements_end_behind_letters_that_lower_to_two(tag):
    page = f"<article><p>\u0130stanbul, \u0130zmir.</p><{tag}>x</{tag}><p>Son, metin.</p></article><p>b</p>"
    assert html.main_text(page) == "\u0130stanbul, \u0130zmir.\nSon, metin."


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "with-nav", "legal-news", "search-result-article"])
def test_layout_names_exclude_nothing(name):
    assert html.main_text(f"<body><div class='{name}'><p>One, two.</p><p>Three, four.</p></div></body>") == "One, two.\nThree, four."


def test_a_named_element_around_an_article():
    page = "<body><div class='search sidebar'><p>Menu.</p><article><p>One, two, three.</p></article></div><p>End.</p></body>"
    assert html.main_text(page) == "One, two, three."
    hidden = "<body><div class='search' hidden><article><p>One, two, three, four.</p></article></div><p>End.</p></body>"
    assert html.main_text(hidden) == "End."
    comments = "<body><div><p>Post, of some length.</p></div><div id='comments'><article class='comment'><p>So, very, very, very true, all of it.</p></article></div></body>"
    assert html.main_text(comments) == "Post, of some length."
