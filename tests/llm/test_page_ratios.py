"""What the ratios decide where no tag or class says anything: pages of div elements alone."""

import random
import time
from collections import Counter

import pytest

from corpuloom.llm import html


def page_and_text(rnd: random.Random) -> tuple[str, str]:
    """A page without any telling tag or class: menu, teasers, article, comments or notices, footer; and its article."""
    word = lambda: "".join(rnd.choice("ba ke lo mi tu ra so ne".split()) for _ in range(rnd.randint(1, 4)))

    def sentence(low, high):
        words = [word() for _ in range(rnd.randint(low, high))]
        return (" ".join(words[: len(words) // 2]) + ", " + " ".join(words[len(words) // 2 :])).capitalize() + "."

    title = " ".join(word() for _ in range(6)).capitalize()
    paragraphs = [" ".join(sentence(8, 20) for _ in range(rnd.randint(2, 6))) for _ in range(rnd.randint(3, 9))]
    items = [" ".join(word() for _ in range(5)) for _ in range(rnd.randint(0, 4))]
    menu = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(rnd.randint(4, 12)))
    teasers = "".join(f"<div><div><a href='#'>{' '.join(word() for _ in range(6))}</a></div><div>{sentence(8, 16)}</div></div>" for _ in range(rnd.randint(5, 14)))
    remarks = "".join(f"<div><div>{word()} {word()}</div><span>{sentence(5, 14)}</span></div>" for _ in range(rnd.randint(2, 12)))
    footer = " ".join(sentence(6, 12) for _ in range(rnd.randint(1, 3)))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{x}</p>" for x in paragraphs) + (f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if items else "")
    parts = [f"<div><ul>{menu}</ul></div>", f"<div>{sentence(4, 9)}</div>", f"<div>{body}</div>", f"<div>{remarks}</div>", f"<div>{footer}</div>"]
    parts.insert(rnd.choice([1, 2, 3]), f"<div>{teasers}</div>")
    return f"<html><body>{''.join(parts)}</body></html>", "\n".join([title, *paragraphs, *items])


def f1(a: str, b: str) -> float:
    x, y = Counter(a.split()), Counter(b.split())
    return 2 * sum((x & y).values()) / max(1, sum(x.values()) + sum(y.values()))


def mean_f1(pages, share):
    return sum(f1(html.main_text(p, share), t) for p, t in pages) / len(pages)


def test_the_threshold_finds_the_article():
    rnd = random.Random(8)
    pages = [page_and_text(rnd) for _ in range(300)]
    with_it, without = mean_f1(pages, 0.3), mean_f1(pages, -1)
    print(f"word F1 with the threshold {with_it:.3f}, without {without:.3f}")
    assert with_it > 0.97 and without < with_it - 0.1
    assert sum(html.main_text(p) == t for p, t in pages) > 250


def test_names_don_t_decide():
    """The same pages with names that speak for the menu and against the article's wrapper."""
    rnd = random.Random(9)
    pages = [page_and_text(rnd) for _ in range(100)]
    misled = [(p.replace("<html><body>", "<html><body><div class='search sidebar'>").replace("</body>", "</div></body>"), t) for p, t in pages]
    assert mean_f1(misled, 0.3) > 0.97


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<div>", "<b>", "<p>x", "<div>x", "</x>", "<li>x", "<", "<!--", "<a href='", "<td>x", "<p><b>", "<hr>", "&amp;", "<!", "<table><tr>"])
def test_a_megabyte_of_anything_takes_seconds(unit):
    for page in (unit * (1_000_000 // len(unit)), "<b>" * 100_000 + unit * 100_000):
        began = time.process_time()
        html.main_text(page)
        assert time.process_time() - began < 10
