import random

import pytest

from corpuloom.llm import html, urls
from corpuloom.llm.queries import RULES

PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>Head</h1><p><b>One two.<br><p>Three &amp; four,\n five.</p></article><footer>&copy; x</footer></body></html>", "Head\nOne two.\nThree & four, five."),
    ("<body><header>Site</header><div class='content'><h2>T</h2><p>One two, three.<p>Four&nbsp;five.<ul><li>a<li>b</ul></div><div class=sidebar>x y z, a.</div><section id=comments><p>Nice, really nice post.</p></section><form>q<input></form></body>", "T\nOne two, three.\nFour five.\na\nb"),
    ("<div class='ad'>Buy, now.</div><article><p>Text.</p><div class='cookie-notice'>We, use.</div><aside>more</aside></article>", "Text."),
    ("<div class='header'>Site, name.</div><article><div class='header'>Head</div><p>One, two.</p><div class='user-comment'>So, true.</div></article>", "Head\nOne, two."),
    ("<article><p>Hello <span class='ad'>buy</span> big <noscript><p>x</p></noscript>world.</p></article>", "Hello big world."),
    ("<script>var t='</p>';</script><!-- <p>x</p> --><p>Only this.", "Only this."),
    ("plain text", "plain text"),
    ("<p>a < b and c > d</p>", "a < b and c > d"),
    ("<article>x &#xD800; y</article>", "x � y"),
    ("", ""),
    (None, ""),
    ("<nav>only a menu</nav>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_long_and_broken_pages():
    many = "<article>" + "<p>Some words, here.</p>" * 20_000 + "</article>"
    assert html.main_text(many).count("\n") == 19_999
    for broken in ("<div" * 500, "<p class='x>never closed", "<" * 5000, "<article><p>a</div></article></p>b", "<b>" * 3000 + "deep"):
        html.main_text(broken)


def test_over_a_table(spark):
    rows = [(k, f"http://h/{k}", p, 5) for k, (p, _) in enumerate(PAGES)] + [(0, "http://h/0", PAGES[0][0], 5), (None, None, PAGES[0][0], 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.text, r.n_chars) for r in html.main_texts(pages).collect()}
    assert got == {(k, t, len(t)) for k, (_, t) in enumerate(PAGES)} | {(None, PAGES[0][1], len(PAGES[0][1]))}
    assert html.main_texts(pages).count() == len(rows)
    assert html.main_texts(pages.where("false")).collect() == []


URLS = [
    ("https://Blog.X.Example.COM/en/1?q#f", "blog.x.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
    ("https://example.com", "example.com", "", None, "allow"),
    ("http://x.net/es/a", "x.net", "/es/a", "net/es/", "block"),
    ("http://xnet/es/a", "xnet", "/es/a", None, "allow"),
    ("http://x.net#/es/", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(k, u[0], None) for k, u in enumerate(URLS)], "page_id long, url string, html string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, RULES).collect())
    assert got == [(k, *u[1:]) for k, u in enumerate(URLS)]
    assert urls.judge(pages.where("false"), RULES).collect() == []


def test_decisions_reach_aliases(spark):
    canonical = "<head><link rel='canonical' href='{}'></head>".format
    rows = [
        (1, "http://a.org/1", canonical("http://x.net/es/1")),  # alias of a blocked url that is no page
        (2, "http://b.org/2#top", '<meta http-equiv="refresh" content="0; url=/3">'),
        (3, "http://b.org/3", canonical("http://a.org/1")),  # two steps away
        (4, "http://c.org/4", canonical("http://d.org/5")),
        (5, "http://d.org/5", canonical("http://q.com/ok")),  # a class with an allowed url ...
        (6, "http://x.net/fr/6", canonical("http://d.org/5")),  # ... and a blocked one: its own rule still blocks it
        (7, "http://e.org/7", "<!-- <link rel=canonical href='http://x.net/es/1'> -->"),
        (8, "http://b.org/2", None),  # the same url without its fragment
        (9, "http://f.org/9", None),
        (9, "http://f.org/9", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    more = spark.createDataFrame([("http://f.org/9", "http://x.net/es/9"), (None, "http://x.net/es/9")], "a string, b string")
    got = sorted((r.page_id, r.verdict) for r in urls.judge(pages, RULES, more).collect())
    assert got == [(1, "block"), (2, "block"), (3, "block"), (4, "allow"), (5, "allow"), (6, "block"), (7, "allow"), (8, "block"), (9, "block"), (9, "block")]


def test_long_chains_and_hubs(spark):
    chain = [(k, f"http://h.org/{k}", f"<link rel=canonical href=http://h.org/{k + 1}>") for k in range(120)]
    hub = [(1000 + k, f"http://i.org/{k}", "<link rel=canonical href=http://hub.net/fr/>") for k in range(300)]
    chain[-1] = (119, "http://h.org/119", "<link rel=canonical href=http://x.net/es/>")
    got = urls.judge(spark.createDataFrame(chain + hub, "page_id long, url string, html string"), RULES).collect()
    assert len(got) == 420 and all(r.verdict == "block" for r in got)


@pytest.mark.parametrize("seed", range(2))
def test_verdicts_on_random_graphs_against_union_find(spark, seed):
    """Random redirects and canonical links among urls of ruled and open hosts; also columns that clash with inner names."""
    rnd = random.Random(seed)
    hosts = ["a.org", "b.org", "c.org", "x.net", "q.com", "www.example.com", "example.com"]
    urls_ = [f"http://{rnd.choice(hosts)}/{rnd.choice(['es', 'fr', 'en', 'x'])}/{k}" for k in range(160)]
    links = [(u, rnd.choice(urls_)) for u in rnd.sample(urls_, 70)]
    redirects = [(rnd.choice(urls_), rnd.choice(urls_)) for _ in range(20)]
    to = dict(links)
    pages = [(k, u, f"<head><link rel=canonical href='{to[u]}'></head>" if u in to else None, "v", 1) for k, u in enumerate(urls_)]
    parent = {u: u for u in urls_}

    def find(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for a, b in links + redirects:
        parent[find(a)] = find(b)
    index = urls.rule_index(RULES)
    own = {u: urls.decide(index, *u[7:].split("/", 1)[:1], "/" + u[7:].split("/", 1)[1]) for u in urls_}
    classes = {}
    for u in urls_:
        classes.setdefault(find(u), []).append(own[u][1])
    expected = []
    for k, u in enumerate(urls_):
        aliases = classes[find(u)]
        verdict = own[u][1] or ("block" if "block" in aliases and "allow" not in aliases else "allow")
        expected.append((k, own[u][0], verdict))
    table = spark.createDataFrame(pages, "page_id long, url string, html string, node string, rule int")
    got = urls.judge(table, RULES, spark.createDataFrame(redirects, "u string, v string")).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in got) == expected
    assert {v for _, r, v in expected if r is None} == {"allow", "block"}


def test_rules_are_checked():
    with pytest.raises(ValueError):
        urls.rule_index([urls.Rule("maybe", "com", "/")])
