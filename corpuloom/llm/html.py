"""Main text of web pages by tag-path ratios.

A page is cut into text blocks, each with the path of tags from the root to it (a tag with its class is another step
than the tag alone). For every path the length of text outside links and the number of punctuation marks are summed
and both taken per block; the two ratios are fused by multiplication and weighted by the number of blocks, so that a
path of many sentences stands out. The scores are smoothed over neighbouring blocks, the more the closer these stand in
the tree, and compared with a threshold relative to the page's highest. The blocks that pass point to the content
node: from the root down, the element that holds nearly all of their score. Its blocks are the main text, but for
runs of links and what a name speaks against that doesn't pass.

Only what HTML itself says isn't text of the page goes by its tag (scripts, styles, forms and their controls, hidden
elements) or is by definition beside the main text (nav, footer, aside, header outside an article). An article or
main element, and a class such as ad or comment, are evidence: a factor of the score, never a decision.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
#: For the rest of a page with a quote that never ends: a tag ends at the next >.
LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？؟،]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup: skipped to their end tag.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
RAW_END = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW}
SKIPPED = frozenset("script style template noscript head nav footer aside form button select textarea option dialog menu iframe object svg canvas audio video label fieldset".split())
BLOCK = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption table thead tbody tfoot tr caption header footer nav aside form address hr details summary center fieldset menu hgroup".split())
CELL = frozenset(("td", "th"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements of running text: the content node is never one of them, but what they stand in.
LEAF = HEADING | frozenset("p li dt dd pre blockquote figcaption caption tr td th summary address".split())
#: A start tag of the key ends an open element of the value, as long as no element of BARRIER stands between.
P_ENDS = BLOCK - {"html", "body"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Within running text only what names itself an advert is left out.
INLINE_AGAINST = re.compile(r"(?:^|\s)(?:ads?|advert|advertisement|sponsored)(?=\s|$)", re.I)
#: Names that speak against an element, as a whole token of a class or id or its last part.
AGAINST = re.compile(r"(?:^|\s)(?:[\w]+[-_])*(?:ads?|advert|advertisement|promo|sponsored|banner|cookies?|consent|notice|popup|newsletter|sidebar|navbar|menu|breadcrumbs?|footer|share|social|related|comments?|search)(?=\s|$)", re.I)
SITE_AGAINST = re.compile(r"(?:^|\s)(?:[\w]+[-_])*header(?=\s|$)", re.I)  # outside an article
LAYOUT = re.compile(r"(?:^|(?<=\s))(?:(?:no|has|with|without)[-_]\S+)(?=\s|$)", re.I)


class Page:
    """The tree of a page's elements, by number: parent, depth, tag, path (a number for each root-to-element path), weight."""

    def __init__(self):
        self.parent, self.depth, self.tag, self.path, self.weight = [0], [0], [""], [0], [1.0]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []

    def add(self, above: int, tag: str, name: str, weight: float) -> int:
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[above], f"{tag} {name}"), len(self.paths) + 1))
        self.weight.append(self.weight[above] * weight)
        return len(self.tag) - 1

    def shared(self, a: int, b: int) -> float:
        """How near two elements stand: twice the depth of what holds both, over the sum of their depths."""
        depth, parent = self.depth, self.parent
        whole = depth[a] + depth[b]
        while a != b:
            if depth[a] >= depth[b]:
                a = parent[a]
            else:
                b = parent[b]
        return 2 * depth[a] / whole if whole else 1.0


class Block:
    """A run of text between block tags: the element it stands in, its text, how much of it is in links."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, node: int, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


def attributes_of(tag: str, attributes: str, in_article: bool) -> tuple[bool, str, float]:
    """(excluded, class, weight): whether the element isn't text of the page, and what its names say for or against it."""
    gone = tag in SKIPPED or (tag == "header" and not in_article)
    weight = 10.0 if tag in ("article", "main") and not in_article else 1.0
    if not attributes or gone:
        return gone, "", weight
    name = ""
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            gone = True
        elif key == "role":
            gone |= value.lower() in ROLES
        elif key in ("class", "id"):
            if key == "class":
                name = " ".join(value.split())
            if tag not in BLOCK and tag not in CELL:
                gone |= bool(INLINE_AGAINST.search(value))
            elif tag not in ("html", "body") and (AGAINST.search(bare := LAYOUT.sub("", value)) or not in_article and SITE_AGAINST.search(bare)):
                weight = 0.05
    return gone, name, weight


def page_of(html: str) -> Page:
    """The page's tree and its text blocks in order, those of excluded elements left out. White space is one space,
    ends trimmed. Time is in proportion to the length of the page, whatever is in it."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, element that text stands in, excluded
    opened: dict[str, int] = {}  # how many elements of a tag are open
    parts: list[str] = []
    linked, at, end, tag_of = 0, 0, len(html), TAG

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:  # of excluded elements nothing is ever in parts
                page.blocks.append(Block(stack[-1][1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop_to(k: int):
        for tag, _, _ in stack[k:]:
            opened[tag] -= 1
        del stack[k:]

    def innermost(tags) -> int:
        """The place on the stack of the innermost open element of these tags, or 0."""
        if not any(opened.get(t) for t in tags):
            return 0
        k = len(stack) - 1
        while stack[k][0] not in tags:
            k -= 1
        return k

    def ended_by(tags, barrier) -> int:
        """The same, but 0 as soon as an element of barrier stands in between."""
        if not any(opened.get(t) for t in tags):
            return 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in barrier:
                return 0
        return 0

    def put(low: int, high: int):
        nonlocal linked
        if high > low and not stack[-1][2]:
            parts.append(html[low:high])
            if opened.get("a"):
                linked += high - low

    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            put(at, end)
            break
        put(at, lt)
        sign = html[lt + 1 : lt + 2]
        if sign in ("!", "?"):
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 4)
                at = end if close < 0 else close + 3
            else:
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
            continue
        m = None
        if sign == "/" or sign.isalpha():
            m = tag_of.match(html, lt)
            if m is None and sign.isalpha() and tag_of is TAG:
                tag_of = LOOSE_TAG
                m = tag_of.match(html, lt)
            if m is None and html.find(">", lt) < 0:  # no tag ends any more
                put(lt, end)
                break
        if m is None:
            put(lt, lt + 1)
            at = lt + 1
            continue
        at = m.end()
        tag = m[1].lower()
        if sign == "/":
            k = innermost((tag,))
            if k:
                if not stack[k][2] and any(x[0] in BLOCK for x in stack[k:]):
                    flush()
                elif tag in CELL:
                    parts.append(" ")
                pop_to(k)
            elif tag == "p":
                flush()
            continue
        within = stack[-1][2]  # in an excluded element: its tags part nothing outside
        if not within:
            if tag == "br" or tag in CELL:
                parts.append(" ")
            if tag in BLOCK:
                flush()
                if tag in P_ENDS and (k := ended_by(("p",), BLOCK | CELL)):
                    pop_to(k)
            if tag in CLOSES and (k := ended_by(CLOSES[tag], BARRIER[tag])):
                flush()
                pop_to(k)
        if tag in VOID:
            continue
        above = stack[-1][1]
        gone, name, weight = (True, "", 1.0) if within else attributes_of(tag, m[2], bool(opened.get("article") or opened.get("main")))
        node = above
        if not gone and (tag in BLOCK or tag in CELL):
            node = page.add(above, tag, name, weight)
        stack.append((tag, node, gone))
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW:
            stack[-1] = (tag, node, True)
            close = RAW_END[tag].search(html, at)
            at = close.start() if close else end
    flush()
    return page


def scores(page: Page) -> list[float]:
    """The fused, smoothed score of each block by the ratios of its path."""
    sums: dict[int, list[float]] = {}
    for b in page.blocks:
        s = sums.setdefault(page.path[b.node], [0.0, 0.0, 0.0])
        s[0] += len(b.text) - b.linked  # the text of links is no sign of content
        s[1] += len(PUNCTUATION.findall(b.text)) if b.linked < len(b.text) else 0
        s[2] += 1
    fused = {}
    for path, (length, marks, n) in sums.items():
        fused[path] = (length / n) * ((marks + 0.5) / n) * n
    raw = [fused[page.path[b.node]] for b in page.blocks]
    near = [page.shared(a.node, b.node) ** 2 for a, b in zip(page.blocks, page.blocks[1:])]
    out = []
    for k, own in enumerate(raw):
        before = raw[k - 1] * near[k - 1] if k else 0.0
        behind = raw[k + 1] * near[k] if k + 1 < len(raw) else 0.0
        out.append((0.5 * own + 0.25 * before + 0.25 * behind) * page.weight[page.blocks[k].node])
    return out


def content_blocks(page: Page, share: float = 0.3, most: float = 0.75) -> list[Block]:
    """The blocks of the content node. share: the threshold, of the highest score; most: what the node has to hold."""
    blocks = page.blocks
    if not blocks:
        return []
    score = scores(page)
    least = share * max(score)
    passes = [s >= least for s in score]
    mass = [0.0] * len(page.tag)
    for b, ok in zip(blocks, passes):
        if ok:
            mass[b.node] += len(b.text) - b.linked
    for node in range(len(mass) - 1, 0, -1):
        mass[page.parent[node]] += mass[node]
    best = [0] * len(mass)
    for node in range(1, len(mass)):
        above = page.parent[node]
        if page.tag[node] not in LEAF and (not best[above] or mass[node] > mass[best[above]]):
            best[above] = node
    node = 0
    while best[node] and mass[best[node]] >= most * mass[node]:
        node = best[node]
    inside = [False] * len(mass)
    inside[node] = True
    for k in range(1, len(mass)):
        inside[k] = inside[k] or inside[page.parent[k]]
    held = [inside[b.node] for b in blocks]
    first = held.index(True) if True in held else 0
    # Headings right before the content node belong to it: those that stand in the element around it.
    k = first - 1
    while node and k >= 0 and page.tag[blocks[k].node] in HEADING and page.parent[blocks[k].node] == page.parent[node]:
        held[k] = passes[k] = True
        k -= 1
    whole = page.tag[node] in ("", "html", "body")
    heaviest = max(page.weight[b.node] for b, h in zip(blocks, held) if h)
    edge = [k for k, ok in enumerate(passes) if ok and held[k]]
    out = []
    for k, b in enumerate(blocks):
        if not held[k]:
            continue
        links = 2 * b.linked > len(b.text)
        spoken_against = page.weight[b.node] < heaviest
        # In the whole page only what stands between passing blocks may go without passing.
        astray = whole and not (edge and edge[0] <= k <= edge[-1] and page.tag[b.node] in LEAF)
        if passes[k] or not (links or spoken_against or astray):
            out.append(b)
    return out


def main_text(html: str | None, share: float = 0.3) -> str:
    """The main text: blocks in page order joined by one newline; null, empty or without text: empty."""
    return "\n".join(b.text for b in content_blocks(page_of(html), share)) if html else ""


def main_texts(pages: DataFrame, share: float = 0.3, html: str = "html", id: str = "page_id", url: str = "url") -> DataFrame:
    """One row a row of pages: id, url, text, n_chars (code points of text).

    Null and empty pages give an empty text, as do pages without any. Whole pages are read, however long; broken
    markup is read as far as it goes. Repeated rows give repeated rows, an empty table an empty table; other columns
    aren't read. No shuffle.
    """

    def extracted(batches):
        for batch in batches:
            texts = [main_text(x, share) for x in batch.column(2).to_pylist()]
            # What can't be written as UTF-8 (references to half a surrogate pair) becomes a question mark.
            texts = [t if t.isascii() else t.encode("utf-8", "replace").decode() for t in texts]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id, url)]
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(extracted, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long").withColumnsRenamed({"id": id, "url": url})
