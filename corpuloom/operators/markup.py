"""Wiki markup to plain text. The grammar is recursive, so this is the one operator that runs in Python, on Arrow batches."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADING = re.compile(r"(=+)[ \t\n\f\r]*(.+?)[ \t\n\f\r]*\1")
FINAL_HEADINGS = frozenset(("References", "Footnotes", "Related pages", "Further reading"))
BREAKS = frozenset(("<br>", "<br/>", "<br />"))
ENTITY = re.compile(r"&(?:#?[xX]?(?:[0-9a-fA-F]+|\w{1,8}));")


class MarkupError(ValueError):
    def __init__(self, message: str, at: int):
        super().__init__(message)
        self.at = at


class _Out:
    """Text written so far at one level of nesting."""

    __slots__ = ("parts", "last_line_blank", "newlines")

    def __init__(self):
        self.parts: list[str] = []
        self.last_line_blank = True  # only blanks since the last line feed
        self.newlines = 0  # line feeds at the very end

    def write(self, text: str) -> None:
        if not text:
            return
        self.parts.append(text)
        tail = text.rsplit("\n", 1)
        blank = not tail[-1].strip(" \t\r")
        self.last_line_blank = blank if len(tail) > 1 else self.last_line_blank and blank
        bare = len(text) - len(text.rstrip("\n"))
        self.newlines = self.newlines + bare if bare == len(text) else bare

    def break_lines(self, count: int) -> None:
        self.write("\n" * (count - self.newlines))

    def text(self) -> str:
        return "".join(self.parts)


PLAIN = re.compile(r"[^\[<{|*\-:=']+")
RUNS = re.compile("=+")
TAG_SIGNS = re.compile(r"[<>/]")
PAIRED = re.compile(r"[\[\]|{}]")


class _Article:
    """One article's markup with the matching brackets and braces found in a single pass."""

    def __init__(self, markup: str, ignore_headings: bool):
        self.markup, self.ignore_headings = markup, ignore_headings
        self.close: dict[int, int] = {}  # where the bracket or brace opened at a place is closed
        self.body: dict[int, int] = {}  # behind the last | directly within a bracket
        brackets: list[int] = []
        braces: list[int] = []
        for m in PAIRED.finditer(markup):
            c = m[0]
            if c == "[":
                brackets.append(m.start())
            elif c == "{":
                braces.append(m.start())
            elif c == "|":
                if brackets:
                    self.body[brackets[-1]] = m.end()
            elif c == "]":
                if brackets:
                    self.close[brackets.pop()] = m.start()
            elif braces:
                self.close[braces.pop()] = m.start()

    def text(self, at: int, end: int) -> str:
        """The text of a part of the markup, read as if it stood alone."""
        markup, out, low = self.markup, _Out(), at
        while at < end:
            run = PLAIN.match(markup, at, end)
            if run:
                out.write(run[0])
                at = run.end()
                continue
            c = markup[at]
            if c == "[":
                at = self.link(at, end, out)
            elif c == "<":
                at = self.element(at, end, out)
            elif c == "{" and markup.startswith(("{{", "{|"), at, end):
                close = self.close.get(at, end)
                at = close + 1 if close < end else end
            elif c == "|" and self.begins_line(low, at):
                line = markup.find("\n", at, end)
                at = end if line < 0 else line + 1
            elif c in "*-" and out.last_line_blank:
                at = self.item(at, end, out)
            elif c == ":" and out.last_line_blank:
                at += 1
            elif c == "=":
                m = self.heading(at, end)
                if not m:
                    out.write("=")
                    at += 1
                elif m[2] in FINAL_HEADINGS:
                    break
                else:
                    at = m.end()
                    if not self.ignore_headings:
                        out.write(m[2])
                        out.break_lines(2)
            elif c == "'" and markup.startswith("''", at, end):
                while at < end and markup[at] == "'":
                    at += 1
            else:
                out.write(c)
                at += 1
        return out.text()

    def heading(self, at: int, end: int) -> re.Match | None:
        """HEADING at a place. Of a long run only the lengths that can match are tried, as the regex would try each."""
        markup, stop = self.markup, at
        while stop < end and markup[stop] == "=":
            stop += 1
        n = stop - at
        if n <= 16:
            return HEADING.match(markup, at, end)
        line = stop
        while line < end and markup[line] in " \t\n\f\r":
            line += 1
        line = markup.find("\n", line, end)
        line = end if line < 0 else line
        while line < end and markup[line] in " \t\n\f\r=":
            line += 1
        sizes = set(map(len, RUNS.findall(markup, stop, line)))
        for k in sorted({min(n, x) for x in sizes} | {min(n - 1, x) for x in sizes} | {(n - 1) // 2}, reverse=True):
            if k and (m := re.compile(f"(={{{k}}})[ \\t\\n\\f\\r]*(.+?)[ \\t\\n\\f\\r]*={{{k}}}").match(markup, at, end)):
                return m
        return None

    def begins_line(self, low: int, at: int) -> bool:
        while at > low and self.markup[at - 1] in " \t\r":
            at -= 1
        return at == low or self.markup[at - 1] == "\n"

    def link(self, at: int, end: int, out: _Out) -> int:
        close = self.close.get(at, end)
        if close >= end:
            out.write("[")  # never closed: an ordinary character
            return at + 1
        body = self.body.get(at, at + 1)
        target = self.markup[at:body].lower()
        picture = "file:" in target or "image:" in target
        if picture:
            out.break_lines(2)
        label = self.text(body, close)
        if ":" not in label:
            out.write(label)
        if picture:
            out.break_lines(2)
        return close + 1

    def element(self, at: int, end: int, out: _Out) -> int:
        markup = self.markup
        if markup.startswith("<!--", at, end):
            close = markup.find("-->", at + 4, end)
            if close < 0:
                raise MarkupError("comment without an end", at)
            return close + 3
        depth, closing, stop = 0, False, end
        for m in TAG_SIGNS.finditer(markup, at, end):
            c = m[0]
            if c == "<":
                depth += 1
            elif c == ">":
                depth -= 1
            else:
                closing = depth == 1
            if depth <= 0 and closing:
                stop = m.end()
                break
        if stop - at <= 6 and markup[at:stop] in BREAKS:
            out.write("\n")
        return stop

    def item(self, at: int, end: int, out: _Out) -> int:
        out.break_lines(2)
        while at < end and self.markup[at] in "*- \t":
            at += 1
        line = self.markup.find("\n", at, end)
        stop = end if line < 0 else line
        comment = self.markup.find("<!--", at, stop)
        stop = stop if comment < 0 else comment
        out.write(self.text(at, stop))
        out.break_lines(2)
        return stop


def plain_text(markup: str, ignore_headings: bool = False) -> str:
    """The text of an article; raises MarkupError for a comment that isn't closed.

    Links leave their label (none at all if it has a colon), files and images their caption as a paragraph; comments,
    elements with their content, templates and tables go; list items and headings become paragraphs; the article ends
    at a heading such as References; runs of apostrophes go.
    """
    return _Article(markup, ignore_headings).text(0, len(markup))


def place_of(text: str, at: int) -> tuple[int, int]:
    """Line and column (from 1) of a position."""
    return text.count("\n", 0, at) + 1, at - (text.rfind("\n", 0, at) + 1) + 1


def snippet(text: str, at: int, most: int = 29) -> str:
    rest = text[at : at + most]
    return rest if at + most >= len(text) else rest[: most - 3] + "..."


def textify(articles: DataFrame, ignore_headings: bool = False, markup: str = "markup", unescape: bool = False) -> DataFrame:
    """articles with the columns text and error (struct message, line, col, snippet) instead of the markup.

    An article that can't be read has a null text and an error, and never fails the job; a null markup gives both null.
    Line feeds and spaces at the start of a text go. unescape decodes character references first.
    """
    others = [c for c in articles.columns if c != markup]
    at = articles.columns.index(markup)
    error = pa.struct([("message", pa.string()), ("line", pa.int32()), ("col", pa.int32()), ("snippet", pa.string())])

    def converted(batches):
        for batch in batches:
            texts, errors = [], []
            for x in batch.column(at).to_pylist():
                text, problem = None, None
                if x is not None:
                    x = decoded(x) if unescape else x
                    try:
                        text = plain_text(x, ignore_headings).lstrip("\n\r ")
                    except MarkupError as e:
                        line, col = place_of(x, e.at)
                        problem = {"message": str(e), "line": line, "col": col, "snippet": snippet(x, e.at)}
                    except RecursionError:
                        problem = {"message": "nested too deeply", "line": 1, "col": 1, "snippet": snippet(x, 0)}
                texts.append(text)
                errors.append(problem)
            kept = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.record_batch([*kept, pa.array(texts, pa.string()), pa.array(errors, error)], [*others, "text", "error"])

    from pyspark.sql.types import StringType, StructField, StructType

    problem = StructType.fromDDL("message string, line int, col int, snippet string")
    schema = StructType([*(f for f in articles.schema.fields if f.name != markup), StructField("text", StringType()), StructField("error", problem)])
    return articles.mapInArrow(converted, schema)


def decoded(text: str) -> str:
    """Character references that end in a semicolon, decoded once."""
    return ENTITY.sub(lambda m: html.unescape(m[0]), text)


def unescape(df: DataFrame, column: str) -> DataFrame:
    """df with the character references of a column decoded; rows without an ampersand never leave the JVM's fast path."""
    at = df.columns.index(column)

    def work(batches):
        for batch in batches:
            values = [x if x is None or "&" not in x else decoded(x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(values, pa.string()))

    has = F.coalesce(F.contains(column, F.lit("&")), F.lit(False))
    return df.where(~has).unionByName(df.where(has).mapInArrow(work, df.schema))
