"""Column functions over text: everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Code points that no text may hold in interchange (noncharacters), used as marks while a text is rewritten.
OPEN, CLOSE, DOT, COMMA, BLANK, LINE, TAB, FEED, RETURN, SENTENCE, PARAGRAPH = (chr(0xFDD0 + k) for k in range(11))

# Single letters or capitalised pairs each with a full stop, perhaps one more word character, then blanks or the end.
# Blanks are spelled out (Java's \s has the vertical tab) and (?d) keeps . and $ to line feeds. The repeats are
# possessive: giving one back never helps a match, and Java then loops instead of recursing once a repeat.
ABBREVIATION = r"(?:\w\.|[A-Z][a-z]\.)++(?:[ \t\n\f\r]*+\w\.?)?(?:[ \t\n\f\r]++|$)"

#: What separates words, apart from the apostrophe, which has its own rule.
SEPARATORS = '.,!?()&@[]{}/\\"#:;<>^*=-”−—–'
SPACES = " \t\n\x0b\f\r"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def char_class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\[]^-&" else c for c in chars) + "]"


def mark_abbreviations(text: Column, before: str) -> Column:
    """OPEN and CLOSE around every abbreviation that stands at the start or after one of the characters `before`."""
    return F.regexp_replace(text, f"(?d)(?<![^{before}]){ABBREVIATION}", f"{OPEN}$0{CLOSE}")


def protect_marked(text: Column, plain: str, marks: str) -> Column:
    """Within OPEN...CLOSE each character of plain becomes the one of marks in its place; the marks around go."""
    parts = F.split(text, OPEN, -1)
    head = F.element_at(parts, 1)
    tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(F.translate(F.substring_index(p, CLOSE, 1), plain, marks), F.substring_index(p, CLOSE, -1)))
    return F.when(F.contains(text, F.lit(OPEN)), F.concat(head, F.array_join(tail, ""))).otherwise(text)


def drop_parentheses(text: Column) -> Column:
    """text without what stands at another depth than 0; abbreviations (OPEN...CLOSE) always stay, as do their marks.

    A closing parenthesis too many leaves depth 0 as well, so the rest of the line goes.
    """
    pieces = F.split(text, f"(?<=[(){OPEN}{CLOSE}])|(?=[(){OPEN}{CLOSE}])", -1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("inside"), F.lit("").alias("out"))

    def step(acc, piece):
        depth = acc["depth"] + F.when(piece == "(", 1).when(piece == ")", -1).otherwise(0)
        inside = F.when(piece == OPEN, True).when(piece == CLOSE, False).otherwise(acc["inside"])
        mark = piece.isin(OPEN, CLOSE)
        stays = mark | acc["inside"] | ((acc["depth"] == 0) & ~piece.isin("(", ")"))
        return F.struct(depth.alias("depth"), inside.alias("inside"), F.concat(acc["out"], F.when(stays, piece).otherwise("")).alias("out"))

    return F.when(text.rlike("[()]"), F.aggregate(pieces, start, step, lambda acc: acc["out"])).otherwise(text)


def token_steps(keep: str = "", parens: bool = False, keep_case: bool = False, unicode_case: bool = False) -> list[Callable[[Column], Column]]:
    """The steps from a line to its words parted by blanks. A step uses what it is given more than once: a column each is best."""
    keep = "".join(c for c in dict.fromkeys(keep) if c in SEPARATORS + "'" and c not in "()")

    def marked(line: Column) -> Column:
        out = mark_abbreviations(line, SPACES)
        return out if "," in keep else F.regexp_replace(out, ",(?=[0-9])", COMMA)

    def bare(out: Column) -> Column:
        return F.regexp_replace(out, "[()]", " $0 ") if parens else drop_parentheses(out)

    def parted(out: Column) -> Column:
        out = protect_marked(out, ".", DOT)
        if "," not in keep:
            out = F.regexp_replace(out, f"(?<![0-9]){COMMA}", " ")
        gone = "".join(c for c in SEPARATORS if c not in keep and not (parens and c in "()"))
        out = F.regexp_replace(out, char_class(gone + SPACES), " ")
        if plain := keep.replace("'", ""):
            out = F.regexp_replace(out, char_class(plain), " $0 ")
        out = F.regexp_replace(out, "(?<=^|[ ])'+", " ") if "'" not in keep else initial_apostrophes(out)
        if unicode_case:
            out = F.lower(out)
        elif not keep_case:
            out = ascii_lower(out)
        return F.translate(out, DOT + COMMA, ".,")

    return [marked, bare, parted]


def tokenize(line: Column, keep: str = "", parens: bool = False, keep_case: bool = False, unicode_case: bool = False) -> Column:
    """The words of a line as array<string>; null gives null.

    Abbreviations stay whole. Text in parentheses is dropped without a gap (parens=True keeps it, each parenthesis a
    word of its own). Separators part words, except an apostrophe within or after a word and a comma between digits;
    separators listed in `keep` are words of their own. A-Z are lower-cased unless keep_case; unicode_case lower-cases
    all letters.
    """
    for step in token_steps(keep, parens, keep_case, unicode_case):
        line = step(line)
    return F.array_remove(F.split(line, " ", -1), "")


def initial_apostrophes(text: Column) -> Column:
    """Every apostrophe of a run at the start of a word becomes a word."""
    runs = F.regexp_replace(text, "(?<=^|[ ])('+)", f"{OPEN}$1{CLOSE}")
    parts = F.split(runs, OPEN, -1)
    spaced = F.transform(parts, lambda p: F.when(F.contains(p, F.lit(CLOSE)), F.concat(F.replace(F.substring_index(p, CLOSE, 1), F.lit("'"), F.lit(" ' ")), F.substring_index(p, CLOSE, -1))).otherwise(p))
    return F.array_join(spaced, "")


def mark_text(text: Column) -> Column:
    """The first step of split_sentences(); what it gives is used more than once, so a column of its own is best."""
    return mark_abbreviations(text, " \t\n\r")


def split_sentences(text: Column) -> Column:
    """The text with one sentence a line and an empty line between paragraphs.

    Sentences end at a full stop before a blank or a quote (which stays with them), and after every ?, ! and ;.
    Abbreviations are copied with the blanks behind them, so nothing ends there unless those hold a line feed. An
    empty line parts paragraphs; a single line feed is a blank; blanks are squeezed.
    """
    return split_marked(mark_text(text))


def split_marked(text: Column) -> Column:
    """split_sentences() of what mark_text() gave."""
    out = protect_marked(text, ". \n\t\f\r", DOT + BLANK + LINE + TAB + FEED + RETURN)
    out = F.replace(out, F.lit("\n\n"), F.lit(PARAGRAPH))
    out = F.regexp_replace(out, rf"\.(?:([\"'])|(?=[ \t\n\r{PARAGRAPH}]))", f".$1{SENTENCE}")
    out = F.regexp_replace(out, "[?!;]", f"$0{SENTENCE}")
    any_mark = f"[{SENTENCE}{PARAGRAPH} \\t\\n]"
    out = F.regexp_replace(out, rf"\A{any_mark}+", "")
    out = F.regexp_replace(out, r"\r[ \t]+", "\r")
    out = F.regexp_replace(out, f"(?:[{SENTENCE}{PARAGRAPH}]{any_mark}*)?{PARAGRAPH}{any_mark}*", PARAGRAPH)
    out = F.regexp_replace(out, f"{SENTENCE}[{SENTENCE} \\t\\n]*", SENTENCE)
    out = F.translate(F.regexp_replace(out, r"([ \t\n])[ \t\n]+", "$1"), "\n", " ")
    out = F.replace(out, F.lit(PARAGRAPH), F.lit("\n\n"))
    return F.translate(out, SENTENCE + DOT + BLANK + LINE + TAB + FEED + RETURN, "\n. \n\t\f\r")


def title_slug(title: Column) -> Column:
    """File name of an article: lower case, each run of white space and each / an underscore, .txt at the end."""
    return F.concat(F.regexp_replace(F.lower(title), r"\s+|/", "_"), F.lit(".txt"))


def namespace(title: Column) -> Column:
    """Lower-cased part of a title before its first colon; null if it has none."""
    return F.when(F.contains(title, F.lit(":")), F.lower(F.substring_index(title, ":", 1)))


ENTITIES = (("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&"))


def unescape_common(text: Column) -> Column:
    """The most common character references, one level of them; &amp; comes last."""
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def words_of(text: Column) -> Column:
    """Runs of characters other than white space, as array<string>."""
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+", -1), lambda w: w != "")


def count_of(line: Column) -> Column:
    """The count of a `count<TAB>key` line: its leading digits as a number, 0 without any."""
    return F.coalesce(F.regexp_extract(line, r"^\s*([0-9]{1,18})", 1).try_cast("long"), F.lit(0).cast("long"))


def key_of(line: Column) -> Column:
    """The key of a `count<TAB>key` line: behind the first tab up to a carriage return or line feed."""
    return F.regexp_extract(line, r"(?s)^[^\t]*\t([^\r\n]*)", 1)


def parse_size(text: str) -> int:
    """Bytes of a size such as 512, 512b, 64k, 500M or 2g."""
    text = text.strip().lower()
    factor = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], None)
    digits = text[:-1] if factor else text
    if not digits.isdigit():
        raise ValueError(f"not a size: {text!r}")
    return int(digits) * (factor or 1)
