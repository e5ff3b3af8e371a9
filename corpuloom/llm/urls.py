"""URL filters with redirect equivalence.

Rules name a host and the start of a path; a rule fits its host and all subdomains, and the longest that fits decides.
A url that no rule fits takes the decision of its aliases: redirects (meta refresh, or a table of redirects) and
canonical links are edges between urls, distributed connected components make the classes, and within a class an
explicit allow goes before a block. A class without either, and a url without aliases, is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from typing import NamedTuple
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpuloom.llm.shared import attach_by_group, components, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no :// gives the empty string."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; null or no :// gives the empty string."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(rules: Sequence[Rule]) -> dict[str, list[tuple[int, str, str, str]]]:
    """host -> (length, path, rule, verdict), longest first; of equal rules the first given counts."""
    index: dict[str, list[tuple[int, str, str, str]]] = {}
    for rule in rules:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"a rule's verdict is allow or block, not {rule.verdict!r}")
        name = rule.host + rule.path
        index.setdefault(rule.host, []).append((len(name), rule.path, name, rule.verdict))
    for found in index.values():
        found.sort(key=lambda x: -x[0])
    return index


def decide(index: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it, or (None, None)."""
    best, at = None, 0
    while True:
        for found in index.get(host[at:], ()):
            if path.startswith(found[1]):
                if best is None or found[0] > best[0]:
                    best = found
                break
        dot = host.find(".", at)
        if dot < 0:
            return (best[2], best[3]) if best else (None, None)
        at = dot + 1


def with_rules(rows: DataFrame, rules: Sequence[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """rows with the columns rule and rule_verdict. The index goes to the workers: as large as the list of rules given."""
    index = rows.sparkSession.sparkContext.broadcast(rule_index(rules))
    at = [rows.columns.index(c) for c in (host, path)]

    def judged(batches):
        for batch in batches:
            found = [decide(index.value, h or "", p or "") for h, p in zip(*(batch.column(k).to_pylist() for k in at))]
            yield pa.record_batch([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())], [*batch.schema.names, "rule", "rule_verdict"])

    return rows.mapInArrow(judged, StructType([*rows.schema.fields, StructField("rule", StringType()), StructField("rule_verdict", StringType())]))


UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAGS = re.compile(r"<(link|meta|base)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.I)
ATTRIBUTES = re.compile(r"([a-zA-Z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
REFRESH = re.compile(r"\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?['\"]?([^'\"]+)", re.I)


def targets(url: str | None, html: str | None) -> list[str]:
    """The urls that the page names as its canonical one or sends its reader to at once, made absolute."""
    if not html:
        return []
    out, base = [], url or ""
    for tag, inside in TAGS.findall(UNSEEN.sub(" ", html)):
        have = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTES.findall(inside)}
        to, tag = None, tag.lower()
        if tag == "base" and have.get("href"):
            base = absolute(base, have["href"])
        elif tag == "link" and "canonical" in have.get("rel", "").lower().split():
            to = have.get("href")
        elif tag == "meta" and have.get("http-equiv", "").lower() == "refresh" and (m := REFRESH.match(have.get("content", ""))):
            to = m[1]
        if to and to.strip():
            out.append(absolute(base, to.strip()))
    return out


def absolute(base: str, to: str) -> str:
    try:
        return urljoin(base, to)
    except ValueError:
        return to


def node_of(url: Column) -> Column:
    """What aliases are told apart by: the url without its fragment, scheme and host in lower case."""
    whole = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(whole, r"(?s)^(.*?://[^/?]*)", 1)
    return F.concat(F.translate(head, UPPER, LOWER), F.substr(whole, F.length(head) + 1))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (url, target) of the pages; only pages that may have one are looked into."""
    likely = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv") & F.col(url).isNotNull()).select(F.col(url).alias("url"), F.col(html).alias("html"))

    def linked(batches):
        for batch in batches:
            found = [(u, t) for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in targets(u, h)]
            yield pa.record_batch([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())], ["url", "target"])

    return likely.mapInArrow(linked, "url string, target string")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url: str = "url", html: str = "html", id: str = "page_id") -> DataFrame:
    """One row a row of pages: id, host, path, rule (null if none fits), verdict (allow or block).

    redirects: further edges in its first two columns. A null url, or one without ://, has an empty host and path,
    fits no rule, has no aliases and is allowed. A null html has no links. Rows with the same url are aliases of each
    other; repeated rows give repeated rows; an empty table gives an empty table; other columns aren't read.
    """
    found = page_links(pages, url, html)
    if redirects is not None:
        found = found.unionByName(redirects.toDF("url", "target").where("url is not null and target is not null"))
    edges = stored(found.select(node_of(F.col("url")).alias("u"), node_of(F.col("target")).alias("v")).distinct())
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = stored(with_rules(rows, rules).withColumn("node", node_of(F.col("url"))))
    decided = F.col("rule").isNotNull()
    member = stored(components(edges))
    # Every url of a class counts, also those that are only the target of a link.
    judged = with_rules(member.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    by_class = judged.groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("allow"), F.max(F.col("rule_verdict") == "block").alias("block"), F.count("*").alias("size"))
    verdict = F.when(F.col("block") & ~F.coalesce("allow", F.lit(False)), "block").otherwise("allow")
    by_class = stored(by_class.select("component", "size", verdict.alias("alias_verdict")).where("alias_verdict = 'block'"))
    blocked = attach_by_group(member, by_class, "component", "size", member.count()).where("alias_verdict = 'block'").select("node", "alias_verdict")
    open_rows = rows.where(~decided)
    counts = open_rows.where("node is not null").groupBy("node").agg(F.count("*").alias("rows"))
    groups = stored(blocked.join(counts, "node"))
    out = attach_by_group(open_rows, groups, "node", "rows", rows.count()).select("id", "host", "path", "rule", F.coalesce("alias_verdict", F.lit("allow")).alias("verdict"))
    ruled = rows.where(decided).select("id", "host", "path", "rule", F.col("rule_verdict").alias("verdict"))
    return ruled.unionByName(out).withColumnRenamed("id", id)
