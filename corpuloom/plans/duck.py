"""The same queries as DuckDB SQL, written for the tests alone."""

from __future__ import annotations

from html.entities import html5

BLANKS = r"[ \t\n\x0B\f\r]"
OPEN, CLOSE, DOT, COMMA, BLANK, LINE, TAB, FEED, RETURN, SENTENCE, PARAGRAPH = (f"chr({0xFDD0 + k})" for k in range(11))
SEPARATORS = '.,!?()&@[]{}/\\"#:;<>^*=-”−—–'
ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINES = "lines AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
WORDS = f"words AS (SELECT doc_id, line_id, line, list_filter(regexp_split_to_array(line, '{BLANKS}+'), lambda w: w <> '') AS words FROM lines)"


def grams(n: int, source: str = "words", words: str = "words", where: str = "TRUE") -> str:
    begin = "[" + ", ".join(["'<s>'"] * (n - 1)) + "]"
    padded = f"list_concat({begin + '::VARCHAR[]' if n > 1 else '[]::VARCHAR[]'}, {words}, ['</s>'])"
    each = f"list_transform(range(0, len({words}) + 1), lambda i: array_to_string(list_slice({padded}, i + 1, i + {n}), ' '))"
    return f"SELECT ngram, count(*) AS cnt FROM (SELECT unnest({each}) AS ngram FROM {source} WHERE len({words}) > 0 AND {where}) GROUP BY ngram"


def marked(x: str, before: str) -> str:
    run = r"((?:(?:\w\.|[A-Z][a-z]\.)+(?:[ \t\n\f\r]*\w\.?)?(?:[ \t\n\f\r]+|$))+)"
    return f"regexp_replace({x}, '(^|{before}){run}', '\\1' || {OPEN} || '\\2' || {CLOSE}, 'g')"


def protected(x: str, plain: str, marks: str) -> str:
    body = f"CASE WHEN contains(p, {CLOSE}) THEN translate(split_part(p, {CLOSE}, 1), {plain}, {marks}) || split_part(p, {CLOSE}, 2) ELSE p END"
    return f"array_to_string(list_transform(string_split({x}, {OPEN}), lambda p: {body}), '')"


def tokens(keep: str = "", parens: bool = False, keep_case: bool = False) -> str:
    """A chain of CTEs from lines to toks(doc_id, line_id, words)."""
    digits = "x1" if "," in keep else f"regexp_replace(x1, ',([0-9])', {COMMA} || '\\1', 'g')"
    if parens:
        bare = "regexp_replace(x2, '[()]', ' \\0 ', 'g')"
    else:
        stays = f"c IN ({OPEN}, {CLOSE}) OR a.inside OR (a.depth = 0 AND c NOT IN ('(', ')'))"
        bare = (
            f"CASE WHEN regexp_matches(x2, '[()]') THEN list_reduce(string_split(x2, ''), lambda a, c: "
            f"{{'depth': a.depth + CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END, "
            f"'inside': CASE WHEN c = {OPEN} THEN TRUE WHEN c = {CLOSE} THEN FALSE ELSE a.inside END, "
            f"'out': a.out || CASE WHEN {stays} THEN c ELSE '' END}}, {{'depth': 0, 'inside': FALSE, 'out': ''}}).out ELSE x2 END"
        )
    gone = "".join(c for c in SEPARATORS if c not in keep and not (parens and c in "()")) + "\t\n\x0b\f\r"
    commas = "x4" if "," in keep else f"regexp_replace(x4, '(^|[^0-9])' || {COMMA}, '\\1 ', 'g')"
    parted = f"translate(x5, '{gone}', '{' ' * len(gone)}')"
    spaced = "x6"
    for c in keep:
        spaced = f"replace({spaced}, '{c}', ' {c} ')"
    folded = "x8" if keep_case else f"translate(x8, {ASCII})"
    steps = [marked("line", BLANKS), digits, bare, protected("x3", "'.'", DOT), commas, parted, spaced, "regexp_replace(x7, '(^| )''+', '\\1 ', 'g')", folded, f"translate(x9, {DOT} || {COMMA}, '.,')"]
    out, before = [], "lines"
    for k, step in enumerate(steps, 1):
        out.append(f"t{k} AS (SELECT doc_id, line_id, {'line, ' if k < 1 else ''}{step} AS x{k} FROM {before})")
        before = f"t{k}"
    return ", ".join(out) + f", toks AS (SELECT doc_id, line_id, list_filter(string_split(x{len(steps)}, ' '), lambda w: w <> '') AS words FROM t{len(steps)})"


def sentence_steps(source: str) -> str:
    """A chain of CTEs from source(doc_id, text) to sents(doc_id, para_id, sent_id, sentence)."""
    any_mark = f"'[' || {SENTENCE} || {PARAGRAPH} || ' \\t\\n]'"
    steps = [
        marked("text", r"[ \t\n\r]"),
        protected("x1", "'. ' || chr(10) || chr(9) || chr(12) || chr(13)", " || ".join([DOT, BLANK, LINE, TAB, FEED, RETURN])),
        f"replace(x2, chr(10) || chr(10), {PARAGRAPH})",
        f"regexp_replace(x3, '\\.([\"''])', '.\\1' || {SENTENCE}, 'g')",
        f"regexp_replace(x4, '\\.([ \\t\\n\\r' || {PARAGRAPH} || '])', '.' || {SENTENCE} || '\\1', 'g')",
        f"regexp_replace(x5, '[?!;]', '\\0' || {SENTENCE}, 'g')",
        f"regexp_replace(x6, '^' || {any_mark} || '+', '')",
        "regexp_replace(x7, '\\r[ \\t]+', chr(13), 'g')",
        f"regexp_replace(x8, '(?:[' || {SENTENCE} || {PARAGRAPH} || ']' || {any_mark} || '*)?' || {PARAGRAPH} || {any_mark} || '*', {PARAGRAPH}, 'g')",
        f"regexp_replace(x9, {SENTENCE} || '[' || {SENTENCE} || ' \\t\\n]*', {SENTENCE}, 'g')",
        "replace(regexp_replace(x10, '([ \\t\\n])[ \\t\\n]+', '\\1', 'g'), chr(10), ' ')",
        f"replace(x11, {PARAGRAPH}, chr(10) || chr(10))",
        f"translate(x12, {' || '.join([SENTENCE, DOT, BLANK, LINE, TAB, FEED, RETURN])}, chr(10) || '. ' || chr(10) || chr(9) || chr(12) || chr(13))",
    ]
    out, before = [], source
    for k, step in enumerate(steps, 1):
        out.append(f"s{k} AS (SELECT doc_id, {step} AS x{k} FROM {before})")
        before = f"s{k}"
    paragraphs = f"list_filter(regexp_split_to_array(x{len(steps)}, '\\n{{2,}}'), lambda p: p <> '')"
    out.append(f"paras AS (SELECT doc_id, unnest(range(len({paragraphs})))::INTEGER AS para_id, unnest({paragraphs}) AS p FROM {before})")
    each = "list_filter(string_split(p, chr(10)), lambda s: s <> '')"
    out.append(f"sents AS (SELECT doc_id, para_id, unnest(range(len({each})))::INTEGER AS sent_id, unnest({each}) AS sentence FROM paras)")
    return ", ".join(out)


def pair_steps(cutoff: int | None, chosen: str = "TRUE", lines: str = "TRUE") -> str:
    """A chain of CTEs from words to pairs(w, v, cnt); chosen: a condition on w; lines: on the lines that make pairs."""
    words = "words" if not cutoff else "coalesce(kept, []::VARCHAR[])"
    kept = ""
    if cutoff:
        kept = (
            "kept AS (SELECT doc_id, line_id, list(word ORDER BY k) AS kept FROM (SELECT doc_id, line_id, unnest(range(len(words))) AS k, unnest(words) AS word FROM words) "
            f"WHERE word IN (SELECT ngram FROM uni WHERE cnt >= {cutoff}) GROUP BY ALL), "
        )
    source = "(SELECT w.doc_id, w.line_id, w.line, " + words + " AS words FROM words w" + (" LEFT JOIN kept USING (doc_id, line_id)" if cutoff else "") + ")"
    return (
        f"uni AS MATERIALIZED ({grams(1)}), {kept}near AS (SELECT words, list_distinct(list_concat(list_concat("
        "coalesce(lag(words) OVER o, []::VARCHAR[]), words), coalesce(lead(words) OVER o, []::VARCHAR[]))) AS context "
        f"FROM {source} WHERE {lines} WINDOW o AS (PARTITION BY doc_id ORDER BY line_id)), "
        "occ AS (SELECT unnest(words) AS w, context FROM near), pairs AS MATERIALIZED (SELECT w, v, count(*) AS cnt FROM (SELECT w, unnest(context) AS v FROM occ WHERE " + chosen + ") GROUP BY w, v)"
    )


def unescaped(x: str) -> str:
    """Character references that end in a semicolon, by a map of HTML 5's names of up to eight letters and by number."""
    names = {k[:-1]: v for k, v in html5.items() if k.endswith(";") and len(k) <= 9}
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    known = f"MAP {{{', '.join(f'{quote(k)}: {quote(v)}' for k, v in names.items())}}}"
    name = "regexp_extract(p, '^(#[xX][0-9a-fA-F]+|#[0-9]+|\\w{1,8});', 1)"
    number = f"CASE WHEN {name}[2] IN ('x', 'X') THEN ('0x' || {name}[3:])::BIGINT ELSE ({name}[2:])::BIGINT END"
    char = f"CASE WHEN {name} = '' THEN NULL WHEN {name}[1] = '#' THEN chr(({number})::INTEGER) ELSE ({known})[{name}] END"
    rest = f"substr(p, length({name}) + 2)"
    each = f"list_transform(string_split({x}, '&')[2:], lambda p: coalesce({char} || {rest}, '&' || p))"
    return f"string_split({x}, '&')[1] || array_to_string({each}, '')"


SCORED = """
scored AS MATERIALIZED (
  SELECT p.w, p.v, p.cnt, p.cnt::DOUBLE * n.total * n.total / (a.cnt::DOUBLE * a.cnt::DOUBLE * b.cnt::DOUBLE) AS mi
  FROM pairs p JOIN uni a ON a.ngram = p.w JOIN uni b ON b.ngram = p.v, (SELECT sum(cnt)::DOUBLE AS total FROM uni) n
  WHERE a.cnt >= {cutoff} AND b.cnt >= {cutoff}
), normed AS (
  SELECT s.mi / nullif(o.mi, 0) AS norm_mi, s.mi, s.cnt, s.w, s.v FROM scored s LEFT JOIN (SELECT w, mi FROM scored WHERE w = v) o ON o.w = s.w
)"""

# The conversations: a turn is a paragraph, its sentences are in order.
TALK_STEPS = (
    "talks AS (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations), " + sentence_steps("talks") + ", "
    "lines AS (SELECT doc_id * 1000 + para_id AS doc_id, sent_id AS line_id, sentence AS line FROM sents), " + tokens() + ", "
    f"uni AS MATERIALIZED ({grams(1, 'toks')}), "
    "near AS (SELECT words, list_distinct(list_concat(list_concat(coalesce(lag(words) OVER o, []::VARCHAR[]), words), coalesce(lead(words) OVER o, []::VARCHAR[]))) AS context "
    "FROM toks WINDOW o AS (PARTITION BY doc_id ORDER BY line_id)), "
    "occ AS (SELECT unnest(words) AS w, context FROM near), pairs AS MATERIALIZED (SELECT w, v, count(*) AS cnt FROM (SELECT w, unnest(context) AS v FROM occ) GROUP BY w, v)"
)

TITLED = """titled AS (
  SELECT doc_id, list_extract(['', 'Category:', 'wikipedia:', 'File:', 'TEMPLATE:', 'Portal:'], doc_id % 6 + 1) || replace(substr(text, 1, 30), chr(10), ' / ') AS title,
         CASE WHEN doc_id % 11 <> 0 THEN text END AS markup, doc_id % 7 = 0 AS is_redirect
  FROM documents
), slugged AS (SELECT doc_id, regexp_replace(lower(title), '[ \\t\\n\\x0B\\f\\r]+|/', '_', 'g') || '.txt' AS slug FROM titled)"""


def oracles(cutoff: int) -> dict[str, str]:
    base = f"WITH {LINES}, {WORDS}"
    bigrams = f"{base}, c AS ({grams(2)})"
    both = " UNION ALL ".join(grams(2, where=f"doc_id % 2 = {k}") for k in (0, 1))
    rendered = "SELECT doc_id, line_id, array_to_string(words, ' ') AS rendered, len(words)::BIGINT AS n_words FROM toks"
    sentence = "SELECT doc_id, para_id, sent_id, sentence FROM sents"
    out = {
        "ngram_unigram": f"{base} {grams(1)}",
        "ngram_bigram": f"{base} {grams(2)}",
        "ngram_trigram": f"{base} {grams(3)}",
        "ngram_total": f"{bigrams} SELECT coalesce(sum(cnt), 0)::BIGINT AS total FROM c",
        "ngram_freq_filter": f"{bigrams} SELECT ngram, cnt FROM c WHERE cnt >= 5",
        "ngram_filtered_total": f"{bigrams} SELECT coalesce(sum(cnt), 0)::BIGINT AS total FROM c WHERE cnt >= 5",
        "ngram_sort_topk": f"{bigrams} SELECT ngram, cnt FROM c ORDER BY cnt DESC, ngram DESC LIMIT 100",
        "merge_counts": f"{base} SELECT ngram, sum(cnt)::BIGINT AS cnt FROM ({both}) GROUP BY ngram",
        "total_check": f"{base}, merged AS ({both}), lens AS (SELECT len(words) + 1 AS n FROM words WHERE len(words) > 0), e AS (SELECT sum(cnt)::BIGINT AS expected FROM merged), a AS (SELECT sum(n)::BIGINT AS actual FROM lens) SELECT expected, actual, expected = actual AS matches FROM e, a",
        "malformed_counts": f"{base} {grams(1)}",
        "token_bigrams": f"WITH {sentence_steps('documents')}, lines AS (SELECT doc_id, 0 AS line_id, sentence AS line FROM sents), {tokens()} {grams(2, 'toks')}",
        "tokenize_default": f"WITH {LINES}, {tokens()} {rendered}",
        "tokenize_parens": f"WITH {LINES}, {tokens(parens=True)} {rendered}",
        "tokenize_keep": f"WITH {LINES}, {tokens(keep=',?!')} {rendered}",
        "tokenize_keepcase": f"WITH {LINES}, {tokens(keep_case=True)} {rendered}",
        "sentences": f"WITH {sentence_steps('documents')} {sentence}",
        "sentences_conversations": f"WITH talks AS (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations), {sentence_steps('talks')} {sentence}",
        "long_line_filter": f"WITH {LINES} SELECT doc_id, line_id, strlen(line)::BIGINT AS n_bytes FROM lines WHERE strlen(line) < 8192",
        "blank_line_filter": f"WITH {LINES} SELECT doc_id, count(*) AS n_lines FROM lines WHERE NOT regexp_full_match(line, '[ \\n\\r\\f\\t]*') GROUP BY doc_id",
        "paragraph_numbering": f"WITH {LINES}, spread AS (SELECT doc_id, line_id * 2 AS line_id, line FROM lines UNION ALL SELECT doc_id, line_id * 2 + 1, '' FROM lines WHERE line_id % 3 = 2) SELECT doc_id, line_id, sum((line = '')::INT) OVER (PARTITION BY doc_id ORDER BY line_id)::BIGINT AS para_id FROM spread",
        "collocations_by_word": f"{base}, {pair_steps(None)} SELECT w, count(*) AS partners, sum(cnt)::BIGINT AS cnt FROM pairs GROUP BY w",
        "collocations_frequent": f"{base}, {pair_steps(cutoff)} SELECT w, v, cnt FROM pairs",
        "association_cutoff": f"{base}, {pair_steps(cutoff)}, {SCORED.format(cutoff=cutoff)} SELECT round(norm_mi, 6) AS norm_mi, round(mi, 4) AS mi, cnt, w, v FROM normed",
        "association_top": f"{base}, {pair_steps(None, 'w IN (SELECT ngram FROM uni ORDER BY cnt DESC, ngram LIMIT 20)', 'strlen(line) < 8192')}, {SCORED.format(cutoff=0)} SELECT w, v, cnt, place FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY round(mi, 4) DESC, v) AS place FROM normed WHERE w IN (SELECT ngram FROM uni ORDER BY cnt DESC, ngram LIMIT 20)) WHERE place <= 10",
        "collocations_paragraphs": f"WITH {TALK_STEPS} SELECT w, v, cnt FROM pairs",
        "association_uncut": f"WITH {TALK_STEPS}, {SCORED.format(cutoff=0)} SELECT round(norm_mi, 6) AS norm_mi, round(mi, 4) AS mi, cnt, w, v FROM normed",
        "association_rejects": f"WITH {TALK_STEPS}, known AS (SELECT ngram FROM uni WHERE cnt >= 3) SELECT w, v, cnt FROM pairs WHERE w NOT IN (SELECT ngram FROM known) OR v NOT IN (SELECT ngram FROM known)",
        "namespace_redirect_filter": f"WITH {TITLED} SELECT doc_id, title FROM titled WHERE NOT is_redirect AND markup IS NOT NULL AND NOT (contains(title, ':') AND lower(split_part(title, ':', 1)) IN ('wikipedia', 'category', 'template'))",
        "title_slug": f"WITH {TITLED} SELECT doc_id, slug FROM slugged",
        "slug_collisions": f"WITH {TITLED} SELECT slug, max(doc_id) AS doc_id, count(*) AS n_alike FROM slugged GROUP BY slug",
    }
    text = "html"
    for name, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&apos;", "''''"), ("&#39;", "''''"), ("&ndash;", "'–'"), ("&mdash;", "'—'"), ("&amp;", "'&'")):
        text = f"replace({text}, '{name}', {char})"
    out["html_unescape_full"] = f"SELECT page_id, {unescaped('html')} AS html FROM pages"
    out["html_unescape"] = f"SELECT page_id, {text} AS html FROM pages"
    return out
