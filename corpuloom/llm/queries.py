"""The queries op1_ to op10_: each operator over the whole of its table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.llm import bpe, embeddings, exact_dedup, html, mixing, quality, simhash, token_counts, toxicity, urls
from corpuloom.sources.readers import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_dedup(table(spark, sf_dir, "embeddings"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_mixing, op4_html, op5_quality, op6_simhash, op7_embeddings, op8_exact_dedup, op9_urls, op10_bpe)}


# The draw of mixing.draw(): the first seven hex digits of an MD5.
DRAW = "('0x' || substr(md5({} || '#42'), 1, 7))::BIGINT"

OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         list_extract([3, 1, 2], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT)::BIGINT AS weight
  FROM sized GROUP BY source
), totals AS (SELECT sum(source_size)::BIGINT AS total FROM sources)
, levels AS (
  SELECT s.source, s.cap, s.weight,
         3 * t.total - 2 * coalesce(sum(cap) OVER lower, 0)::BIGINT AS num, 2 * sum(weight) OVER upper AS den,
         row_number() OVER (ORDER BY s.cap::DOUBLE / s.weight, s.source NULLS LAST) AS place
  FROM sources s, totals t
  WINDOW lower AS (ORDER BY s.cap::DOUBLE / s.weight, s.source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         upper AS (ORDER BY s.cap::DOUBLE / s.weight, s.source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT arg_min(num, place) AS num, arg_min(den, place) AS den FROM levels
  WHERE cap::HUGEINT * den > num::HUGEINT * weight
), aimed AS (
  SELECT s.source, s.source_size, CASE WHEN l.num IS NULL THEN s.cap::DOUBLE ELSE least(s.cap::DOUBLE, (s.weight * l.num)::DOUBLE / l.den::DOUBLE) END AS target
  FROM sources s, level l
), steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(round(target / source_size * 67108864), 134217728)::BIGINT ELSE 0 END AS step,
         {DRAW.format("coalesce(source, '')")} % 67108864 AS start
  FROM aimed
), chanced AS (
  SELECT *, {DRAW.format("coalesce(doc_id::VARCHAR, '')")} AS chance FROM sized
), placed AS (
  SELECT c.doc_id, c.source, c.size, s.source_size, s.target, s.step,
         s.step * row_number() OVER (PARTITION BY c.source ORDER BY length(bin(c.size)) * 1024 + chance % 1024, c.size, chance, doc_id) + s.start AS upto
  FROM chanced c JOIN steps s ON c.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, size, source_size, target,
       (upto >> 26) - ((upto - step) >> 26) AS copies, ((upto >> 26) - ((upto - step) >> 26)) * size AS taken
FROM placed
"""

OP8 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""


# All pairs of the test table's few hundred vectors; components by walking the links.
OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n_links, 0)::BIGINT AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3, "op7_embeddings": OP7, "op8_exact_dedup": OP8}
