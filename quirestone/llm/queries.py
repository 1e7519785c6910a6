"""The driver queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import binary_records, curves, language_id, minhash, mixing, ngram_lm, packing, product_quantisation, secret_scan, token_counts


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_docs(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(_docs(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(_docs(spark, sf_dir))


def op7_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_records.round_trip(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_quantisation.linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scored(_docs(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_secret_scan, op3_language_id, op4_mixing, op5_packing, op6_minhash, op7_binary_records, op8_product_quantisation, op9_curves, op10_ngram_lm)}

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), k AS (
  SELECT *, md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), size::VARCHAR)) AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (ARRAY[3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source
), r AS (
  SELECT *, (2.0 * source_size)::DOUBLE AS cap, 2.0 * source_size / w AS ratio FROM s
), f AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), t AS (
  SELECT source, source_size, CASE WHEN ratio <= level THEN cap ELSE w * (SELECT arg_min(level, ratio) FROM f WHERE ratio > level) END::DOUBLE AS target FROM f
), g AS (
  SELECT *, round(target)::BIGINT // greatest(source_size, 1) AS passes, round(target)::BIGINT - (round(target)::BIGINT // greatest(source_size, 1)) * source_size AS rest FROM t
), o AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM k
)
SELECT o.doc_id, o.size::BIGINT AS size, g.source_size, g.target, (o.size * (g.passes + CASE WHEN o.size > 0 AND 2 * o.ahead + o.size < 2 * g.rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source
"""

_LINKS = """
WITH RECURSIVE raw AS (
  SELECT vec_id, list_transform(embedding, lambda x: coalesce(x, 0)::DOUBLE) AS e,
    coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS ok
  FROM embeddings
), v AS (
  SELECT vec_id, ok, CASE WHEN ok THEN e ELSE [1.0]::DOUBLE[] END AS e FROM raw
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = v.vec_id
"""

ORACLES: dict[str, str] = {"op4_mixing": _MIXING, "op8_product_quantisation": _LINKS}
