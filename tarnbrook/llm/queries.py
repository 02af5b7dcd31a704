"""The operators' queries over the driver tables, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnbrook.llm import (
    bpe, contamination, fingerprints, jaccard, language, lines, manifest, passages, scoring, search, secret_scan, sharding, vectors,
)
from tarnbrook.llm.oracles import NEW_ORACLES
from tarnbrook.llm.package import ship

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """Place of the byte-level BPE file: ``BPE_VOCABULARY``, or that of the public tokenizers package."""
    path = os.environ.get("BPE_VOCABULARY")
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(_documents(spark, folder))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_report(_documents(spark, folder), vocabulary())


def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return vectors.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(_documents(spark, folder))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_sets(_documents(spark, folder))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination_report(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_report(_documents(spark, folder))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.passage_report(_documents(spark, folder))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_documents(_documents(spark, folder))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(_documents(spark, folder))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked_search(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_report(_documents(spark, folder))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest_report(spark.read.parquet(f"{folder}/documents.parquet"))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_bpe": op2_bpe,
    "op3_near_vectors": op3_near_vectors,
    "op4_language_id": op4_language_id,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sharding": op10_sharding,
    "op11_ranked_search": op11_ranked_search,
    "op12_fingerprints": op12_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_BLANK = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = NEW_ORACLES | {
    "op7_line_dedup": rf"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, {_LOWER.format(rf"regexp_replace(regexp_replace(line, '\A{_BLANK}+', ''), '{_BLANK}+\z', '')")} AS k FROM parts
), repeated AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT keyed.*, repeated.k IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op6_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS v
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS v
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, sizes WHERE len(w) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.v = x.v
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
}
