"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, fingerprints, jaccard, langid, licenses, lm, mixing, packing, phrases, resampling, tokens, urls, warc
from .common import id_remainder, read_table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_archives(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    training = langid.training_rows(documents)
    profiles = langid.language_profiles(documents.where(training))
    found = langid.identify_languages(documents.select("doc_id", "text", (~training).alias("held_out")), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = F.coalesce(id_remainder("doc_id", 7) != 2, F.lit(True))
    return lm.score_documents(read_table(spark, sf_dir, "documents"), training)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(read_table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"), urls.RULES).select("page_id", "host", "path", "rule", "verdict", "template")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_counts, op2_fingerprints, op3_warc_archives, op4_embedding_duplicates, op5_language_id,
        op6_packing, op7_license_scan, op8_lm_scores, op9_source_mix, op10_ngram_jaccard,
        op11_phrases, op12_url_filter, op13_resampling,
    )
    return {f.__name__: f for f in found}


OP3_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages WHERE page_id IS NOT NULL),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_archives": OP3_SQL, "op9_source_mix": mixing.ORACLE_SQL, "op10_ngram_jaccard": jaccard.ORACLE_SQL, "op11_phrases": phrases.ORACLE_SQL, "op12_url_filter": urls.ORACLE_SQL}
