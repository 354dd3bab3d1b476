"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxolake.llm import bpe_codec, conversation_repair, decontaminate, language_id, license_scan, packing, pii, quality_cnn, repair_ids, simhash, spelling_variants, suffix_dedup, topk_search
from utxolake.llm.common import ship_code, table


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs), with_spans=False).drop("spans")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known_licenses(spark))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hit_spans", "items")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_ids.token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count_col="n_entities")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.classify(docs, quality_cnn.train(docs, table(spark, sf_dir, "labels")))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe_codec.encode(table(spark, sf_dir, "documents"), path, with_decoded=True)
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(damaged, copies_col="copies").conversations


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.word_counts(table(spark, sf_dir, "documents"), misspell=True)
    return spelling_variants.group_variants(words)


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {f.__name__: _shipped(f) for f in (op1_suffix_dedup, op2_language_id, op3_license_scan, op4_decontamination, op5_topk, op6_packing, op7_token_ids, op8_simhash, op9_pii, op10_quality, op11_bpe_codec, op12_conversation_repair, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": license_scan.scan_sql(), "op5_topk": TOPK_SQL}
