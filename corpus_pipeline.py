"""A corpus pipeline: what a training run reads, from the raw ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxolake.llm import decontaminate, packing, pii, quality_cnn, simhash
from utxolake.llm.common import ship_code, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects (score below 0.3) go. It is fitted to the stage's own documents."""
    model = quality_cnn.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_cnn.quality_score(spark, model, F.col("text")) >= quality_cnn.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by surrogates; n_chars follows the text."""
    return pii.pseudonymise(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pseudonyms", pseudonyms), ("packing", pack)]

#: The quality network, fingerprints and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    ship_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
