"""Shared storage and small helpers of the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utxolake.session import ensure_checkpoint_dir


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder that the driver did.

    Enough where that folder is visible to the executors; elsewhere submit the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor later costs a re-read, not a re-derivation.
    """
    spark = df.sparkSession
    path = shared_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_crc32(id_col: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (null: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % buckets


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))
