"""Datums, scripts and redeemers: D-09 ... D-11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import b64_text, hex_text, json_text
from ..functions.lists import ordered_list
from .common import Catalog, in_window, tx_pointer, zoned


def datum(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-09."""
    ptr = tx_pointer(src, where)
    return in_window(src, "datum", "tx_id", ptr, where).join(ptr, "tx_id").select(
        "epoch_no", "slot_no", "txidx", hex_text("hash").alias("datum_hash"), b64_text("bytes").alias("bytes"),
        "value")


def script(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-10."""
    ptr = tx_pointer(src, where)
    return in_window(src, "script", "tx_id", ptr, where).join(ptr, "tx_id").select(
        "epoch_no", "slot_no", "txidx", hex_text("hash").alias("script_hash"), F.col("type").cast("string"),
        "json", b64_text("bytes").alias("bytes"), "serialised_size")


def redeemer(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-11: per transaction, the redeemer count and a list of 9-key objects.

    The list is ordered by purpose, index (the source leaves it unordered);
    ``redeemer_data_value`` is embedded as a JSON value (variant), not as text.
    """
    rd = zoned(src, "redeemer_data", "id", "redeemer_data").select(
        F.col("id").alias("redeemer_data_id"), "bytes", "value", F.col("hash").alias("data_hash"))
    # elements are serialized before sorting: a variant field is not orderable
    item = json_text(F.struct(
        b64_text("bytes").alias("byte"), "fee", "index", "purpose", F.parse_json("value").alias("redeemer_data_value"),
        hex_text("data_hash").alias("redeemer_hash"), hex_text("script_hash").alias("script_hash"), "unit_mem", "unit_steps"))
    ptr = tx_pointer(src, where)
    per_tx = (
        in_window(src, "redeemer", "tx_id", ptr, where).join(ptr, "tx_id")
        .join(rd, "redeemer_data_id")
        .select("tx_id", "epoch_no", "slot_no", "txidx", "id", "purpose", "index", "fee", "unit_mem", "unit_steps",
                "script_hash", "data_hash", "bytes", "value")
        .repartition("tx_id")  # rows go to their group as they are; their text is several times as long
        .groupBy("tx_id", "epoch_no", "slot_no", "txidx")
        .agg(F.count(F.lit(1)).alias("count"),
             ordered_list([F.col("purpose"), F.col("index"), F.col("id")], item).alias("items"))
    )
    return per_tx.select("epoch_no", "slot_no", "txidx", "count",
                         F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("redeemers"))
