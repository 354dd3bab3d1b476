"""Stake pool tables: D-22 ... D-25."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import b64_text, hex_text, json_text
from .common import Catalog, tx_block, zoned


def _pools(src: Catalog, key: str) -> DataFrame:
    return src["pool_hash"].select(F.col("id").alias(key), hex_text("hash_raw").alias("pool_hash"))


def _tx(src: Catalog, key: str, where: Column | None = None, prefix: str = "") -> DataFrame:
    t = tx_block(src, where)
    return t.select(F.col("tx_id").alias(key), hex_text("hash").alias(f"{prefix}tx_hash"),
                    F.col("epoch_no").alias(f"{prefix}epoch_no"), F.col("slot_no").alias(f"{prefix}slot_no"),
                    F.col("txidx").alias(f"{prefix}txidx"))


def pool_update(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-22: pool registrations; updates without metadata drop out (inner joins)."""
    stake = src["stake_address"].select(F.col("id").alias("reward_addr_id"), hex_text("hash_raw").alias("reward_addr"))
    pmr = src["pool_metadata_ref"].select(
        F.col("id").alias("meta_id"), F.col("url").alias("metadata_url"), hex_text("hash").alias("metadata_hash"),
        F.col("registered_tx_id").alias("meta_tx_id"))
    meta_tx = src["tx"].select(F.col("id").alias("meta_tx_id"), hex_text("hash").alias("m_tx_hash"))  # only its hash: no block
    return (
        zoned(src, "pool_update", "registered_tx_id")
        .join(stake, "reward_addr_id")
        .join(_pools(src, "hash_id"), "hash_id")
        .join(pmr, "meta_id")
        .join(_tx(src, "registered_tx_id", where), "registered_tx_id")
        .join(meta_tx, "meta_tx_id")
        .select("active_epoch_no", "pool_hash", "cert_index", hex_text("vrf_key_hash").alias("vrf_key_hash"),
                F.col("pledge").cast("decimal(20,0)").alias("pledge"), "reward_addr",
                F.col("margin").cast("decimal(30,9)").alias("margin"),
                F.col("fixed_cost").cast("decimal(20,0)").alias("fixed_cost"),
                F.col("tx_hash").alias("registered_tx_hash"), "epoch_no", "metadata_url", "metadata_hash",
                F.col("m_tx_hash").alias("metadata_registered_tx_hash"))
    )


def pool_retire(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-23."""
    return (
        zoned(src, "pool_retire", "announced_tx_id").join(_pools(src, "hash_id"), "hash_id")
        .join(_tx(src, "announced_tx_id", where), "announced_tx_id")
        .select("pool_hash", "retiring_epoch", "epoch_no", "cert_index",
                F.col("tx_hash").alias("announced_tx_hash"), "slot_no", F.col("txidx").alias("announced_txidx"))
    )


def pool_owner(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-24."""
    pu = zoned(src, "pool_update", "registered_tx_id").select(F.col("id").alias("pool_update_id"), "hash_id", "registered_tx_id")
    owners = src["stake_address"].select(F.col("id").alias("addr_id"), hex_text("hash_raw").alias("addr_hash"))
    return (
        zoned(src, "pool_owner", "pool_update_id", "pool_update").select("addr_id", "pool_update_id")
        .join(pu, "pool_update_id")
        .join(_pools(src, "hash_id"), "hash_id")
        .join(owners, "addr_id")
        .join(_tx(src, "registered_tx_id", where), "registered_tx_id")
        .select("pool_hash", "epoch_no", "addr_hash", "slot_no", "txidx")
    )


# The keys kept from the off-chain pool JSON, in output order.
OFFLINE_KEYS = ["description", "homepage", "name", "ticker"]


def pool_offline_data(src: Catalog, where: Column | None = None, full_json: bool = False) -> DataFrame:
    """D-25: off-chain pool data with its metadata reference.

    ``json`` keeps four keys (missing -> null) unless ``full_json`` asks for the
    whole document. Rows without a metadata reference drop out.
    """
    doc = F.parse_json("json")
    if full_json:
        projected = F.to_json(doc)
    else:
        projected = json_text(F.struct(*[F.try_variant_get(doc, f"$.{k}", "variant").alias(k) for k in OFFLINE_KEYS]))
    pmr = zoned(src, "pool_metadata_ref", "registered_tx_id").select(
        F.col("id").alias("pmr_id"), F.col("url").alias("metadata_url"), b64_text("hash").alias("metadata_hash"),
        "registered_tx_id")
    return (
        zoned(src, "pool_offline_data", "pmr_id", "pool_metadata_ref").select("pool_id", "ticker_name", "pmr_id", projected.alias("json"))
        .join(pmr, "pmr_id")
        .join(_pools(src, "pool_id"), "pool_id")
        .join(_tx(src, "registered_tx_id", where), "registered_tx_id")
        .select("pool_hash", "epoch_no", "ticker_name", "json", "metadata_url", "metadata_hash",
                F.col("tx_hash").alias("metadata_registered_tx_hash"))
    )
