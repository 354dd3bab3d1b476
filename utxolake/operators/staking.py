"""Stake tables: D-14, D-16 ... D-21."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import hex_text, json_text
from ..functions.lists import ordered_list
from .common import Catalog, in_window, tx_pointer


def _stake(src: Catalog) -> DataFrame:
    return src["stake_address"].select(F.col("id").alias("addr_id"), F.col("hash_raw").alias("stake_raw"),
                                       F.col("view").alias("stake_address"))


def _pools(src: Catalog, key: str) -> DataFrame:
    return src["pool_hash"].select(F.col("id").alias(key), hex_text("hash_raw").alias("pool_hash"))


def rel_stake_hash(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-14: stake address text <-> hash, one row per registration."""
    ptr = tx_pointer(src, where)
    return (
        in_window(src, "stake_registration", "tx_id", ptr, where).select("addr_id", "tx_id")
        .join(ptr, "tx_id").join(_stake(src), "addr_id")
        .select("epoch_no", "slot_no", "stake_address", hex_text("stake_raw").alias("stake_addr_hash"))
    )


def delegation(src: Catalog, where: Column | None = None, max_list: int | None = None) -> DataFrame:
    """D-16: per (epoch, stake address) the delegation certificates, ordered by
    active epoch, slot, txidx (cert_index and id break ties).

    ``max_list`` (off by default, as upstream) splits a longer list into
    consecutive rows of at most that many items, without ever ranking a whole
    (epoch, address) group in one task.
    """
    from .outputs import clustered

    item = F.struct("active_epoch_no", "cert_index", "pool_hash", "slot_no", "txidx")
    ptr = tx_pointer(src, where).drop("slot_no")
    rows = (
        in_window(src, "delegation", "tx_id", ptr, where)
        .select("id", "addr_id", "pool_hash_id", "tx_id", "active_epoch_no", "cert_index", "slot_no")
        .join(ptr, "tx_id")
        .join(_stake(src), "addr_id")
        .join(_pools(src, "pool_hash_id"), "pool_hash_id")
    )
    keys = ["epoch_no", "stake_raw"]  # group on the raw hash; its hex text is a 1:1 function of it
    if max_list:
        rows = clustered(rows, ["stake_raw"], max_list, bucket=("active_epoch_no", "slot_no"),
                         within=("txidx", "cert_index", "id"))
        keys.append("cluster_no")
    return (
        rows.groupBy(*keys)
        .agg(ordered_list([F.col("active_epoch_no"), F.col("slot_no"), F.col("txidx"), F.col("cert_index"),
                           F.col("id")], item).alias("delegations"))
        .select("epoch_no", hex_text("stake_raw").alias("stake_addr_hash"),
                json_text("delegations").alias("delegations"))
    )


def _certificates(src: Catalog, table: str, where: Column | None) -> DataFrame:
    ptr = tx_pointer(src, where)
    return (
        in_window(src, table, "tx_id", ptr, where)
        .select(F.col("epoch_no").alias("cert_epoch_no"), "addr_id", "cert_index", "tx_id")
        .join(ptr, "tx_id")
        .join(_stake(src), "addr_id")
        .select(F.col("cert_epoch_no").alias("epoch_no"), hex_text("stake_raw").alias("stake_addr_hash"),
                "cert_index", "slot_no", "txidx")
    )


def stake_registration(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-17: the epoch column is the registration's own, not the block's."""
    return _certificates(src, "stake_registration", where)


def stake_deregistration(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-18."""
    return _certificates(src, "stake_deregistration", where)


def reward(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-19: keyed by the spendable epoch; rewards without a pool drop out (inner join)."""
    r = src["reward"]
    if where is not None:
        r = r.where(where)
    return (
        r.select("addr_id", "type", "amount", "earned_epoch", "spendable_epoch", "pool_id")
        .join(_stake(src), "addr_id")
        .join(_pools(src, "pool_id"), "pool_id")
        .select(F.col("spendable_epoch").alias("epoch_no"), hex_text("stake_raw").alias("stake_addr_hash"),
                F.col("type").cast("string"), F.col("amount").cast("bigint"), "earned_epoch", "pool_hash")
    )


def withdrawal(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-20."""
    ptr = tx_pointer(src, where)
    return (
        in_window(src, "withdrawal", "tx_id", ptr, where).select("addr_id", "amount", "tx_id")
        .join(ptr, "tx_id").join(_stake(src), "addr_id")
        .select("epoch_no", hex_text("stake_raw").alias("stake_addr_hash"), F.col("amount").cast("bigint"),
                "slot_no", "txidx")
    )


def epoch_stake(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-21."""
    es = src["epoch_stake"]
    if where is not None:
        es = es.where(where)
    return (
        es.select("epoch_no", "addr_id", "pool_id", "amount")
        .join(_stake(src), "addr_id")
        .join(_pools(src, "pool_id"), "pool_id")
        .select("epoch_no", hex_text("stake_raw").alias("stake_addr_hash"), "pool_hash", "amount")
    )
