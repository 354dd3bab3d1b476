"""Per-epoch and single-row tables: D-26 ... D-30."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import hex_text
from .common import Catalog, tx_pointer

# Protocol parameter columns in the order of the epoch_param view.
EPOCH_PARAM_COLUMNS = [
    "epoch_no", "min_fee_a", "min_fee_b", "max_block_size", "max_tx_size", "max_bh_size", "key_deposit",
    "pool_deposit", "max_epoch", "optimal_pool_count", "influence", "monetary_expand_rate",
    "treasury_growth_rate", "decentralisation", "extra_entropy", "protocol_major", "protocol_minor",
    "min_utxo_value", "min_pool_cost", "nonce", "coins_per_utxo_size", "cost_model", "price_mem", "price_step",
    "max_tx_ex_mem", "max_tx_ex_steps", "max_block_ex_mem", "max_block_ex_steps", "max_val_size",
    "collateral_percent", "max_collateral_inputs",
]

# Columns of the param_proposal view, in order.
PARAM_PROPOSAL_COLUMNS = [
    "epoch_no", "key", "min_fee_a", "min_fee_b", "max_block_size", "max_tx_size", "max_bh_size", "key_deposit",
    "pool_deposit", "max_epoch", "optimal_pool_count", "influence", "monetary_expand_rate",
    "treasury_growth_rate", "decentralisation", "entropy", "protocol_major", "protocol_minor", "min_utxo_value",
    "min_pool_cost", "coins_per_utxo_size", "cost_model", "price_mem", "price_step", "max_tx_ex_mem",
    "max_tx_ex_steps", "max_block_ex_mem", "max_block_ex_steps", "max_val_size", "collateral_percent",
    "max_collateral_inputs", "registered_tx_slot_no", "registered_tx_index",
]

_HEX = {"extra_entropy", "nonce", "entropy", "key"}


def _costs(src: Catalog) -> DataFrame:
    return src["cost_model"].select(F.col("id").cast("bigint").alias("cost_model_id"), F.col("costs").alias("cost_model"))


def _project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[hex_text(c).alias(c) if c in _HEX else F.col(c) for c in cols])


def epoch_param(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-26: protocol parameters of each epoch, with the cost model text if any."""
    ep = src["epoch_param"]
    if where is not None:
        ep = ep.where(where)
    return _project(ep.join(_costs(src), "cost_model_id", "left"), EPOCH_PARAM_COLUMNS)


def param_proposal(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-27: parameter update proposals with the slot / index of their transaction."""
    reg = tx_pointer(src, where).select(
        F.col("tx_id").alias("registered_tx_id"), F.col("slot_no").alias("registered_tx_slot_no"),
        F.col("txidx").alias("registered_tx_index"))
    pp = src["param_proposal"].join(reg, "registered_tx_id").join(_costs(src), "cost_model_id", "left")
    return _project(pp, PARAM_PROPOSAL_COLUMNS)


def ada_pots(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-28."""
    ap = src["ada_pots"]
    if where is not None:
        ap = ap.where(where)
    return ap.select("epoch_no", "slot_no", "treasury", "reserves", "rewards", "utxo", "deposits", "fees")


def meta(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-29."""
    return src["meta"].select("start_time", "network_name", "version")


def schema_version(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-30."""
    return src["schema_version"].select("stage_one", "stage_two", "stage_three")
