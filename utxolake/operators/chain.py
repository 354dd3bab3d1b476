"""Block and transaction tables: D-01 ... D-08."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import canonical_json, hex_text, json_text
from ..functions.lists import ordered_list, sorted_structs
from .common import Catalog, blocks, in_window, restrict, tx_block, tx_pointer


def block(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-01: one row per block that holds transactions (empty blocks drop out)."""
    b = blocks(src, where)
    txs = restrict(src, "tx", "block_id", None if where is None else b, ids_key="id", of="block")
    # eager aggregation: one partial row per block and map task is shuffled, not every tx
    per_block = txs.groupBy("block_id").agg(
        F.sum("fee").cast("decimal(38,0)").alias("sum_tx_fee"),
        F.sum("script_size").cast("bigint").alias("sum_script_size"),
        F.count_if(F.col("script_size") > 0).alias("script_count"),
    )
    leaders = src["slot_leader"].select(F.col("id").alias("slot_leader_id"), "pool_hash_id")
    pools = src["pool_hash"].select(F.col("id").alias("pool_hash_id"), hex_text("hash_raw").alias("pool_hash"))
    return (
        b.withColumnRenamed("id", "block_id")
        .join(per_block, "block_id")
        .join(leaders, "slot_leader_id")
        .join(pools, "pool_hash_id", "left")
        .select(
            "epoch_no", "slot_no", F.col("time").alias("block_time"), F.col("size").alias("block_size"),
            "tx_count", "sum_tx_fee", "script_count", "sum_script_size", "pool_hash",
        )
    )


def block_hash(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-02."""
    return blocks(src, where).select("epoch_no", "slot_no", hex_text("hash").alias("block_hash"))


def tx(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-03: transactions with input / output counts (0 when none)."""
    t = tx_block(src, where)
    ids = t.select("tx_id") if where is not None else None
    n_in = restrict(src, "tx_in", "tx_in_id", ids).groupBy(F.col("tx_in_id").alias("tx_id")).agg(
        F.count(F.lit(1)).alias("count_inputs"))
    n_out = restrict(src, "tx_out", "tx_id", ids).groupBy("tx_id").agg(F.count(F.lit(1)).alias("count_outputs"))
    return (
        t.join(n_in, "tx_id", "left")
        .join(n_out, "tx_id", "left")
        .select(
            "epoch_no", hex_text("hash").alias("tx_hash"), "block_time", "slot_no", "txidx",
            "out_sum", "fee", "deposit", "size", "invalid_before",
            F.col("invalid_hereafter").alias("invalid_after"), F.col("valid_contract").alias("valid_script"),
            "script_size",
            F.coalesce("count_inputs", F.lit(0)).alias("count_inputs"),
            F.coalesce("count_outputs", F.lit(0)).alias("count_outputs"),
        )
    )


def tx_hash(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-04."""
    return tx_block(src, where).select("epoch_no", "slot_no", "txidx", hex_text("hash").alias("tx_hash"))


def tx_in_out(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-05: per transaction, JSON lists of spent inputs and created outputs.

    inputs  = [{in_idx, in_slot_no, in_txidx}] ordered by slot, txidx, idx
    outputs = [{out_address, out_idx, out_ma, out_value}] ordered by idx, where
    out_ma  = [{fingerprint, quantity}] ordered by fingerprint, quantity.
    A list without elements is NULL at every level.
    """
    t = tx_block(src, where)
    ids = t.select("tx_id") if where is not None else None

    spent = tx_pointer(src, prefix="in_")
    # rows go to their group before lists are made of them: nested lists take several times the bytes in a shuffle
    inputs = (
        restrict(src, "tx_in", "tx_in_id", ids)
        .join(spent, F.col("tx_out_id") == F.col("in_tx_id"))
        .select(F.col("tx_in_id").alias("tx_id"), "in_slot_no", "in_txidx", F.col("tx_out_index").alias("in_idx"))
        .repartition("tx_id")
        .groupBy("tx_id")
        .agg(sorted_structs(["in_slot_no", "in_txidx", "in_idx"], ["in_idx", "in_slot_no", "in_txidx"]).alias("inputs"))
    )

    outs = restrict(src, "tx_out", "tx_id", ids)
    assets = src["multi_asset"].select(F.col("id").alias("ident"), "fingerprint")
    ma = (
        restrict(src, "ma_tx_out", "tx_out_id", None if where is None else outs, ids_key="id", of="tx_out")
        .join(assets, "ident")
        .select("tx_out_id", "fingerprint", "quantity")
        .repartition("tx_out_id")
        .groupBy("tx_out_id")
        .agg(sorted_structs(["fingerprint", "quantity"]).alias("out_ma"))
    )
    outputs = (
        outs.join(ma, F.col("id") == F.col("tx_out_id"), "left")
        .select("tx_id", F.col("index").alias("out_idx"), F.col("address").alias("out_address"), "out_ma",
                F.col("value").alias("out_value"))
        .repartition("tx_id")
        .groupBy("tx_id")
        .agg(sorted_structs(["out_idx", "out_address", "out_ma", "out_value"],
                            ["out_address", "out_idx", "out_ma", "out_value"]).alias("outputs"))
    )
    return (
        t.join(inputs, "tx_id", "left")
        .join(outputs, "tx_id", "left")
        .select("epoch_no", "slot_no", "txidx", json_text("inputs").alias("inputs"),
                json_text("outputs").alias("outputs"))
    )


def tx_consumed_output(src: Catalog, where: Column | None = None, with_epoch: bool = False) -> DataFrame:
    """D-06: producer pointer -> consumer pointer. ``where`` selects consumer blocks.

    ``with_epoch`` keeps the consumer's epoch (``consumed_in_epoch_no``), the
    storage partition of this table, which has no epoch column of its own.
    """
    producer = tx_pointer(src).select(
        F.col("tx_id").alias("tx_out_id"), "slot_no", "txidx")
    consumer = tx_pointer(src, where).select(
        F.col("tx_id").alias("tx_in_id"), F.col("slot_no").alias("consumed_in_slot_no"),
        F.col("txidx").alias("consumed_in_txidx"), F.col("epoch_no").alias("consumed_in_epoch_no"))
    cols = ["slot_no", "txidx", F.col("tx_out_index").alias("index"), "consumed_in_slot_no", "consumed_in_txidx"]
    return (
        in_window(src, "tx_in", "tx_in_id", consumer, where, "tx_in_id").join(consumer, "tx_in_id")
        .join(producer, "tx_out_id")
        .select(*cols, *(["consumed_in_epoch_no"] if with_epoch else []))
    )


def tx_metadata(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-07: per transaction with metadata, ``[{"index": key, "meta": json}]`` ordered by key.

    The element is assembled as text because ``meta`` is a JSON value, not a
    string; ``canonical_json`` fixes its spelling (sorted keys, no blanks).
    """
    t = tx_block(src, where)
    ids = t.select("tx_id") if where is not None else None
    md = restrict(src, "tx_metadata", "tx_id", ids)
    item = F.concat(F.lit('{"index":'), F.col("key").cast("string"), F.lit(',"meta":'),
                    F.coalesce(canonical_json("json"), F.lit("null")), F.lit("}"))
    per_tx = md.groupBy("tx_id").agg(
        F.concat(F.lit("["), F.array_join(ordered_list([F.col("key"), F.col("id")], item), ","), F.lit("]"))
        .alias("metadata"))
    return t.join(per_tx, "tx_id").select(
        "epoch_no", hex_text("hash").alias("tx_hash"), "slot_no", "txidx", "metadata")


def collateral(src: Catalog, where: Column | None = None) -> DataFrame:
    """D-08: spending pointer + referenced output pointer."""
    spender = tx_pointer(src, where).withColumnRenamed("tx_id", "tx_in_id")
    spent = tx_pointer(src, prefix="o_").withColumnRenamed("o_tx_id", "tx_out_id")
    return (
        in_window(src, "collateral_tx_in", "tx_in_id", spender, where, "tx_in_id").join(spender, "tx_in_id")
        .join(spent, "tx_out_id")
        .select("epoch_no", "slot_no", "txidx", F.col("o_epoch_no").alias("epoch_no_out"),
                F.col("o_slot_no").alias("slot_no_out"), F.col("o_txidx").alias("txidx_out"), "tx_out_index")
    )
