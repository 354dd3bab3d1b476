"""Native asset minting: D-15."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import b64_text, hex_text, json_text
from ..functions.lists import ordered_list
from .common import Catalog, in_window, tx_pointer


def ma_minting(src: Catalog, where: Column | None = None, max_list: int | None = None) -> DataFrame:
    """D-15: mints per (epoch, asset) as ``[{quantity, slot_no, txidx}]`` ordered by
    slot, txidx (mint id breaks ties). Aggregated before the asset join.

    ``max_list`` (off by default, as upstream) splits a longer list into
    consecutive rows of at most that many items (skew-safe, see ``clustered``).
    """
    from .outputs import clustered

    ptr = tx_pointer(src, where)
    rows = (in_window(src, "ma_tx_mint", "tx_id", ptr, where).select("id", "ident", "quantity", "tx_id")
            .join(ptr, "tx_id"))
    keys = ["epoch_no", "ident"]
    if max_list:
        rows = clustered(rows, ["ident"], max_list, bucket=("slot_no",), within=("txidx", "id"))
        keys.append("cluster_no")
    per_asset = (
        rows
        .groupBy(*keys)
        .agg(ordered_list([F.col("slot_no"), F.col("txidx"), F.col("id")],
                          F.struct("quantity", "slot_no", "txidx")).alias("minting"))
    )
    assets = src["multi_asset"].select(F.col("id").alias("ident"), "fingerprint", "policy", "name")
    return per_asset.join(assets, "ident").select(
        "fingerprint", hex_text("policy").alias("policyid"), b64_text("name").alias("name_bytes"), "epoch_no",
        json_text("minting").alias("minting"))
