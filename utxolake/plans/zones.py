"""Zone map: for every zone of slots, the range of ids that each source relation has there.

Source ids grow with the chain, so a slot window maps to narrow id ranges. As literals they reach the scans of
the relations that hang on transactions, which then skip row groups by their statistics. The map
is a versioned table of the target (``ZONES``: ``slot_no`` is a zone's first slot, ``relation``, ``first_id``,
``last_id``), maintained by the slot sync, which reads it once for all windows it has planned. A refresh
computes only zones that blocks may still reach since the last one, and narrows its own scans the same way.

Ranges are exact for whatever ids the source has, grown with the chain or not: they are the least and
greatest id of the zone's rows, so a window misses none of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import Catalog, ZonedCatalog
from ..sources.sinks import CommitConflict, TableState, Warehouse
from .windows import SlotWindowConfig

ZONES = "_zones"
#: Whose ids a zone bounds beside blocks and transactions: (relation, its id, the transaction it hangs on).
HANG_ON_TX = {
    "tx_out": ("tx_out", "id", "tx_id"),
    "pool_update": ("pool_update", "id", "registered_tx_id"),
    "pool_metadata_ref": ("pool_metadata_ref", "id", "registered_tx_id"),
    "redeemer_data": ("redeemer", "redeemer_data_id", "tx_id"),
}
RETRIES = 3


def zone_rows(src: Catalog, lo: int, hi: int, size: int) -> DataFrame | None:
    """``slot_no, relation, first_id, last_id`` of the zones that begin in ``lo .. hi``; None without a block there.

    A zone in which a relation has no row has no row here.
    """
    zone = (F.floor(F.col("slot_no") / size) * size).cast("bigint")
    blocks = src["block"].where(F.col("slot_no").between(lo, hi)).select(F.col("id").alias("block_id"), zone.alias("slot_no"))
    first, last = blocks.agg(F.min("block_id"), F.max("block_id")).first()
    if first is None:
        return None
    txs = src["tx"].where(F.col("block_id").between(first, last)).select(F.col("id").alias("tx_id"), "block_id")
    txs = txs.join(blocks, "block_id").select("tx_id", "slot_no")
    first, last = txs.agg(F.min("tx_id"), F.max("tx_id")).first()
    ids = [(blocks, "block", "block_id"), (txs, "tx", "tx_id")]
    for name, (relation, key, tx_id) in HANG_ON_TX.items() if first is not None else ():
        rows = src[relation].where(F.col(tx_id).between(first, last)).select(F.col(key).alias("_id"), F.col(tx_id).alias("tx_id"))
        ids.append((rows.join(txs, "tx_id"), name, "_id"))
    out = None
    for rows, name, key in ids:
        part = rows.where(F.col(key).isNotNull()).groupBy("slot_no").agg(F.min(key).cast("bigint").alias("first_id"), F.max(key).cast("bigint").alias("last_id"))
        part = part.select("slot_no", F.lit(name).alias("relation"), "first_id", "last_id")
        out = part if out is None else out.unionByName(part)
    return out


def refresh_zones(src: Catalog, wh: Warehouse, lo: int, hi: int, head: int, cfg: SlotWindowConfig, size: int) -> TableState:
    """Extend the stored map to slots ``lo .. hi`` of a source with head ``head``.

    Its watermark is the slot up to which zones are settled: windows of later runs re-derive nothing below
    it. Zones from there on are computed again; a map of another zone size, or one that begins later, is replaced.
    """
    base = wh.state(ZONES)
    lo, hi = lo // size * size, hi // size * size + size - 1
    known = base.extra.get("zones")
    start = lo
    if known and known["size"] == size:
        hi = max(hi, known["to"])
        if known["from"] <= lo:
            lo, start = known["from"], base.slot
    if start > hi:
        return base
    rows = zone_rows(src, start, hi, size)
    first = start // wh.bucket_slots
    drop = [leaf for leaf in base.leaves if start == lo or leaf.bucket >= first]
    edge = [] if start == lo else [leaf for leaf in drop if leaf.bucket == first]
    carried = wh.read_leaves(ZONES, base, edge).where(F.col("slot_no") < start) if edge else None
    settled = max(lo, min(hi + 1, (head - cfg.grace - cfg.delete) // size * size))
    extra = {"zones": {"size": size, "from": lo, "to": hi}}
    if rows is None:
        rows = wh.spark.createDataFrame([], "slot_no BIGINT, relation STRING, first_id BIGINT, last_id BIGINT")
    load = wh.write_load(ZONES, rows.withColumn("part", F.lit(0)), "part", carried, window=True)
    return wh.publish(ZONES, base, load, drop, settled, extra=extra)


@dataclass
class ZoneMap:
    """The id ranges of some windows, and the slot from which on more rows may still come."""
    settled: int
    ranges: dict[tuple[int, int], dict[str, tuple[int, int]]] = field(default_factory=dict)

    def window(self, src: Catalog, lo: int, hi: int) -> Catalog:
        """``src`` with the ranges of the window ``lo .. hi``, open above if it reaches unsettled slots."""
        ranges = self.ranges.get((max(0, lo), hi))  # there are no slots below 0
        return src if ranges is None else ZonedCatalog(src, ranges, hi >= self.settled)


def read_zones(wh: Warehouse, state: TableState, windows: list[tuple[int, int]]) -> ZoneMap:
    """The ranges of the windows by one job: at most windows x relations rows come to the driver."""
    zones = state.extra["zones"]
    out = ZoneMap(state.slot, {w: {} for w in windows if zones["from"] <= w[0] // zones["size"] * zones["size"] and w[1] <= zones["to"]})
    if not out.ranges:
        return out
    size = zones["size"]
    asked = wh.spark.createDataFrame(list(out.ranges), "lo BIGINT, hi BIGINT")
    of_zone = asked.select("lo", "hi", F.explode(F.sequence((F.floor(F.col("lo") / size) * size).cast("bigint"), F.col("hi"), F.lit(size).cast("bigint"))).alias("slot_no"))
    # a zone lies in the bucket of its first slot, which may be any number of buckets before the window's
    buckets = {b for lo, hi in out.ranges for b in range(lo // size * size // wh.bucket_slots, hi // wh.bucket_slots + 1)}
    rows = wh.read_leaves(ZONES, state, [leaf for leaf in state.leaves if leaf.bucket in buckets]).select("slot_no", "relation", "first_id", "last_id")
    for r in rows.join(of_zone, "slot_no").groupBy("lo", "hi", "relation").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")).collect():
        out.ranges[r["lo"], r["hi"]][r["relation"]] = (r["first_id"], r["last_id"])
    return out


def zones_for(src: Catalog, wh: Warehouse, windows: list[tuple[int, int]], head: int, cfg: SlotWindowConfig, size: int) -> ZoneMap:
    """The map for planned windows, refreshed as far as they reach. If other jobs keep publishing the map, an empty
    one: windows then look their ranges up in the source."""
    lo, hi = max(0, min(w[0] for w in windows)), max(w[1] for w in windows)
    wanted = sorted({(max(0, a), b) for a, b in windows if b >= max(0, a)})
    if hi < lo:
        return ZoneMap(0)
    for _ in range(RETRIES):
        try:
            return read_zones(wh, refresh_zones(src, wh, lo, hi, head, cfg, size), wanted)
        except CommitConflict:
            continue
    return ZoneMap(0)
