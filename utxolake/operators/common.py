"""Shared pieces of the table derivations.

A *catalog* is anything indexable by relation name that returns a DataFrame
(``dict[str, DataFrame]``, ``StandIn``, ``sources.loader.load_source``).

``where`` arguments are predicates over the ``block`` relation (``slot_no``,
``epoch_no``). They are applied to ``block`` before any join or aggregation, so
a slot window or an epoch reaches the scan and only matching transactions flow
into the aggregates (W-04 / P-02 semantics).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Catalog = Mapping[str, DataFrame]


def blocks(src: Catalog, where: Column | None = None) -> DataFrame:
    b = src["block"]
    return b if where is None else b.where(where)


class ZonedCatalog(Mapping):
    """A source with the id ranges of one slot window, known beforehand (``plans.zones``).

    ``ranges`` has the first and last id per relation; one without a range has no row in the window. With ``open_end``
    rows may still come, so ranges have no upper end and a relation without a range is not bounded.
    """

    def __init__(self, src: Catalog, ranges: Mapping[str, tuple[int, int]], open_end: bool):
        self.src, self.ranges, self.open_end = src, ranges, open_end

    def within(self, df: DataFrame, key: str, of: str) -> DataFrame:
        """Rows of ``df`` whose ``key``, an id of relation ``of``, can lie in the window."""
        if of not in self.ranges:
            return df if self.open_end else df.where(F.lit(False))
        lo, hi = self.ranges[of]
        return df.where(F.col(key) >= lo) if self.open_end else df.where(F.col(key).between(lo, hi))

    def __getitem__(self, name: str) -> DataFrame:
        return self.src[name]

    def __iter__(self):
        return iter(self.src)

    def __len__(self) -> int:
        return len(self.src)


def id_range(src: Catalog, df: DataFrame, key: str, of: str, ids: DataFrame, ids_key: str) -> DataFrame:
    """Add the range of the window's ids of relation ``of`` to ``key`` as a literal predicate.

    Source ids grow with the chain, so a slot window maps to a narrow id range;
    as a literal the range reaches the Parquet scan and skips row groups by
    their min/max statistics (a join alone would read the whole relation). A
    source that doesn't know the range is asked for the bounds of ``ids``, which
    is a Spark job; only the two bounds come to the driver.
    """
    if isinstance(src, ZonedCatalog):
        return src.within(df, key, of)
    lo, hi = ids.agg(F.min(ids_key), F.max(ids_key)).first()
    if lo is None:
        return df.where(F.lit(False))
    return df.where(F.col(key).between(lo, hi))


def tx_block(src: Catalog, where: Column | None = None) -> DataFrame:
    """Transactions with their block: ``tx_id, epoch_no, slot_no, block_time, txidx`` + tx columns."""
    b = blocks(src, where).select(
        F.col("id").alias("block_id"), "epoch_no", "slot_no", F.col("time").alias("block_time"))
    t = src["tx"]
    if where is not None:
        t = id_range(src, t, "block_id", "block", b, "block_id")
    return t.withColumnRenamed("id", "tx_id").join(b, "block_id").withColumnRenamed("block_index", "txidx")


def tx_pointer(src: Catalog, where: Column | None = None, prefix: str = "") -> DataFrame:
    """Narrow ``tx_id -> (epoch_no, slot_no, txidx)`` pointer, columns renamed with ``prefix``."""
    t = tx_block(src, where)
    return t.select(
        F.col("tx_id").alias(f"{prefix}tx_id"),
        F.col("epoch_no").alias(f"{prefix}epoch_no"),
        F.col("slot_no").alias(f"{prefix}slot_no"),
        F.col("txidx").alias(f"{prefix}txidx"),
    )


def restrict(src: Catalog, name: str, key: str, ids: DataFrame | None, ids_key: str = "tx_id", of: str = "tx") -> DataFrame:
    """Rows of relation ``name`` whose ``key`` lies in the id range of ``ids``, ids of ``of`` (all rows if None).

    Used before an eager aggregate so that a windowed run aggregates the rows of
    the window instead of the whole relation. Every caller joins the aggregate
    back to the window's own rows, which drops the (few) ids that the range lets
    through without being in the window, so no semi join is needed.
    """
    return src[name] if ids is None else id_range(src, src[name], key, of, ids, ids_key)


def in_window(src: Catalog, name: str, key: str, ptr: DataFrame, where: Column | None, ptr_key: str = "tx_id") -> DataFrame:
    """Relation ``name`` limited to the id range of the windowed pointer (no-op without a window).

    The join with ``ptr`` that follows keeps the result exact; the literal range
    lets the scan skip row groups outside the window.
    """
    return src[name] if where is None else id_range(src, src[name], key, "tx", ptr, ptr_key)


def zoned(src: Catalog, name: str, key: str, of: str = "tx") -> DataFrame:
    """Relation ``name`` limited to the window's ids of ``of`` if the source knows them. For rows that a join
    with the window's own rows follows."""
    return src.within(src[name], key, of) if isinstance(src, ZonedCatalog) else src[name]
