"""Outputs by address and by stake address, in bounded clusters: D-12, D-13.

Each output gets ``cluster_no = (rank - 1) div cluster_size`` where ``rank``
is its position inside (epoch, address) in (slot, txidx, idx) order. A plain
``row_number() over (partition by epoch, address)`` would put every output of
a hot address into one task. So addresses with more than ``HOT`` outputs are
found beforehand, by the counts of their hashes. Rows of the others go to the
task of their (epoch, address) once, are ranked and grouped there. Rows of hot
ones come with their cluster, whose rank is split in two (``clustered``):

* ``off``: outputs of the same (epoch, address) in earlier slots - a running
  sum over per-slot counts, one row per (epoch, address, slot), so at most the
  number of slots (blocks) of an epoch per key;
* the rank inside (epoch, address, slot) - one block's outputs at most.

They are grouped by cluster, so no list holds more than ``cluster_size`` outputs
of one address, and a task at most ``HOT`` of them, or one block's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.encoding import hex_text, json_text
from ..functions.lists import sorted_structs
from .common import Catalog, in_window, tx_pointer

CLUSTER_SIZE = 1000
#: Outputs of one address that may lie in one task.
HOT = 100_000


def clustered(rows: DataFrame, keys: list[str], cluster_size: int, base: DataFrame | None = None,
              bucket: tuple[str, ...] = ("slot_no",), within: tuple[str, ...] = ("txidx", "idx")) -> DataFrame:
    """Add ``cluster_no`` to rows carrying ``epoch_no, *keys, *bucket, *within``.

    The list order is (``bucket``, ``within``). The per-bucket counts are an
    aggregate with map-side combine (only one row per key, bucket and map task is
    shuffled); their running sum gives each bucket's offset; the rank inside a
    bucket is a window over one bucket (one block for slot buckets). ``base``
    may give the same rows before lookups that do not change their number
    (left joins on unique keys), so that those lookups run once.
    """
    part = ["epoch_no", *keys]
    per_bucket = (base if base is not None else rows).groupBy(*part, *bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*part, *bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    in_bucket = Window.partitionBy(*part, *bucket).orderBy(*within)
    return (
        rows.withColumn("_r", F.row_number().over(in_bucket))
        .join(offsets, [*part, *bucket])
        .withColumn("cluster_no", F.floor((F.col("_off") + F.col("_r") - 1) / F.lit(cluster_size)).cast("bigint"))
        .drop("_r", "_off")
    )


def _hot_hashes(outs: DataFrame, key: str) -> DataFrame:
    """``_hash`` of keys with more than ``HOT`` outputs: less than a ``HOT``-th of the rows, so it may be broadcast."""
    counts = outs.groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > HOT).select("_hash")


def _lists(rows: DataFrame, attrs: list[str], cluster_size: int) -> DataFrame:
    """Output lists per cluster. ``_cluster`` is that of rows of hot addresses, null for the others, which are ranked here;
    ``_counts`` tells which rows count for the offsets of later slots."""
    part = ["epoch_no", "address", "_cluster"]
    before = Window.partitionBy(*part).orderBy("slot_no").rangeBetween(Window.unboundedPreceding, -1)
    in_slot = Window.partitionBy(*part, "slot_no").orderBy("txidx", "idx")
    off, rank = F.coalesce(F.sum(F.col("_counts").cast("bigint")).over(before), F.lit(0)), F.row_number().over(in_slot)
    return (
        rows.where(F.col("epoch_no").isNotNull() & F.col("address").isNotNull() & F.col("slot_no").isNotNull())
        .repartition(*part)
        .sortWithinPartitions(*part, "slot_no", "txidx", "idx")
        .withColumn("_off", off)
        .withColumn("_r", rank)
        .withColumn("cluster_no", F.coalesce("_cluster", F.floor((F.col("_off") + F.col("_r") - 1) / F.lit(cluster_size)).cast("bigint")))
        .groupBy(*part, *attrs, "cluster_no")
        .agg(sorted_structs(["slot_no", "txidx", "idx"], ["idx", "slot_no", "txidx"]).alias("outputs"))
    )


def _ranked(hot_rows: DataFrame) -> DataFrame:
    return hot_rows.withColumn("_counts", F.lit(True)).withColumnRenamed("cluster_no", "_cluster")


def _numbered(hashes: DataFrame, key: str, value: str) -> DataFrame:
    """``hashes`` with ``_first_<value>``, true for one row of each key."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(value))
    return hashes.withColumn(f"_first_{value}", nth == 1)


def rel_addr_txout(src: Catalog, where: Column | None = None, cluster_size: int = CLUSTER_SIZE) -> DataFrame:
    """D-12: per epoch and address (and address attributes), output pointer lists."""
    # hashes travel and group as they are; their text, twice as long, is made of the finished rows
    datums = src["datum"].select(F.col("id").alias("inline_datum_id"), F.col("hash").alias("inline_datum"))
    scripts = src["script"].select(F.col("id").alias("reference_script_id"), F.col("hash").alias("reference_script"))
    hashes = ["payment_cred", "data_hash", "inline_datum", "reference_script"]
    attrs = ["address_has_script", *hashes]
    columns = ["epoch_no", "address", *attrs, "slot_no", "txidx", "idx"]
    ptr = tx_pointer(src, where)
    made = in_window(src, "tx_out", "tx_id", ptr, where).select(
        "tx_id", F.col("index").alias("idx"), "address", "address_has_script", "payment_cred", "data_hash", "inline_datum_id",
        "reference_script_id")
    hot = F.broadcast(_hot_hashes(made, "address"))
    is_hot = F.xxhash64("address") == F.col("_hash")

    outs = made.join(hot, is_hot, "left_anti").join(ptr, "tx_id")
    # most outputs have neither, and needn't be shuffled for it
    neither = F.col("inline_datum_id").isNull() & F.col("reference_script_id").isNull()
    none = F.lit(None).cast("binary")
    plain = outs.where(neither).withColumns({"inline_datum": none, "reference_script": none, "_counts": F.lit(True)})
    found = (
        outs.where(~neither)
        .join(_numbered(datums, "inline_datum_id", "inline_datum"), "inline_datum_id", "left")
        .join(_numbered(scripts, "reference_script_id", "reference_script"), "reference_script_id", "left")
        .withColumn("_counts", F.coalesce("_first_inline_datum", F.lit(True)) & F.coalesce("_first_reference_script", F.lit(True)))
    )
    hot_outs = made.join(hot, is_hot, "left_semi").join(ptr, "tx_id")
    hot_rows = hot_outs.join(datums, "inline_datum_id", "left").join(scripts, "reference_script_id", "left").select(*columns)
    hot_rows = clustered(hot_rows, ["address"], cluster_size, base=hot_outs.select("epoch_no", "address", "slot_no"))
    rows = plain.select(*columns, "_counts").unionByName(found.select(*columns, "_counts"))
    rows = rows.withColumn("_cluster", F.lit(None).cast("bigint")).unionByName(_ranked(hot_rows))
    return _lists(rows, attrs, cluster_size).select(
        "epoch_no", "address", "address_has_script", *[hex_text(h).alias(h) for h in hashes], json_text("outputs").alias("outputs"))


def rel_stake_txout(src: Catalog, where: Column | None = None, cluster_size: int = CLUSTER_SIZE) -> DataFrame:
    """D-13: per epoch and stake address, output pointer lists (outputs without one drop out)."""
    stakes = src["stake_address"].select(F.col("id").alias("stake_address_id"), F.col("view").alias("address"))
    ptr = tx_pointer(src, where)
    made = in_window(src, "tx_out", "tx_id", ptr, where).select("tx_id", F.col("index").alias("idx"), "stake_address_id")
    made = made.where(F.col("stake_address_id").isNotNull())
    # ids may share an address, which is hot if one of them is
    hot = stakes.join(F.broadcast(_hot_hashes(made, "stake_address_id")), F.xxhash64("stake_address_id") == F.col("_hash"), "left_semi")
    hot = F.broadcast(hot.select("address").distinct())
    rows = made.join(ptr, "tx_id").join(stakes, "stake_address_id").select("epoch_no", "address", "slot_no", "txidx", "idx")
    hot_rows = clustered(rows.join(hot, "address", "left_semi"), ["address"], cluster_size)
    rows = rows.join(hot, "address", "left_anti").withColumns({"_counts": F.lit(True), "_cluster": F.lit(None).cast("bigint")})
    return _lists(rows.unionByName(_ranked(hot_rows)), [], cluster_size).select("epoch_no", "address", json_text("outputs").alias("outputs"))
