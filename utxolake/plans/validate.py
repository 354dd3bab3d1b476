"""Deep compare job (V-12) with its audit log (V-10).

Both sides are DataFrames: the source derivation and the copy in the target.
All epochs of a table are fingerprinted in one aggregation per side and joined
(V-08); the result rows are appended to ``log_deep_comparison``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.derive import DERIVE
from ..operators.fingerprint import SPECS, fingerprint_compare, fingerprint_table, row_diff, row_text
from ..sources.sinks import HIDDEN, Warehouse
from .registry import OWN_EPOCH, TABLES
from .windows import source_head

# The tables the reference compares (datum added, cost_model has no producer).
COMPARED = list(SPECS)


def compare_table(table: str, left: DataFrame, right: DataFrame, blocks: DataFrame,
                  epochs: list[int] | None = None, buckets: int | None = None, mode: str = "multiset"
                  ) -> DataFrame:
    """V-08 for one table: ``tablename, <group keys>, left/right rows and hash, status``."""
    spec = SPECS[table]
    lf = fingerprint_table(table, left, blocks=blocks, buckets=buckets, mode=mode)
    rf = fingerprint_table(table, right, blocks=blocks, buckets=buckets, mode=mode)
    keys = [*spec.by, *(["shard"] if spec.shards else [])]
    if epochs is not None and "epoch_no" in keys:
        lf, rf = lf.where(F.col("epoch_no").isin(epochs)), rf.where(F.col("epoch_no").isin(epochs))
    if not keys:  # single-row tables: one fingerprint per side
        lf, rf = lf.withColumn("_k", F.lit(0)), rf.withColumn("_k", F.lit(0))
        keys = ["_k"]
    out = fingerprint_compare(lf, rf, keys).drop("_k")
    if "epoch_no" not in out.columns:
        out = out.withColumn("epoch_no", F.lit(None).cast("bigint"))
    return out.withColumn("tablename", F.lit(table))


def audit_rows(cmp: DataFrame, left_desc: str, right_desc: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """V-10: the audit log row of each compared group (``'empty'`` for a missing side).

    ``{table}`` in a description stands for the table's name; ``start`` and ``end`` are the times of the comparison.
    """
    times = [F.lit(t).cast("timestamp") if t else F.current_timestamp() for t in (start, end)]
    desc = [F.replace(F.lit(d), F.lit("{table}"), F.col("tablename")) for d in (left_desc, right_desc)]
    return cmp.select(
        "epoch_no", F.col("tablename").alias("table_name"), times[0].alias("start_time"), times[1].alias("end_time"),
        desc[0].alias("pg_query"), desc[1].alias("bq_query"),
        F.coalesce("left_hash", F.lit("empty")).alias("pg_hash"),
        F.coalesce("right_hash", F.lit("empty")).alias("bq_hash"))


def deep_compare_job(src, wh: Warehouse, tables: list[str] | None = None, epochs: list[int] | str | None = None,
                     derive_kw: dict | None = None, buckets: int | None = None, audit: bool = True,
                     mode: str = "multiset") -> DataFrame:
    """V-12: compare every table of the target with the source derivation.

    ``epochs`` defaults to the last complete one; ``"all"`` compares the whole tables (the open epoch, which the
    targets trail, then differs). Only the epochs asked for are derived and read. ``mode`` is the fingerprint of
    both sides: ``multiset`` (default: a partial-aggregated sum, skew-proof) or ``exact`` (the reference digest, one
    task per epoch). Returns the per-group comparison.
    """
    start = datetime.now(timezone.utc)
    if epochs is None:
        epochs = [source_head(src["block"]).first()["head_epoch_no"] - 1]
    chosen = None if epochs == "all" else list(epochs)
    out = None
    for t in tables or COMPARED:
        kw = dict((derive_kw or {}).get(t, {}))
        part = TABLES[t].part_col if t in TABLES else None
        left, right = DERIVE[t](src, **kw), wh.read(t, hidden=True)
        if chosen is not None and part:
            if t not in OWN_EPOCH:
                left = DERIVE[t](src, F.col("epoch_no").isin(chosen), **kw)
            elif "epoch_no" in left.columns:
                left = left.where(F.col("epoch_no").isin(chosen))
            right = right.where(F.col(part).isin(chosen))
        right = right.drop(*[c for c in HIDDEN if c in right.columns])
        cmp = compare_table(t, left, right, src["block"], chosen, buckets, mode)
        if "shard" not in cmp.columns:
            cmp = cmp.withColumn("shard", F.lit(None).cast("int"))
        cmp = cmp.select("tablename", "epoch_no", "shard", "left_rows", "left_hash", "right_rows", "right_hash",
                         "status")
        if audit:  # compared once, table by table: the driver holds the broadcasts of one; log and result read the same rows
            wh.write_stage(cmp, "deep_compare", f"result_{t}")
            cmp = wh.read_stage("deep_compare", f"result_{t}")
        out = cmp if out is None else out.unionByName(cmp)
    if audit:
        which = "" if chosen is None else f" WHERE epoch_no IN ({', '.join(map(str, chosen))})"
        wh.append("log_deep_comparison", audit_rows(
            out, f"derive({{table}}){which}", f"SELECT * FROM parquet.`{wh.root}/{{table}}`{which}",
            start, datetime.now(timezone.utc)), None)
    return out


def _digest_bucket(df: DataFrame, table: str, buckets: int) -> tuple[Column, Column]:
    """Bucket of a row, from its text's hash, and 48 bits of that hash."""
    digest = F.sha2(row_text(df, SPECS[table]), 256)
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("bigint") % buckets), F.conv(F.substring(digest, 5, 12), 16, 10).cast("bigint")


def drill_down(table: str, left: Callable[[list[int] | None], DataFrame], right: Callable[[list[int] | None], DataFrame],
               buckets: int = 64, epochs: list[int] | None = None) -> DataFrame:
    """V-08 down to V-09: the rows of ``table`` in which two sides differ, with their ``bucket`` and ``side``.

    A side is called with epochs (None: all) and gives their rows. Both are first summed up by epoch and bucket of the
    row's hash (count, sum and exclusive or of 48-bit hashes, combined map-side). Only epochs with a bucket that
    differs are asked for again, and only their differing buckets compared row by row. What comes to the driver is
    bounded by epochs times buckets.
    """
    def with_bucket(df: DataFrame) -> DataFrame:
        bucket, bits = _digest_bucket(df, table, buckets)
        return df.withColumn("bucket", bucket).withColumn("_bits", bits)

    def summed(df: DataFrame, side: str) -> DataFrame:
        sums = with_bucket(df).groupBy("epoch_no", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_bits").cast("decimal(38,0)")).alias("s"), F.bit_xor("_bits").alias("x"))
        return sums.select(F.coalesce("epoch_no", F.lit(-1)).alias("epoch"), "bucket", F.struct("n", "s", "x").alias(side))

    compared = summed(left(epochs), "l").join(summed(right(epochs), "r"), ["epoch", "bucket"], "full_outer").where(~F.col("l").eqNullSafe(F.col("r")))
    differing = compared.select("epoch", "bucket").collect()  # epochs x buckets at most
    chosen = sorted({r["epoch"] for r in differing})
    spark = compared.sparkSession
    places = spark.createDataFrame([tuple(r) for r in differing], "_epoch bigint, _bucket bigint")

    def rows(side: Callable[[list[int] | None], DataFrame]) -> DataFrame:
        df = with_bucket(side(chosen if -1 not in chosen else epochs)).drop("_bits")
        here = (F.coalesce(df["epoch_no"], F.lit(-1)) == F.col("_epoch")) & (df["bucket"] == F.col("_bucket"))
        return df.join(F.broadcast(places), here, "left_semi")  # epochs x buckets rows

    return row_diff(rows(left), rows(right))


def drill_down_job(src, wh: Warehouse, table: str, epochs: list[int] | None = None, derive_kw: dict | None = None, buckets: int = 64) -> DataFrame:
    """The rows in which a target table and the source's derivation differ. Only differing epochs are derived a second
    time; of the target only their partitions are read."""
    kw, part = derive_kw or {}, TABLES[table].part_col
    if part != "epoch_no":
        raise ValueError(f"{table} is not partitioned by its epoch")

    def left(chosen: list[int] | None) -> DataFrame:
        if chosen is None:
            return DERIVE[table](src, **kw)
        here = F.col("epoch_no").isin(chosen)
        return DERIVE[table](src, **kw).where(here) if table in OWN_EPOCH else DERIVE[table](src, here, **kw)

    def right(chosen: list[int] | None) -> DataFrame:
        df = wh.read(table)
        return df if chosen is None else df.where(F.col("epoch_no").isin(chosen))

    return drill_down(table, left, right, buckets, epochs)
