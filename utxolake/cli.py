"""spark-submit entry point for the four jobs of the reference deployment.

    spark-submit -m utxolake.cli slot-sync    --source s3://.../export --target s3://.../tables
    spark-submit -m utxolake.cli epoch-sync   --source ... --target ...
    spark-submit -m utxolake.cli backfill     --source ... --target ... [--tables tx,block]
    spark-submit -m utxolake.cli deep-compare --source ... --target ... [--epochs 450,451]
    spark-submit -m utxolake.cli freshness    --source ... --target ...

``--source`` is a folder of Parquet source relations (or ``--jdbc-url`` for a
database read in parallel id ranges); ``--target`` the folder of the target
tables, their staging area and watermarks. The session comes from
spark-submit; only SQL settings the plans rely on are applied to it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.sync import SyncOptions, backfill_job, epoch_sync_job, slot_sync_job
from .plans.validate import deep_compare_job
from .plans.windows import SlotWindowConfig
from .session import apply_defaults
from .sources.loader import load_source
from .sources.sinks import Warehouse


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="utxolake")
    p.add_argument("job", choices=["slot-sync", "epoch-sync", "backfill", "deep-compare", "freshness"])
    p.add_argument("--source", required=False)
    p.add_argument("--jdbc-url")
    p.add_argument("--target", required=True)
    p.add_argument("--tables", help="comma separated subset")
    p.add_argument("--epochs", help="comma separated epochs, or all (deep-compare; default: the last complete one)")
    p.add_argument("--stop-at-gap", action="store_true", help="backfill by epoch ends at the first epoch without rows")
    p.add_argument("--epochs-per-load", type=int, help="backfill: one table version per so many epochs (a rerun skips finished ones)")
    p.add_argument("--cap", type=int, default=10_000)
    p.add_argument("--grace", type=int, default=60)
    p.add_argument("--delete", type=int, default=200)
    p.add_argument("--rounds", type=int, default=3)
    p.add_argument("--cluster-size", type=int, default=1000)
    p.add_argument("--parallel-tables", type=int, default=4)
    p.add_argument("--max-list", type=int, help="split delegation / minting lists into rows of at most N")
    p.add_argument("--reload-open", default="", help="next-mode tables whose last epoch is reloaded (e.g. reward)")
    p.add_argument("--enforce", action="store_true", help="refuse loads with rows that the target schema forbids")
    p.add_argument("--buckets", type=int, help="two-level exact fingerprints (deep-compare)")
    p.add_argument("--fingerprint", choices=["multiset", "exact"], default="multiset")
    a = p.parse_args(argv)

    spark = apply_defaults(SparkSession.builder.getOrCreate())
    src = (load_source(spark, fmt="jdbc", jdbc_url=a.jdbc_url) if a.jdbc_url else load_source(spark, a.source))
    wh = Warehouse(spark, a.target)
    opts = SyncOptions(window=SlotWindowConfig(a.cap, a.grace, a.delete, a.rounds), cluster_size=a.cluster_size,
                       parallel_tables=a.parallel_tables, max_list=a.max_list, enforce=a.enforce,
                       reload_open=tuple(t for t in a.reload_open.split(",") if t))
    tables = a.tables.split(",") if a.tables else None
    if a.job == "slot-sync":
        report = slot_sync_job(src, wh, opts, tables)
    elif a.job == "epoch-sync":
        report = epoch_sync_job(src, wh, opts, tables)
    elif a.job == "backfill":
        report = backfill_job(src, wh, opts=opts, tables=tables, stop_at_gap=a.stop_at_gap, epochs_per_load=a.epochs_per_load)
    elif a.job == "freshness":
        from .plans.registry import ALL_TABLES
        from .plans.sync import freshness
        from .plans.windows import source_head
        present = [t for t in (tables or ALL_TABLES) if t not in ("meta", "schema_version") and wh.has(t)]
        report = freshness(wh, source_head(src["block"]), present)
    else:
        epochs = "all" if a.epochs == "all" else [int(e) for e in a.epochs.split(",")] if a.epochs else None
        kw = {t: {"cluster_size": a.cluster_size} for t in ("rel_addr_txout", "rel_stake_txout")}
        report = deep_compare_job(src, wh, tables, epochs, derive_kw=kw, buckets=a.buckets,
                                  mode="exact" if a.buckets else a.fingerprint)
    report.show(200, truncate=False)


if __name__ == "__main__":
    main()
