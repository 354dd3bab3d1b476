"""Bench: the headline workloads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The stand-in source (33 relations computed from the sf tables) is first written
once as Parquet, as a source export would be (``source_export``, timed and
counted in the total). Then, over that source, every query runs in full with
the ``noop`` sink (nothing is collected to the driver):

* ``d_*``    the 30 table derivations,
* ``v_fp_*`` their per-epoch fingerprints, exact mode (the reference digest),
* ``fingerprint_multiset_30_tables`` the same in multiset mode (the deep-compare default),
* ``backfill_30_tables``  B-03: all 30 target tables written (staging, partitions),
* ``slot_sync_23_tables`` W-08: the 23 slot tables cut at slot 1500 (10 stale slots),
  then synced to the head in 600-slot windows.

Prints one JSON line: total seconds and per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from utxolake.session import ensure_checkpoint_dir, local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_ONLY")  # comma separated subset of query names, for local iteration
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="utxolake-bench")
    from utxolake import catalog_queries as cq
    from utxolake.operators.derive import DERIVE
    from utxolake.operators.fingerprint import SPECS, fingerprint_table
    from utxolake.plans.registry import SLOT_ORDER
    from utxolake.plans.sync import backfill_job, slot_sync_job
    from utxolake.sources.loader import SOURCE_RELATIONS, MaterializedCatalog
    from utxolake.sources.sinks import Warehouse
    from utxolake.sources.standin import StandIn

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:10]}"
    times: dict[str, float] = {}

    def timed(name, fn):
        if only and name not in only.split(","):
            return
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    src = MaterializedCatalog(StandIn(spark, sf_dir), f"{root}/source")
    t0 = time.perf_counter()
    for n in SOURCE_RELATIONS:
        src[n]
    times["source_export"] = round(time.perf_counter() - t0, 3)

    def derive(n):
        return DERIVE[n](src, cluster_size=cq.CLUSTER) if n in ("rel_addr_txout", "rel_stake_txout") \
            else DERIVE[n](src)

    for n in DERIVE:
        timed(f"d_{n}", lambda n=n: noop(derive(n)))
    for n in SPECS:
        timed(f"v_fp_{n}", lambda n=n: noop(fingerprint_table(n, derive(n), blocks=src["block"])))

    def multiset_all():
        for n in SPECS:
            noop(fingerprint_table(n, derive(n), blocks=src["block"], mode="multiset"))

    timed("fingerprint_multiset_30_tables", multiset_all)

    def backfill():
        backfill_job(src, Warehouse(spark, f"{root}/backfill", chunk_rows=50_000), opts=cq.TEST)

    def slot_sync():
        wh = Warehouse(spark, f"{root}/sync", chunk_rows=50_000)
        with ThreadPoolExecutor(max_workers=cq.TEST.parallel_tables) as pool:
            list(pool.map(lambda t: cq._cut_target(src, wh, t), SLOT_ORDER))
        slot_sync_job(src, wh, cq.TEST)

    timed("backfill_30_tables", backfill)
    timed("slot_sync_23_tables", slot_sync)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "total_sec_export_derive_fingerprint_backfill_sync",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "groups": {
            "source_export": times.get("source_export"),
            "derive": round(sum(v for k, v in times.items() if k.startswith("d_")), 3),
            "fingerprint": round(sum(v for k, v in times.items() if k.startswith("v_fp_")), 3),
            "fingerprint_multiset": times.get("fingerprint_multiset_30_tables"),
            "backfill_30_tables": times.get("backfill_30_tables"),
            "slot_sync_23_tables": times.get("slot_sync_23_tables"),
        },
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
