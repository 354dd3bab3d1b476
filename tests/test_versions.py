"""Table versions: crashes, races, narrow writes, retention, resumed backfills."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from utxolake import catalog_queries as cq
from utxolake.plans.registry import SLOT_ORDER, TABLES
from utxolake.plans.sync import SyncOptions, backfill_job, derive, freshness, load_window, slot_sync_job
from utxolake.plans.windows import SlotWindowConfig, source_head
from utxolake.sources.sinks import CommitConflict, Warehouse


class Crash(Exception):
    pass


def rows_of(df):
    return sorted(map(str, df.collect()))


def files(wh, table):
    return {f for f in glob.glob(f"{wh.path(table).removeprefix('file:')}/_v=*/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("table", ["tx_hash", "pool_update"])
@pytest.mark.parametrize("step", ["written", "publish", "published"])
def test_crash_leaves_old_or_new_version(spark, src, table, step):
    wh = cq.scratch(spark)
    cq._cut_target(src, wh, table)
    old, mark = rows_of(wh.read(table)), wh.watermark(table)

    def crash(at):
        if at == step:
            raise Crash

    wh.on_step = crash
    with pytest.raises(Crash):
        load_window(src, wh, table, cq.CUT_SLOT, cq.CUT_SLOT - 10, 1800, cq.TEST)
    wh.on_step = lambda at: None
    if step == "published":
        assert wh.watermark(table)[0] == 1800 and rows_of(wh.read(table)) != old
    else:
        assert wh.watermark(table) == mark and rows_of(wh.read(table)) == old
        assert len(wh.remove_strays(table)) == 1 and rows_of(wh.read(table)) == old
        load_window(src, wh, table, cq.CUT_SLOT, cq.CUT_SLOT - 10, 1800, cq.TEST)
    parts = [derive(src, table, (F.col("slot_no") > lo) & (F.col("slot_no") <= hi), cq.TEST) for lo, hi in ((-1, cq.CUT_SLOT), (cq.CUT_SLOT, 1800))]
    want = parts[0].unionByName(parts[1])
    assert rows_of(wh.read(table)) == rows_of(want.select(*wh.read(table).columns))


def test_readers_keep_their_version(spark, src):
    wh = cq.scratch(spark)
    cq._cut_target(src, wh, "tx_hash")
    reader = wh.read("tx_hash")
    n = reader.count()
    wh.overwrite("tx_hash", wh.read("tx_hash").limit(3), "epoch_no")
    assert reader.count() == n and wh.read("tx_hash").count() == 3


def test_old_versions_go(spark):
    wh = cq.scratch(spark)
    for k in range(14):
        wh.overwrite("t", spark.range(k + 1).withColumn("epoch_no", F.col("id") % 3), "epoch_no", slot=k)
    assert len(wh._versions("t")) == wh.VERSIONS_KEPT and wh.watermark("t") == (13, None)
    assert wh.read("t").count() == 14 and len(glob.glob(f"{wh.path('t').removeprefix('file:')}/_v=*")) == wh.VERSIONS_KEPT
    for k in range(14):
        wh.set_watermark("t", epoch=k)
    assert wh.read("t").count() == 14 and wh.watermark("t") == (13, 13)
    assert len(glob.glob(f"{wh.path('t').removeprefix('file:')}/_v=*")) == 1
    assert wh.remove_strays("t") == []


def test_racing_watermarks_are_all_kept(spark):
    """Eight writers on one row: each adds to the counter it read, through compare and set."""
    wh = cq.scratch(spark)
    others = [Warehouse(spark, wh.root) for _ in range(8)]

    def bump(w):
        from dataclasses import replace
        for _ in range(3):
            w.annotate("counter", lambda s: replace(s, slot=(s.slot or 0) + 1))

    for w in others:
        w.RETRIES = 200
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(bump, others))
    assert wh.watermark("counter") == (24, None)


def test_racing_loads_one_wins(spark, src):
    wh = cq.scratch(spark)
    cq._cut_target(src, wh, "tx_hash")
    other = Warehouse(spark, wh.root)

    def overtake(step):
        if step == "publish":
            wh.on_step = lambda at: None
            load_window(src, other, "tx_hash", cq.CUT_SLOT, cq.CUT_SLOT - 10, 1700, cq.TEST)

    wh.on_step = overtake
    before = files(wh, "tx_hash")
    with pytest.raises(CommitConflict):
        load_window(src, wh, "tx_hash", cq.CUT_SLOT, cq.CUT_SLOT - 10, 1800, cq.TEST)
    assert wh.watermark("tx_hash")[0] == 1700 and len({f.split("_v=")[1][:32] for f in files(wh, "tx_hash") - before}) == 1
    assert wh.read("tx_hash").count() == derive(src, "tx_hash").where("slot_no <= 1700").count()


def test_two_jobs_on_one_target(spark, src):
    wh = cq.scratch(spark)
    tables = ["tx_hash", "pool_update", "withdrawal"]
    for t in tables:
        cq._cut_target(src, wh, t)
    jobs = [Warehouse(spark, wh.root), Warehouse(spark, wh.root)]
    with ThreadPoolExecutor(2) as pool:
        reports = list(pool.map(lambda w: [r["status"] for r in slot_sync_job(src, w, cq.TEST, tables).collect()], jobs))
    assert any("loaded" in r for r in reports)
    slot_sync_job(src, wh, cq.TEST, tables)  # what a lost race left to do
    head = source_head(src["block"]).first()["head_slot_no"]
    for t in tables:
        assert wh.watermark(t)[0] == head - cq.TEST.window.grace
        got = wh.read(t)
        if TABLES[t].slot_mode == "replace":
            assert rows_of(got) == rows_of(derive(src, t).where(F.col("slot_no") <= head - cq.TEST.window.grace).select(*got.columns))
        else:  # one row per transaction here, whatever the windows were
            assert got.count() == derive(src, t, F.col("slot_no") <= head - cq.TEST.window.grace).count()


def test_writes_follow_the_window(spark, src):
    """A window in a long epoch writes the buckets from its start on; the others keep their files."""
    one_epoch = {k: src[k] for k in ("tx", "stake_address", "pool_hash", "pool_update", "pool_metadata_ref", "withdrawal")}
    one_epoch["block"] = src["block"].withColumn("epoch_no", F.lit(7).cast("bigint"))
    for table in ("tx_hash", "withdrawal"):
        wh = Warehouse(spark, cq.scratch(spark).root, bucket_slots=100)
        wh.overwrite(table, derive(one_epoch, table).where(F.col("slot_no") <= 1500), "epoch_no", slot=1500)
        before, rows = files(wh, table), wh.read(table).count()
        load_window(one_epoch, wh, table, 1500, 1490, 1700, cq.TEST)
        state = wh.state(table)
        [new] = {leaf.load for leaf in state.leaves} - {f.split("_v=")[1][:32] for f in before}
        assert {14, 15, 16} <= {leaf.bucket for leaf in state.leaves if leaf.load == new} <= {14, 15, 16, 17}
        kept = {leaf.bucket for leaf in state.leaves if leaf.load != new}
        assert kept and max(kept) == 13 and before <= files(wh, table)
        assert wh.read(table).count() == derive(one_epoch, table).where(F.col("slot_no") <= 1700).count() > rows
        assert rows_of(wh.read(table)) == rows_of(derive(one_epoch, table).where(F.col("slot_no") <= 1700).select(*wh.read(table).columns))
    wh = cq.scratch(spark)
    cq._cut_target(src, wh, "pool_update")
    before = files(wh, "pool_update")
    load_window(src, wh, "pool_update", cq.CUT_SLOT, cq.CUT_SLOT, 1700, cq.TEST)
    assert before <= files(wh, "pool_update")
    assert {leaf.bucket for leaf in wh.state("pool_update").leaves} == {cq.CUT_SLOT, 1700}


@pytest.mark.parametrize("per_load", [None, 30])
def test_backfill_resumes(spark, src, per_load):
    """A backfill dies after some commits; the same call finishes it, over the head it began with."""
    wh = cq.scratch(spark)
    opts = SyncOptions(window=cq.TEST.window, cluster_size=5, parallel_tables=1)
    tables, commits = ["block_hash", "tx_hash", "pool_update", "epoch_stake", "meta"], []
    early = {**{k: src[k] for k in ("tx", "block", "stake_address", "pool_hash", "pool_update", "pool_metadata_ref", "epoch_stake", "meta")}}
    early["block"] = src["block"].where("slot_no <= 2000")

    def crash(step):
        commits.append(step)
        if len(commits) == (10 if per_load is None else 14):
            raise Crash

    wh.on_step = crash
    with pytest.raises(Crash):
        backfill_job(early, wh, opts=opts, tables=tables, epochs_per_load=per_load)
    wh.on_step = lambda at: None
    written = {t: files(wh, t) for t in tables}
    assert written["block_hash"] and not wh.has("meta")
    report = {r["tablename"]: r["rows"] for r in backfill_job(src, wh, opts=opts, tables=tables, epochs_per_load=per_load).collect()}
    assert files(wh, "block_hash") >= written["block_hash"] if per_load else files(wh, "block_hash") == written["block_hash"]
    epoch = early["block"].agg(F.max("epoch_no")).first()[0]
    for t in tables:
        whole = derive(src if t in ("meta", "epoch_stake") else early, t, opts=opts)
        want = whole.where(F.col("epoch_no") <= epoch) if t == "epoch_stake" else whole
        assert rows_of(wh.read(t)) == rows_of(want.select(*wh.read(t).columns)), t
        assert report[t] == want.count()
        if t != "meta":
            assert wh.watermark(t)[1] == epoch
    again = wh.state("tx_hash").version
    backfill_job(src, wh, opts=opts, tables=tables, epochs_per_load=per_load)  # finished: a new run, over the new head
    assert wh.state("tx_hash").version > again and wh.read("block_hash").count() == src["block"].count()


def test_freshness_reads_folders_and_one_bucket(spark, src):
    wh = Warehouse(spark, cq.scratch(spark).root, bucket_slots=100)
    tables = ["tx_hash", "tx_consumed_output", "delegation", "epoch_stake", "pool_update"]
    backfill_job(src, wh, opts=cq.TEST, tables=tables)
    head = source_head(src["block"])
    got = freshness(wh, head, tables)
    want = freshness(lambda t: derive(src, t, opts=cq.TEST), head, tables)
    assert rows_of(got) == rows_of(want)
    state = wh.state("tx_hash")
    top = wh.read_leaves("tx_hash", state, [x for x in state.leaves if x.bucket == max(y.bucket for y in state.leaves)])
    assert len(top.inputFiles()) < len(wh.read("tx_hash").inputFiles()) / 5


def test_windows_of_all_tables_need_no_epoch_lookup(spark, src):
    """Every slot table after several narrow windows equals its derivation."""
    opts = SyncOptions(window=SlotWindowConfig(cap=400, grace=3, delete=10, rounds=9), cluster_size=5)
    wh = Warehouse(spark, cq.scratch(spark).root, bucket_slots=128)
    tables = [t for t in SLOT_ORDER if TABLES[t].slot_mode == "replace"]
    for t in tables:
        wh.overwrite(t, derive(src, t, opts=opts).where(F.col(TABLES[t].slot_col) <= 1700), TABLES[t].part_col, slot=1700)
    slot_sync_job(src, wh, opts, tables)
    for t in tables:
        got = wh.read(t, hidden=True).drop("_bucket")
        want = derive(src, t, opts=opts).where(F.col(TABLES[t].slot_col) <= wh.watermark(t)[0])
        assert rows_of(got) == rows_of(want.select(*got.columns)), t
