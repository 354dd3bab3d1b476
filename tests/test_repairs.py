"""Inputs next to the tested ones: retries, empty windows, gaps, odd cells."""

from pyspark.sql import functions as F

from utxolake import catalog_queries as cq
from utxolake.functions.encoding import canonical_json
from utxolake.operators.fingerprint import _fixed_point, row_diff
from utxolake.plans.sync import SyncOptions, backfill_full, derive, epoch_sync_job, load_window, slot_sync_job
from utxolake.plans.validate import deep_compare_job
from utxolake.sources.csv_stage import read_stage_csv, write_stage_csv


def test_empty_window_clears_its_range(spark, src):
    wh = cq.scratch(spark)
    cq._cut_target(src, wh, "withdrawal")
    none = {**{k: src[k] for k in ("tx", "block", "stake_address")}, "withdrawal": src["withdrawal"].where("false")}
    rows, new = load_window(none, wh, "withdrawal", cq.CUT_SLOT, 1000, 1800, cq.TEST)
    assert rows == 0 and new == 1800
    assert wh.read("withdrawal").where("slot_no >= 1000").count() == 0
    assert wh.read("withdrawal").count() == derive(src, "withdrawal").where("slot_no < 1000").count()


def test_tables_without_watermark_are_reported(spark, src):
    wh = cq.scratch(spark)
    wh.set_watermark("block", slot=10**9)
    report = {r["tablename"]: r["status"] for r in slot_sync_job(src, wh, cq.TEST, ["tx", "block"]).collect()}
    assert report == {"tx": "no_watermark", "block": "head_behind"}


def test_empty_closed_epochs_are_done(spark, src):
    wh = cq.scratch(spark)
    head = src["block"].agg(F.max("slot_no"), F.max("epoch_no")).first()
    backfill_full(src, wh, "pool_offline_data", cq.TEST)
    wh.set_watermark("pool_offline_data", slot=head[0], epoch=5)
    epoch_sync_job(src, wh, cq.TEST, ["pool_offline_data"])
    assert wh.watermark("pool_offline_data")[1] == head[1] - 1
    assert epoch_sync_job(src, wh, cq.TEST, ["pool_offline_data"]).count() == 0
    left, right = wh.read("pool_offline_data"), derive(src, "pool_offline_data")
    assert row_diff(left, right.select(*left.columns)).count() == 0


def test_transform_hook(spark, src):
    wh = cq.scratch(spark)
    backfill_full(src, wh, "tx_hash", SyncOptions(transforms={"tx_hash": lambda df: df.where("slot_no < 50")}))
    assert wh.read("tx_hash").agg(F.max("slot_no")).first()[0] < 50


def test_deep_compare_takes_the_last_complete_epoch(spark, src):
    wh = cq.scratch(spark)
    last = src["block"].agg(F.max("epoch_no")).first()[0] - 1
    wh.overwrite("block_hash", derive(src, "block_hash").where(F.col("epoch_no") <= last), "epoch_no")
    assert [tuple(r)[:2] + (r["status"],) for r in deep_compare_job(src, wh, ["block_hash"]).collect()] == [("block_hash", last, "equal")]
    altered = derive(src, "block_hash").withColumn("block_hash", F.when(F.col("epoch_no") == last, F.reverse("block_hash")).otherwise(F.col("block_hash")))
    wh.overwrite("block_hash", altered, "epoch_no")
    assert [tuple(r)[:2] + (r["status"],) for r in deep_compare_job(src, wh, ["block_hash"]).collect()] == [("block_hash", last, "differ")]
    log = wh.read("log_deep_comparison").collect()
    assert len(log) == 2 and all(r["start_time"] <= r["end_time"] and f"({last})" in r["bq_query"] for r in log)


def test_odd_cells_stay_apart(spark, tmp_path):
    doubles = spark.createDataFrame([(x,) for x in (1.1e-10, 2.2e-10, 0.05, 3.0, 1e30, 0.0)], "x double")
    assert [r[0] for r in doubles.select(_fixed_point(F.col("x"))).collect()] == ["1.1E-10", "2.2E-10", "0.05", "3", "1.0E30", "0"]
    docs = spark.createDataFrame([(f'{{"a":{10**45 + k}}}',) for k in (7, 8)] + [('{"b":1, "a":2}',)], "j string")
    assert [r[0] for r in docs.select(canonical_json("j")).collect()] == [f'{{"a":{10**45 + 7}}}', f'{{"a":{10**45 + 8}}}', '{"a":2,"b":1}']
    cells = ["\\N", " x ", "", None, 'say "no"', "a\nb", "\\", "N"]
    table = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    write_stage_csv(table, str(tmp_path / "csv"))
    assert [r["c"] for r in read_stage_csv(spark, str(tmp_path / "csv"), "i int, c string").orderBy("i").collect()] == cells


def test_row_diff_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (3,), (3,)], "a int")
    got = sorted((r["side"], r["a"] is None, r["a"]) for r in row_diff(left, right).collect())
    assert got == [("left_only", False, 1), ("left_only", False, 1), ("left_only", True, None), ("right_only", False, 3), ("right_only", False, 3)]
