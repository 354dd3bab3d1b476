"""The zone map of source ids: contents, refreshes, and windows planned without a Spark job."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from utxolake import catalog_queries as cq
from utxolake.operators.common import ZonedCatalog
from utxolake.plans.registry import SLOT_ORDER, TABLES
from utxolake.plans.sync import extract_append, extract_replace, slot_sync_job
from utxolake.plans.windows import SlotWindowConfig, source_head
from utxolake.plans.zones import ZONES, read_zones, refresh_zones, zone_rows, zones_for

SIZE = 100
CFG = SlotWindowConfig(cap=600, grace=3, delete=10, rounds=3)


@pytest.fixture(scope="module")
def source(spark):
    wh = cq.scratch(spark)
    return cq._mat(spark, "/root/testdata/sf0.001", wh)


@pytest.fixture(scope="module")
def head(source):
    return source_head(source["block"]).first()["head_slot_no"]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("slot_no", "relation", "first_id", "last_id").collect())


def test_refreshes_in_steps_equal_one_pass(spark, source, head):
    wh = cq.scratch(spark)
    refresh_zones(source, wh, 250, 700, 720, CFG, SIZE)
    state = refresh_zones(source, wh, 300, 1500, 1500, CFG, SIZE)
    assert state.extra["zones"]["from"] == 200 and state.slot == 1400
    refresh_zones(source, wh, 1400, head, head, CFG, SIZE)
    assert rows_of(wh.read(ZONES)) == rows_of(zone_rows(source, 200, head, SIZE))
    before = wh.state(ZONES).version
    assert refresh_zones(source, wh, 300, 900, head, CFG, SIZE).version in (before, before + 1)
    refresh_zones(source, wh, 0, 900, head, CFG, SIZE)  # begins earlier: built anew, up to where it was
    assert rows_of(wh.read(ZONES)) == rows_of(zone_rows(source, 0, head, SIZE))


def test_a_fork_above_the_settled_slot_is_seen(spark, source):
    wh = cq.scratch(spark)
    refresh_zones(source, wh, 0, 1200, 1200, CFG, SIZE)
    moved = dict(source)
    moved["block"] = source["block"].where((F.col("slot_no") < 1190) | (F.col("slot_no") > 1195))
    state = refresh_zones(moved, wh, 0, 1300, 1300, CFG, SIZE)
    assert rows_of(wh.read(ZONES)) == rows_of(zone_rows(moved, 0, state.extra["zones"]["to"], SIZE))


def test_empty_source_and_empty_zones(spark, source, head):
    wh = cq.scratch(spark)
    state = refresh_zones(source, wh, head + 1000, head + 1200, head, CFG, SIZE)
    assert wh.read(ZONES).count() == 0
    known = read_zones(wh, state, [(head + 1000, head + 1200)])
    assert known.ranges == {(head + 1000, head + 1200): {}}
    zoned = known.window(source, head + 1000, head + 1200)
    assert zoned.within(source["tx"], "id", "tx").count() == source["tx"].count()  # nothing settled there: no bound


def test_bounds_are_closed_below_and_open_above(spark, source):
    tx = source["tx"]
    lo, hi = tx.agg(F.min("id"), F.max("id")).first()
    mid = (lo + hi) // 2
    closed, open_ = (ZonedCatalog(source, {"tx": (lo, mid)}, o) for o in (False, True))
    assert closed.within(tx, "id", "tx").count() == tx.where(F.col("id") <= mid).count()
    assert open_.within(tx, "id", "tx").count() == tx.count()
    assert closed.within(source["pool_update"], "id", "pool_update").count() == 0  # no row of it in a settled window


@pytest.mark.parametrize("table", SLOT_ORDER)
def test_window_by_zones(spark, source, head, table):
    """The same rows as without a map, a plan that is built without a Spark job, and id ranges in its scans."""
    clean, mx = 1301, 1901
    wh = _shared_map(spark, source, head, clean, mx)
    extract = extract_append if TABLES[table].slot_mode == "append" else extract_replace
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "planning")
    try:
        zoned = extract(wh.window(source, clean, mx), table, clean, mx, cq.TEST)
        plan = zoned._jdf.queryExecution().optimizedPlan().toString()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plain = extract(source, table, clean, mx, cq.TEST)
    assert sorted(map(str, zoned.collect())) == sorted(map(str, plain.collect()))
    if table != "block_hash":  # reads blocks alone, by slot
        assert re.search(r"\((?:block_id|tx_id|tx_in_id|registered_tx_id|announced_tx_id)#\d+L? [<>]= -?\d+\)", plan)


_MAPS = {}


def _shared_map(spark, source, head, lo, hi):
    if "map" not in _MAPS:
        _MAPS["map"] = zones_for(source, cq.scratch(spark), [(lo, hi)], head, CFG, SIZE)
    return _MAPS["map"]


def test_slot_sync_keeps_the_map(spark, source, head):
    wh = cq.scratch(spark)
    for t in ("tx", "pool_owner", "pool_update"):
        cq._cut_target(source, wh, t)
    slot_sync_job(source, wh, cq.TEST, ["tx", "pool_owner", "pool_update"])
    state = wh.state(ZONES)
    assert state.extra["zones"]["to"] >= head - CFG.grace and state.slot <= head
    assert ZONES not in wh.tables()
