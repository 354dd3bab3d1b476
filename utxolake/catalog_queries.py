"""Registered non-derivation queries (validation, sources, planning, merges, jobs).

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with, where
SQL can say it, the DuckDB text of the same result over the same tables. All of
them run over the stand-ins that Spark derives from the whole ``sf`` tables;
jobs write their targets below the session's checkpoint folder (shared storage
on a cluster) and return what landed there.

Test sizes (FIXTURES.md): cluster 5, list split 3, window cap 600, grace 3,
delete 10, file chunk 500; the target of the merge tests is cut at slot 1500
(epoch 50) or epoch 40.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.lists import split_long_list
from .operators.derive import DERIVE
from .operators.fingerprint import SPECS, fingerprint_compare, fingerprint_table, row_diff, row_hashes, row_text
from .oracle import DOUBLE_COLUMNS, derived_sql, fingerprint_sql
from .plans.registry import (BACKFILL_FULL, BACKFILL_START, EPOCH_CLOSED, EPOCH_ORDER, SLOT_APPEND, SLOT_EMPTY,
                             SLOT_ORDER, TABLES)
from .plans.sync import (EmptyBatchError, SyncOptions, backfill_by_epoch, backfill_full, backfill_job, derive,
                         epoch_sync_job, epochs_done, extract_append, extract_epoch, extract_replace, freshness,
                         load_window, merge_append, merge_epoch, next_watermark, slot_sync_job, sync_table_slots)
from .plans.windows import SlotWindowConfig, plan_epochs, plan_slot_windows, source_head
from .plans.zones import HANG_ON_TX, ZONES, refresh_zones
from .session import ensure_checkpoint_dir, shared_broadcasts, shuffles_dropped
from .sources.csv_stage import read_stage_csv, write_stage_csv
from .sources.loader import MaterializedCatalog, export_source, load_source
from .sources.schemas import enforce_schema
from .sources.sinks import LAST_INDEX_SCHEMA, Warehouse, watermark_upsert
from .sources.standin import StandIn, duck_with

CLUSTER = 5
TEST = SyncOptions(window=SlotWindowConfig(cap=600, grace=3, delete=10, rounds=3), cluster_size=CLUSTER, zone_slots=100)
CUT_SLOT, CUT_EPOCH, RELOAD_EPOCH = 1500, 40, 50
ZONE_SLOTS = 100
CHUNK = 500

Query = Callable[[SparkSession, str], DataFrame]


# --- helpers ------------------------------------------------------------------

def derive_for_test(src, name: str, **kw) -> DataFrame:
    if name in ("rel_addr_txout", "rel_stake_txout"):
        kw.setdefault("cluster_size", CLUSTER)
    return DERIVE[name](src, **kw)


def scratch(spark: SparkSession) -> Warehouse:
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/utxolake-q-{uuid.uuid4().hex[:12]}"
    return Warehouse(spark, root, chunk_rows=CHUNK)


def fixture_last_index() -> list[tuple[str, int, int]]:
    """One row per target table: ``last_slot_no = 500 + 37 i``, ``last_epoch_no = 16 + i``."""
    names = SLOT_ORDER + [t for t in EPOCH_ORDER if t not in SLOT_ORDER]
    return [(t, 500 + 37 * i, 16 + i) for i, t in enumerate(names)]


def _li(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixture_last_index(), LAST_INDEX_SCHEMA)


def _duck_li() -> str:
    rows = ", ".join(f"('{t}', CAST({s} AS BIGINT), CAST({e} AS BIGINT))" for t, s, e in fixture_last_index())
    return f"(SELECT * FROM (VALUES {rows}) v(tablename, last_slot_no, last_epoch_no))"


DUCK_HEAD = "(SELECT max(slot_no) AS head_slot_no, max(epoch_no) AS head_epoch_no FROM block)"


def _body(name: str) -> tuple[tuple[str, ...], str]:
    return derived_sql(CLUSTER)[name]


def _windowed(name: str, cond: str) -> str:
    """View body with its transaction blocks restricted to ``cond`` (before aggregation)."""
    body = _body(name)[1]
    key = "JOIN block b ON b.id = t.block_id"
    assert key in body, name
    return body.replace(key, f"JOIN (SELECT * FROM block WHERE {cond}) b ON b.id = t.block_id")


def _with(names, extra: tuple[str, ...] = ()) -> str:
    deps: list[str] = []
    for n in names:
        deps += _body(n)[0]
    return duck_with(list(dict.fromkeys(deps + list(extra))))


def _q(spark: SparkSession, sf_dir: str) -> StandIn:
    return StandIn(spark, sf_dir)


def _mat(spark: SparkSession, sf_dir: str, wh: Warehouse, columns: Mapping[str, list[str]] | None = None) -> MaterializedCatalog:
    """The stand-in source written once to the job's shared folder (what a source export is)."""
    return MaterializedCatalog(StandIn(spark, sf_dir), f"{wh.root}/source", columns)


def _quote(names) -> str:
    return ", ".join(f"'{n}'" for n in sorted(names))


# --- V: validation --------------------------------------------------------------

def _fp(name: str) -> Query:
    def run(spark, sf_dir):
        src = _q(spark, sf_dir)
        return fingerprint_table(name, derive_for_test(src, name), blocks=src["block"])
    return run


MULTISET_TABLES = list(SPECS)


def _fpm(name: str) -> Query:
    def run(spark, sf_dir):
        src = _q(spark, sf_dir)
        return fingerprint_table(name, derive_for_test(src, name), blocks=src["block"], mode="multiset")
    return run


def _altered_tx(src) -> DataFrame:
    """A copy of tx in which the rows of failed scripts carry a wrong fee."""
    t = derive_for_test(src, "tx")
    return t.withColumn("fee", F.when(~F.col("valid_script"), F.col("fee") + 1).otherwise(F.col("fee")))


ALTERED_TX_SQL = ("SELECT * REPLACE (CASE WHEN NOT valid_script THEN fee + 1 ELSE fee END AS fee) FROM ("
                  + _body("tx")[1] + ") a")


def q_row_text(spark, sf_dir):
    t = derive_for_test(_q(spark, sf_dir), "tx")
    return t.select("epoch_no", "slot_no", "txidx", row_text(t, SPECS["tx"]).alias("row_text"))


def q_row_hash(spark, sf_dir):
    t = derive_for_test(_q(spark, sf_dir), "tx")
    return row_hashes(t, SPECS["tx"]).select("epoch_no", "slot_no", "txidx", "row_hash")


def q_single_row(spark, sf_dir):
    p = derive_for_test(_q(spark, sf_dir), "param_proposal")
    return row_hashes(p, SPECS["param_proposal"]).select(
        "epoch_no", "registered_tx_slot_no", "registered_tx_index", "key", "row_hash")


def q_normalize(spark, sf_dir):
    from .operators.fingerprint import cell_text
    e = derive_for_test(_q(spark, sf_dir), "epoch_param")
    return e.select("epoch_no", cell_text(e, "decentralisation", SPECS["epoch_param"]).alias("decentralisation"))


def q_canonical_json(spark, sf_dir):
    from .functions.encoding import canonical_json
    d = derive_for_test(_q(spark, sf_dir), "datum")
    return d.select("datum_hash", canonical_json("value").alias("value"))


def q_compare(spark, sf_dir):
    src = _q(spark, sf_dir)
    left = fingerprint_table("tx", derive_for_test(src, "tx"))
    right = fingerprint_table("tx", _altered_tx(src))
    return fingerprint_compare(left, right, ["epoch_no"])


def q_row_diff(spark, sf_dir):
    src = _q(spark, sf_dir)
    return row_diff(derive_for_test(src, "tx"), _altered_tx(src))


def q_audit(spark, sf_dir):
    """V-10: audit rows (clock columns left out) of the tx comparison, appended to a log table."""
    from .plans.validate import audit_rows
    wh = scratch(spark)
    cmp = q_compare(spark, sf_dir).withColumn("tablename", F.lit("tx"))
    wh.append("log_deep_comparison", audit_rows(cmp, "derive(tx)", "altered copy of tx"), None)
    return wh.read("log_deep_comparison").drop("start_time", "end_time")


def q_freshness(spark, sf_dir):
    src = _q(spark, sf_dir)
    tables = [t for t in DERIVE if t not in ("meta", "schema_version")]
    return freshness(lambda t: derive_for_test(src, t), source_head(src["block"]), tables)


def q_deep_compare(spark, sf_dir):
    """V-12: every table copied in full, then both sides fingerprinted and compared."""
    from .plans.validate import deep_compare_job
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    for t in SPECS:
        backfill_full(src, wh, t, TEST)
    kw = {t: {"cluster_size": CLUSTER} for t in ("rel_addr_txout", "rel_stake_txout")}
    cmp = deep_compare_job(src, wh, list(SPECS), epochs="all", derive_kw=kw)
    return cmp.groupBy("tablename").agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("equal", "differ", "left_only", "right_only")])


# A target of tx that went wrong in five ways, each in epochs of its own.
WRONG_FEE, LOST_ROWS, DOUBLED_ROWS, LOST_EPOCH, STRAY_EPOCH = 40, 50, 60, 70, 999


def _wrong_target(spark, sf_dir) -> tuple[MaterializedCatalog, Warehouse]:
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    e, tx = F.col("epoch_no"), derive(src, "tx")
    bad = tx.where((e != LOST_EPOCH) & ((e != LOST_ROWS) | (F.col("slot_no") % 3 != 0)))
    bad = bad.withColumn("fee", F.when((e == WRONG_FEE) & (F.col("txidx") == 0), F.col("fee") + 1).otherwise(F.col("fee")))
    # tx is derived once: a row comes with its copies
    stray = F.array(e, F.lit(STRAY_EPOCH).cast("bigint"))
    copies = bad.withColumn("_epoch", F.explode(F.when(e == DOUBLED_ROWS, F.array(e, e)).when(e == 1, stray).otherwise(F.array(e))))
    wh.overwrite("tx", copies.withColumn("epoch_no", F.col("_epoch")).select(*tx.columns), "epoch_no")
    return src, wh


WRONG_TX_SQL = (
    f"SELECT * REPLACE (CASE WHEN epoch_no = {WRONG_FEE} AND txidx = 0 THEN fee + 1 ELSE fee END AS fee) FROM ({_body('tx')[1]}) a "
    f"WHERE epoch_no <> {LOST_EPOCH} AND (epoch_no <> {LOST_ROWS} OR slot_no % 3 <> 0) "
    f"UNION ALL SELECT * FROM ({_body('tx')[1]}) b WHERE epoch_no = {DOUBLED_ROWS} "
    f"UNION ALL SELECT * REPLACE (CAST({STRAY_EPOCH} AS BIGINT) AS epoch_no) FROM ({_body('tx')[1]}) c WHERE epoch_no = 1")
DIGEST_BUCKETS = 64


def q_drill_down(spark, sf_dir):
    """V-08 to V-09: the rows in which a target of tx with altered, lost, doubled and stray rows differs from its source."""
    from .plans.validate import drill_down_job
    return drill_down_job(*_wrong_target(spark, sf_dir), "tx", buckets=DIGEST_BUCKETS)


def _duck_drill_down() -> str:
    from .oracle import row_text_sql
    bucket = f"CAST('0x' || substr(sha256({row_text_sql('tx')}), 1, 4) AS BIGINT) % {DIGEST_BUCKETS} AS bucket"
    tx, bad = f"(SELECT * FROM ({_body('tx')[1]}) t)", f"(SELECT * FROM ({WRONG_TX_SQL}) w)"
    return _with(["tx"]) + (f"SELECT *, {bucket}, 'left_only' AS side FROM ({tx} EXCEPT ALL {bad}) l "
                            f"UNION ALL SELECT *, {bucket}, 'right_only' AS side FROM ({bad} EXCEPT ALL {tx}) r")


def q_deep_compare_differs(spark, sf_dir):
    """V-12: every epoch of the wrong target of tx."""
    from .plans.validate import deep_compare_job
    cmp = deep_compare_job(*_wrong_target(spark, sf_dir), ["tx"], epochs="all")
    return cmp.select("epoch_no", "left_rows", "right_rows", "status")


def _duck_deep_compare_differs() -> str:
    tx, bad = f"(SELECT * FROM ({_body('tx')[1]}) t)", f"(SELECT * FROM ({WRONG_TX_SQL}) w)"
    differ = f"SELECT epoch_no FROM ({tx} EXCEPT ALL {bad}) x UNION SELECT epoch_no FROM ({bad} EXCEPT ALL {tx}) y"
    return _with(["tx"]) + (
        f"SELECT coalesce(l.epoch_no, r.epoch_no) AS epoch_no, l.n AS left_rows, r.n AS right_rows, CASE WHEN l.n IS NULL THEN 'right_only' "
        f"WHEN r.n IS NULL THEN 'left_only' WHEN coalesce(l.epoch_no, r.epoch_no) IN ({differ}) THEN 'differ' ELSE 'equal' END AS status "
        f"FROM (SELECT epoch_no, count(*) AS n FROM {tx} a GROUP BY 1) l FULL JOIN (SELECT epoch_no, count(*) AS n FROM {bad} b GROUP BY 1) r "
        "ON l.epoch_no = r.epoch_no")


def _duck_fp_groups(t: str) -> str:
    return f"SELECT '{t}' AS tablename, count(*) AS n_equal FROM ({fingerprint_sql(t, CLUSTER)}) f"


def validation() -> tuple[dict[str, Query], dict[str, str]]:
    q: dict[str, Query] = {f"v_fp_{n}": _fp(n) for n in SPECS}
    o: dict[str, str] = {f"v_fp_{n}": fingerprint_sql(n, CLUSTER) for n in SPECS}
    q.update({f"v_fp_multiset_{n}": _fpm(n) for n in MULTISET_TABLES})
    o.update({f"v_fp_multiset_{n}": fingerprint_sql(n, CLUSTER, mode="multiset") for n in MULTISET_TABLES})
    tx_deps, tx_body = _body("tx")
    parts = " || ',' || ".join(
        f"coalesce(CAST(\"{c}\" AS VARCHAR), 'null')" for c in SPECS["tx"].columns)
    text = f"'(' || {parts} || ')'"
    q["v_row_text"] = q_row_text
    o["v_row_text"] = _with(["tx"]) + f"SELECT epoch_no, slot_no, txidx, {text} AS row_text FROM ({tx_body}) v"
    q["v_row_hash"] = q_row_hash
    o["v_row_hash"] = (_with(["tx"]) + f"SELECT epoch_no, slot_no, txidx, to_base64(unhex(sha256({text}))) "
                       f"AS row_hash FROM ({tx_body}) v")
    pp = SPECS["param_proposal"]
    pparts = " || ',' || ".join(
        (f"coalesce(regexp_replace(regexp_replace(CAST(CAST(CAST(\"{c}\" AS VARCHAR) AS DECIMAL(38,20)) AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''), "
         f"'null')" if c in DOUBLE_COLUMNS else f"coalesce(CAST(\"{c}\" AS VARCHAR), 'null')") for c in pp.columns)
    q["v_single_row"] = q_single_row
    o["v_single_row"] = (_with(["param_proposal"]) +
                         "SELECT epoch_no, registered_tx_slot_no, registered_tx_index, \"key\", "
                         f"to_base64(unhex(sha256('(' || {pparts} || ')'))) AS row_hash "
                         f"FROM ({_body('param_proposal')[1]}) v")
    q["v_normalize"] = q_normalize
    o["v_normalize"] = (_with(["epoch_param"]) + "SELECT epoch_no, regexp_replace(regexp_replace("
                        "CAST(CAST(CAST(decentralisation AS VARCHAR) AS DECIMAL(38,20)) AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') AS decentralisation "
                        f"FROM ({_body('epoch_param')[1]}) v")
    q["v_canonical_json"] = q_canonical_json
    o["v_canonical_json"] = (_with(["datum"]) + "SELECT datum_hash, CAST(json_object('a', json_extract(value, '$.a'),"
                             " 'int', json_extract(value, '$.int')) AS VARCHAR) AS value "
                             f"FROM ({_body('datum')[1]}) v")
    left_fp = fingerprint_sql("tx", CLUSTER)
    right_fp = fingerprint_sql("tx", CLUSTER, source=ALTERED_TX_SQL, deps=tx_deps)
    strip = len(_with(["tx"]))
    cmp_sql = (_with(["tx"]) +
               f"SELECT coalesce(l.epoch_no, r.epoch_no) AS epoch_no, l.n_rows AS left_rows, l.hash_b64 AS left_hash, "
               f"r.n_rows AS right_rows, r.hash_b64 AS right_hash, "
               "CASE WHEN l.hash_b64 IS NULL THEN 'right_only' WHEN r.hash_b64 IS NULL THEN 'left_only' "
               "WHEN l.hash_b64 = r.hash_b64 THEN 'equal' ELSE 'differ' END AS status "
               f"FROM ({left_fp[strip:]}) l FULL OUTER JOIN ({right_fp[strip:]}) r ON l.epoch_no = r.epoch_no")
    q["v_compare"] = q_compare
    o["v_compare"] = cmp_sql
    q["v_row_diff"] = q_row_diff
    o["v_row_diff"] = (_with(["tx"]) +
                       f"SELECT *, 'left_only' AS side FROM (({tx_body}) EXCEPT ALL ({ALTERED_TX_SQL})) a "
                       f"UNION ALL SELECT *, 'right_only' AS side FROM (({ALTERED_TX_SQL}) EXCEPT ALL ({tx_body})) b")
    q["v_audit_log"] = q_audit
    o["v_audit_log"] = (cmp_sql.replace(
        "SELECT coalesce(l.epoch_no, r.epoch_no) AS epoch_no,",
        "SELECT epoch_no, 'tx' AS table_name, 'derive(tx)' AS pg_query, 'altered copy of tx' AS bq_query, "
        "coalesce(left_hash, 'empty') AS pg_hash, coalesce(right_hash, 'empty') AS bq_hash FROM ("
        "SELECT coalesce(l.epoch_no, r.epoch_no) AS epoch_no,", 1) + ") c")
    fresh_tables = [t for t in DERIVE if t not in ("meta", "schema_version")]
    fparts = []
    for t in fresh_tables:
        cols = SPECS[t].columns
        slot = "consumed_in_slot_no" if t == "tx_consumed_output" else "slot_no"
        has_slot, has_epoch = slot in cols, "epoch_no" in cols
        fparts.append(f"SELECT '{t}' AS tablename, CAST({'max(' + slot + ')' if has_slot else 'NULL'} AS BIGINT) "
                      f"AS max_slot_no, CAST({'max(epoch_no)' if has_epoch else 'NULL'} AS BIGINT) AS max_epoch_no "
                      f"FROM ({_body(t)[1]}) v")
    q["v_freshness"] = q_freshness
    o["v_freshness"] = (_with(fresh_tables) + "SELECT f.*, h.*, h.head_slot_no - f.max_slot_no AS slot_lag, "
                        "h.head_epoch_no - f.max_epoch_no AS epoch_lag FROM (" + " UNION ALL ".join(fparts) +
                        f") f, {DUCK_HEAD} h")
    q["v_drill_down"] = q_drill_down
    o["v_drill_down"] = _duck_drill_down()
    q["v_deep_compare_differs"] = q_deep_compare_differs
    o["v_deep_compare_differs"] = _duck_deep_compare_differs()
    q["v_deep_compare"] = q_deep_compare
    o["v_deep_compare"] = ("SELECT tablename, n_equal, CAST(0 AS BIGINT) AS n_differ, CAST(0 AS BIGINT) AS n_left_only, "
                           "CAST(0 AS BIGINT) AS n_right_only FROM (" +
                           " UNION ALL ".join(f"({_duck_fp_groups(t)})" for t in SPECS) + ") x")
    return q, o


# --- S: sources and sinks ---------------------------------------------------------

def q_load_source(spark, sf_dir):
    """S-01: stand-ins exported as a Parquet source, read back lazily, derived."""
    src = _q(spark, sf_dir)
    wh = scratch(spark)
    export_source(src, f"{wh.root}/source", ["block", "tx"])
    return DERIVE["tx_hash"](load_source(spark, f"{wh.root}/source"))


def q_enforce(spark, sf_dir):
    """S-02: violations of the tx schema when failed-script rows lose their fee."""
    t = derive_for_test(_q(spark, sf_dir), "tx")
    t = t.withColumn("fee", F.when(F.col("valid_script"), F.col("fee")))
    return enforce_schema(t, "tx")[1]


def q_csv_stage(spark, sf_dir):
    """S-03 / S-04: datum rows with a line break inside ``bytes`` through staging CSV."""
    d = derive_for_test(_q(spark, sf_dir), "datum")
    d = d.withColumn("bytes", F.concat(F.substring("bytes", 1, 8), F.lit("\n"), F.expr("substring(bytes, 9)")))
    wh = scratch(spark)
    path = f"{wh.root}/stage_csv"
    write_stage_csv(d, path, CHUNK)
    back = read_stage_csv(spark, path, "epoch_no BIGINT, slot_no BIGINT, txidx BIGINT, datum_hash STRING, "
                                       "bytes STRING, value STRING")
    return back.select("epoch_no", "slot_no", "txidx", "datum_hash", F.sha2("bytes", 256).alias("bytes_sha"),
                       "value")


def q_stage_append(spark, sf_dir):
    """S-05 / S-06 / S-07: epochs up to 41 replace the target via staging, later epochs are appended."""
    src = _q(spark, sf_dir)
    wh = scratch(spark)
    th = DERIVE["tx_hash"](src)
    wh.write_stage(th.where(F.col("epoch_no") <= 41), "tx_hash", part_col="epoch_no")
    wh.overwrite("tx_hash", wh.read_stage("tx_hash"), "epoch_no")
    wh.write_stage(th.where(F.col("epoch_no") > 41), "tx_hash", part_col="epoch_no")
    wh.append("tx_hash", wh.read_stage("tx_hash"), "epoch_no")
    return wh.read("tx_hash")


def q_split(spark, sf_dir):
    """S-09: each transaction's output indexes as one list, split into lists of at most 3."""
    outs = _q(spark, sf_dir)["tx_out"].groupBy("tx_id").agg(F.array_sort(F.collect_list("index")).alias("outputs"))
    s = split_long_list(outs, "outputs", 3)
    return s.select("tx_id", F.col("part").cast("bigint").alias("part"), F.to_json("outputs").alias("outputs"))


def q_watermark_upsert(spark, sf_dir):
    src = _q(spark, sf_dir)
    plan = plan_slot_windows(_li(spark), source_head(src["block"]), TEST.window)
    updates = plan.where(F.col("round") == 1).select(
        "tablename", F.col("max_slot_no").alias("last_slot_no"), F.lit(None).cast("bigint").alias("last_epoch_no"))
    return watermark_upsert(_li(spark), updates)


def _duck_plan() -> str:
    step = TEST.window.cap - TEST.window.grace
    return (f"SELECT tablename, r.\"round\", li.last_slot_no + (r.\"round\" - 1) * {step} AS last_k, "
            f"li.last_slot_no AS last0, h.head_slot_no FROM {_duck_li()} li, {DUCK_HEAD} h, "
            f"range(1, {TEST.window.rounds + 1}) r(\"round\")")


def duck_plan_sql() -> str:
    w = TEST.window
    return (f"SELECT tablename, \"round\", last_k AS last_slot_no, head_slot_no, "
            f"CASE WHEN tablename IN ({_quote(SLOT_APPEND)}) THEN last_k ELSE last_k - {w.delete} END AS clean_slot_no, "
            f"least(head_slot_no, last_k + {w.cap}) - {w.grace} AS max_slot_no, head_slot_no < last0 AS error "
            f"FROM ({_duck_plan()}) p WHERE last_k < head_slot_no - {w.grace}")


def sources_sinks() -> tuple[dict[str, Query], dict[str, str]]:
    q: dict[str, Query] = {}
    o: dict[str, str] = {}
    th_deps, th_body = _body("tx_hash")
    q["s_load_source"] = q_load_source
    o["s_load_source"] = duck_with(list(th_deps)) + th_body
    q["s_schema_enforce"] = q_enforce
    o["s_schema_enforce"] = (_with(["tx"]) + "SELECT 'tx' AS \"table\", 'fee' AS \"column\", 'null' AS kind, "
                             f"count(*) AS n_bad FROM ({_body('tx')[1]}) v WHERE NOT valid_script HAVING count(*) > 0")
    q["s_csv_stage"] = q_csv_stage
    o["s_csv_stage"] = (_with(["datum"]) + "SELECT epoch_no, slot_no, txidx, datum_hash, sha256(substring(bytes, 1, 8) "
                        "|| chr(10) || substring(bytes, 9)) AS bytes_sha, value FROM (" + _body("datum")[1] + ") v")
    q["s_stage_append"] = q_stage_append
    o["s_stage_append"] = duck_with(list(th_deps)) + th_body
    q["s_split_long_list"] = q_split
    o["s_split_long_list"] = (duck_with(["tx_out"]) +
                              "SELECT tx_id, part, to_json(list_slice(l, part * 3 + 1, part * 3 + 3))::VARCHAR AS outputs "
                              "FROM (SELECT tx_id, l, unnest(range(0, greatest((len(l) + 2) // 3, 1))) AS part FROM "
                              "(SELECT tx_id, list(\"index\" ORDER BY \"index\") AS l FROM tx_out GROUP BY tx_id) x) y")
    q["s_watermark_upsert"] = q_watermark_upsert
    o["s_watermark_upsert"] = (duck_with(["block"]) +
                               f"SELECT li.tablename, coalesce(p.max_slot_no, li.last_slot_no) AS last_slot_no, "
                               f"li.last_epoch_no FROM {_duck_li()} li LEFT JOIN "
                               f"(SELECT * FROM ({duck_plan_sql()}) pp WHERE \"round\" = 1) p USING (tablename)")
    return q, o


# --- W / P: planning, extraction, merges, jobs -------------------------------------

def q_head(spark, sf_dir):
    return source_head(_q(spark, sf_dir)["block"])


def q_plan_slots(spark, sf_dir):
    p = plan_slot_windows(_li(spark), source_head(_q(spark, sf_dir)["block"]), TEST.window)
    return p.withColumn("round", F.col("round").cast("bigint"))


def q_plan_epochs(spark, sf_dir):
    li = _li(spark).where(F.col("tablename").isin(EPOCH_ORDER))
    return plan_epochs(li, source_head(_q(spark, sf_dir)["block"]), sorted(EPOCH_CLOSED), True)


def _duck_plan_epochs() -> str:
    return (f"SELECT tablename, unnest(generate_series(lo, hi)) AS epoch_no, hi AS next_last_epoch_no FROM ("
            f"SELECT tablename, last_epoch_no + 1 AS lo, CASE WHEN tablename IN ({_quote(EPOCH_CLOSED)}) "
            f"THEN head_epoch_no - 1 ELSE last_epoch_no + 1 END AS hi FROM {_duck_li()} li, {DUCK_HEAD} h "
            f"WHERE head_epoch_no > last_epoch_no AND tablename IN ({_quote(EPOCH_ORDER)})) x WHERE lo <= hi")


def q_next_watermark(spark, sf_dir):
    """W-07: rows staged per table in its first planned window and the watermark that follows."""
    src = _mat(spark, sf_dir, scratch(spark))
    plan = {r["tablename"]: r for r in q_plan_slots(spark, sf_dir).where("round = 1").collect()}  # 23 rows
    counts = []
    for t in SLOT_ORDER:  # a query each, whose shuffles go before the next
        r = plan[t]
        with shuffles_dropped(spark):
            stage = (extract_replace(src, t, r["clean_slot_no"], r["max_slot_no"], TEST) if TABLES[t].slot_mode == "replace"
                     else extract_append(src, t, r["last_slot_no"], r["max_slot_no"], TEST))
            counts.append((t, stage.count()))
    out = []  # 23 counts, each with and without an empty window, with and without stall_safe
    for t, n in counts:
        p = plan[t]
        for rows in (n, 0):
            for stall_safe in (True, False):
                try:
                    nxt = next_watermark(SLOT_EMPTY[t], rows, p["max_slot_no"], p["last_slot_no"], stall_safe)
                except EmptyBatchError:
                    nxt = None
                out.append((t, rows, SLOT_EMPTY[t], stall_safe, nxt))
    return spark.createDataFrame(out, "tablename STRING, rows BIGINT, policy STRING, stall_safe BOOLEAN, next_last_slot_no BIGINT")


def _duck_next_watermark() -> str:
    parts = []
    for t in SLOT_ORDER:
        if TABLES[t].slot_mode == "replace":
            col = TABLES[t].slot_col
            parts.append(f"SELECT '{t}' AS tablename, count(*) AS rows FROM ({_body(t)[1]}) v, "
                         f"(SELECT * FROM p WHERE tablename = '{t}') w WHERE v.{col} BETWEEN w.clean_slot_no AND "
                         f"w.max_slot_no")
        else:
            body = _body(t)[1].replace(
                "JOIN block b ON b.id = t.block_id",
                f"JOIN (SELECT block.* FROM block, (SELECT * FROM p WHERE tablename = '{t}') w "
                f"WHERE block.slot_no > w.last_slot_no AND block.slot_no <= w.max_slot_no) b ON b.id = t.block_id")
            parts.append(f"SELECT '{t}' AS tablename, count(*) AS rows FROM ({body}) v")
    pol = ", ".join(f"('{t}', '{SLOT_EMPTY[t]}')" for t in SLOT_ORDER)
    return (_with(SLOT_ORDER) + f", p AS (SELECT * FROM ({duck_plan_sql()}) pp WHERE \"round\" = 1) "
            f"SELECT c.tablename, n.rows, pol.policy, s.stall_safe, CASE WHEN n.rows > 0 OR pol.policy = 'advance' "
            f"OR (pol.policy = 'keep' AND s.stall_safe) THEN p.max_slot_no WHEN pol.policy = 'keep' THEN p.last_slot_no "
            f"END AS next_last_slot_no FROM ({' UNION ALL '.join(parts)}) c, LATERAL (VALUES (c.rows), (0)) n(rows) "
            f"CROSS JOIN (VALUES (true), (false)) s(stall_safe) "
            f"JOIN (VALUES {pol}) pol(tablename, policy) ON pol.tablename = c.tablename JOIN p ON p.tablename = c.tablename")


def q_epoch_next_watermark(spark, sf_dir):
    """P-05: rows of each epoch table in its first due epoch and the epoch watermark that follows."""
    src = _mat(spark, sf_dir, scratch(spark))
    first = {r["tablename"]: r["e"] for r in
             q_plan_epochs(spark, sf_dir).groupBy("tablename").agg(F.min("epoch_no").alias("e")).collect()}
    parts = [extract_epoch(src, t, first[t], TEST).agg(F.lit(t).alias("tablename"), F.lit(first[t]).cast("bigint")
                                                       .alias("epoch_no"), F.count(F.lit(1)).alias("rows"))
             for t in EPOCH_ORDER if t in first]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    marks = {r["tablename"]: r["last_epoch_no"] for r in _li(spark).collect()}  # one row per table
    out = []
    for r in counts.collect():
        t, e = r["tablename"], r["epoch_no"]
        for rows in (r["rows"], 0):  # as found, and as if nothing had been found
            done = epochs_done(TABLES[t], [e], {e} if rows else set())
            out.append((t, e, rows, done[-1] if done else marks[t]))
    return spark.createDataFrame(out, "tablename STRING, epoch_no BIGINT, rows BIGINT, next_last_epoch_no BIGINT")


def _duck_epoch_filtered(t: str, cond: str) -> str:
    if t in ("epoch_param", "ada_pots", "epoch_stake", "reward", "param_proposal"):
        return f"SELECT * FROM ({_body(t)[1]}) v WHERE {cond.replace('block.', 'v.')}"
    return _body(t)[1].replace("JOIN block b ON b.id = t.block_id",
                               f"JOIN (SELECT * FROM block WHERE {cond}) b ON b.id = t.block_id")


def _duck_epoch_next_watermark() -> str:
    parts = []
    for t in EPOCH_ORDER:
        cond = f"block.epoch_no = (SELECT min(epoch_no) FROM pe WHERE tablename = '{t}')"
        parts.append(f"SELECT '{t}' AS tablename, (SELECT min(epoch_no) FROM pe WHERE tablename = '{t}') AS epoch_no, "
                     f"count(*) AS rows FROM ({_duck_epoch_filtered(t, cond)}) x")
    adv = _quote([t for t in EPOCH_ORDER if TABLES[t].epoch_empty == "advance" or t in EPOCH_CLOSED])
    return (_with(EPOCH_ORDER) + f", pe AS ({_duck_plan_epochs()}) SELECT c.tablename, c.epoch_no, n.rows, "
            f"CASE WHEN n.rows > 0 OR c.tablename IN ({adv}) THEN c.epoch_no ELSE li.last_epoch_no END "
            f"AS next_last_epoch_no FROM ({' UNION ALL '.join(parts)}) c, LATERAL (VALUES (c.rows), (0)) n(rows) "
            f"JOIN {_duck_li()} li ON li.tablename = c.tablename WHERE c.epoch_no IS NOT NULL")


def _head_max(spark, src) -> int:
    head = source_head(src["block"]).first()["head_slot_no"]
    return min(head, CUT_SLOT + TEST.window.cap) - TEST.window.grace


def q_extract_replace(spark, sf_dir):
    src = _q(spark, sf_dir)
    return extract_replace(src, "tx", CUT_SLOT - TEST.window.delete, _head_max(spark, src), TEST)


def q_extract_append(spark, sf_dir):
    src = _q(spark, sf_dir)
    return extract_append(src, "rel_addr_txout", CUT_SLOT, _head_max(spark, src), TEST)


def q_extract_epoch(spark, sf_dir):
    return extract_epoch(_q(spark, sf_dir), "delegation", RELOAD_EPOCH, TEST)


DUCK_MAX = (f"(SELECT least(max(slot_no), {CUT_SLOT + TEST.window.cap}) - {TEST.window.grace} FROM block)")


def _cut_target(src, wh: Warehouse, table: str) -> None:
    """A target as the last sync left it at ``CUT_SLOT``; the last 10 slots of
    replace tables are stale (wrong values that the re-derivation must repair)."""
    spec = TABLES[table]
    if spec.slot_mode == "replace":
        df = derive(src, table, opts=TEST).where(F.col(spec.slot_col) <= CUT_SLOT)
        stale = F.col(spec.slot_col) > CUT_SLOT - TEST.window.delete
        col = next(c for c in ("txidx", "announced_txidx", "block_size", "block_hash", "stake_addr_hash")
                   if c in df.columns)
        wrong = F.reverse(F.col(col)) if col.endswith("hash") else F.col(col) + 1000
        df = df.withColumn(col, F.when(stale, wrong).otherwise(F.col(col)))
        wh.overwrite(table, df, spec.part_col)
    else:
        wh.write_stage(extract_append(src, table, -1, CUT_SLOT, TEST), table, part_col=spec.part_col)
        merge_append(wh, table, CUT_SLOT, -1)
    wh.set_watermark(table, slot=CUT_SLOT, epoch=CUT_EPOCH)


def q_replace_merge(spark, sf_dir):
    """W-05: tx target cut at slot 1500 with 10 stale slots, after one window."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    _cut_target(src, wh, "tx")
    sync_table_slots(src, wh, "tx", CUT_SLOT, source_head(src["block"]).first()["head_slot_no"], TEST)
    return wh.read("tx")


def q_append_merge(spark, sf_dir):
    """W-06: rel_addr_txout appended window by window."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    _cut_target(src, wh, "rel_addr_txout")
    sync_table_slots(src, wh, "rel_addr_txout", CUT_SLOT, source_head(src["block"]).first()["head_slot_no"], TEST)
    return wh.read("rel_addr_txout")


RETRY_END, MOVED_END = 1997, 2097


def q_append_retry(spark, sf_dir):
    """W-06: an attempt to slot 1997 swapped its rows in but set no watermark; the retry ends at 2097."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    _cut_target(src, wh, "pool_update")
    load_window(src, wh, "pool_update", CUT_SLOT, CUT_SLOT, RETRY_END, TEST)
    wh.set_watermark("pool_update", slot=CUT_SLOT)
    load_window(src, wh, "pool_update", CUT_SLOT, CUT_SLOT, MOVED_END, TEST)
    return wh.read("pool_update")


ROLLED_FROM = 1485


def q_replace_rollback(spark, sf_dir):
    """W-05: blocks 1485 to 1500 were rolled back, also those of an epoch edge; no block replaces them."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    wh.overwrite("tx_hash", derive(src, "tx_hash", opts=TEST).where(F.col("slot_no") <= CUT_SLOT), "epoch_no")
    wh.set_watermark("tx_hash", slot=CUT_SLOT, epoch=CUT_EPOCH)
    rolled = {"tx": src["tx"], "block": src["block"].where(~F.col("slot_no").between(ROLLED_FROM, CUT_SLOT))}
    load_window(rolled, wh, "tx_hash", CUT_SLOT, ROLLED_FROM, source_head(src["block"]).first()["head_slot_no"], TEST)
    return wh.read("tx_hash")


def q_epoch_replace(spark, sf_dir):
    """P-03: delegation appended by two slot windows, then epoch 50 reloaded whole."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    _cut_target(src, wh, "delegation")
    sync_table_slots(src, wh, "delegation", CUT_SLOT, source_head(src["block"]).first()["head_slot_no"], TEST)
    rows = wh.write_stage(extract_epoch(src, "delegation", RELOAD_EPOCH, TEST), "delegation", part_col="epoch_no")
    if rows:
        merge_epoch(wh, "delegation", RELOAD_EPOCH)
    return wh.read("delegation")


def q_epoch_append(spark, sf_dir):
    """P-04: reward loaded up to epoch 40, then the next epoch."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    wh.overwrite("reward", derive(src, "reward").where(F.col("epoch_no") <= CUT_EPOCH), "epoch_no")
    rows = wh.write_stage(extract_epoch(src, "reward", CUT_EPOCH + 1), "reward", part_col="epoch_no")
    if rows:
        merge_epoch(wh, "reward", CUT_EPOCH + 1)
    return wh.read("reward")


def _contents(read, tables: list[str]) -> DataFrame:
    """Rows of each table and the sum of 48-bit row hashes: equal only if the same rows are there."""
    out = None
    for t in tables:
        df = read(t)
        digits = F.substring(F.sha2(row_text(df, SPECS[t]), 256), 1, 12)
        c = df.select(digits.alias("digits")).agg(
            F.lit(t).alias("tablename"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.conv("digits", 16, 10).cast("decimal(38,0)")).cast("string").alias("checksum"))
        out = c if out is None else out.unionByName(c)
    return out


def _duck_contents(t: str, source: str) -> str:
    from .oracle import row_text_sql
    return (f"SELECT '{t}' AS tablename, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(sha256({row_text_sql(t)}), 1, 12) "
            f"AS BIGINT)) AS VARCHAR) AS checksum FROM ({source}) v")


def q_slot_sync_job(spark, sf_dir):
    """W-08: all 23 slot tables cut at slot 1500, synced to the head in capped rounds."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    with shared_broadcasts(spark, TEST.parallel_tables), ThreadPoolExecutor(max_workers=TEST.parallel_tables) as pool:
        list(pool.map(lambda t: _cut_target(src, wh, t), SLOT_ORDER))
    slot_sync_job(src, wh, TEST)
    li = wh.last_index().select("tablename", "last_slot_no")
    return _contents(wh.read, SLOT_ORDER).join(li, "tablename")


def _duck_slot_sync_job() -> str:
    parts = []
    for t in SLOT_ORDER:
        if TABLES[t].slot_mode == "replace":
            parts.append(_duck_contents(t, f"SELECT * FROM ({_body(t)[1]}) w "
                                           f"WHERE {TABLES[t].slot_col} <= (SELECT last FROM fin)"))
        else:
            wins = [f"slot_no <= {CUT_SLOT}"] + [
                f"slot_no > (SELECT lo FROM r{k}) AND slot_no <= (SELECT hi FROM r{k})" for k in (1, 2, 3)]
            parts.append(_duck_contents(t, " UNION ALL ".join(f"(SELECT * FROM ({_windowed(t, w)}) w)" for w in wins)))
    w = TEST.window
    rounds = []
    lo = str(CUT_SLOT)
    for k in (1, 2, 3):
        rounds.append(f"r{k} AS (SELECT {lo} AS lo, CASE WHEN {lo} < h - {w.grace} THEN least(h, {lo} + {w.cap}) - "
                      f"{w.grace} ELSE {lo} END AS hi FROM (SELECT max(slot_no) AS h FROM block) x)")
        lo = f"(SELECT hi FROM r{k})"
    return (_with(SLOT_ORDER) + ", " + ", ".join(rounds) + ", fin AS (SELECT hi AS last FROM r3) "
            "SELECT c.tablename, c.n_rows, c.checksum, (SELECT last FROM fin) AS last_slot_no FROM (" +
            " UNION ALL ".join(parts) + ") c")


def q_zone_map(spark, sf_dir):
    """Zone map of source ids: built up to slot 1500 as the head was then, extended to the head in a second run."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    head = source_head(src["block"]).first()["head_slot_no"]
    for top in (CUT_SLOT, head):
        refresh_zones(src, wh, 0, top, top, TEST.window, ZONE_SLOTS)
    return wh.read(ZONES).select("slot_no", "relation", "first_id", "last_id")


def _duck_zone_map() -> str:
    zone = f"CAST(floor(b.slot_no / {ZONE_SLOTS}) * {ZONE_SLOTS} AS BIGINT) AS slot_no"
    of_tx = "JOIN tx t ON t.id = x.{tx} JOIN block b ON b.id = t.block_id"
    parts = [("block", "b.id", "block b"), ("tx", "t.id", "tx t JOIN block b ON b.id = t.block_id")]
    parts += [(name, f"x.{key}", f"{relation} x {of_tx.format(tx=tx)}") for name, (relation, key, tx) in HANG_ON_TX.items()]
    return duck_with(["block", "tx", *sorted({r for r, _, _ in HANG_ON_TX.values()})]) + " UNION ALL ".join(
        f"(SELECT {zone}, '{name}' AS relation, CAST(min({key}) AS BIGINT) AS first_id, CAST(max({key}) AS BIGINT) AS last_id "
        f"FROM {rows} WHERE b.slot_no >= 0 AND {key} IS NOT NULL GROUP BY 1)" for name, key, rows in parts)


def q_epoch_sync_job(spark, sf_dir):
    """P-06: the 11 epoch tables cut at epoch 40, then one epoch job."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    head_slot = source_head(src["block"]).first()["head_slot_no"]
    for t in EPOCH_ORDER:
        spec = TABLES[t]
        df = derive(src, t, opts=TEST).where(F.col("epoch_no") <= CUT_EPOCH)
        if spec.slot_mode == "append":
            df = df.withColumn("_batch", F.lit(None).cast("bigint"))
        wh.overwrite(t, df, spec.part_col)
        wh.set_watermark(t, slot=head_slot - TEST.window.grace if spec.slot_mode else None, epoch=CUT_EPOCH)
    epoch_sync_job(src, wh, TEST)
    li = wh.last_index().select("tablename", "last_epoch_no")
    return _contents(wh.read, EPOCH_ORDER).join(li, "tablename")


def _duck_epoch_sync_job() -> str:
    parts = []
    for t in EPOCH_ORDER:
        hi = "(SELECT max(epoch_no) - 1 FROM block)" if t in EPOCH_CLOSED else str(CUT_EPOCH + 1)
        # a closed epoch counts as done even without rows; an empty next epoch only where the table advances
        done = hi if t in EPOCH_CLOSED or TABLES[t].epoch_empty == "advance" else (
            f"(SELECT CASE WHEN count(*) > 0 THEN {hi} ELSE {CUT_EPOCH} END FROM ({_body(t)[1]}) d WHERE epoch_no = {hi})")
        rows = _duck_contents(t, f"SELECT * FROM ({_body(t)[1]}) w WHERE epoch_no <= {hi}")
        parts.append(f"SELECT r.*, {done} AS last_epoch_no FROM ({rows}) r")
    return _with(EPOCH_ORDER) + " UNION ALL ".join(parts)


GAP_EPOCH, BACKFILL_FROM = 40, 3


def q_backfill_epoch(spark, sf_dir):
    """B-01: tx_hash from epoch 3 over a source whose epoch 40 has no blocks: all other epochs."""
    return _gap_backfill(spark, sf_dir, False)


def q_backfill_stop_at_gap(spark, sf_dir):
    """B-01 with the reference deployment's stop: the epochs before the gap."""
    return _gap_backfill(spark, sf_dir, True)


def _gap_backfill(spark, sf_dir, stop_at_gap: bool):
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    gap = {k: src[k] for k in ("tx", "block")}
    gap["block"] = src["block"].where(F.col("epoch_no") != GAP_EPOCH)
    backfill_by_epoch(gap, wh, "tx_hash", BACKFILL_FROM, TEST, stop_at_gap)
    return wh.read("tx_hash")


def _duck_prefix(body: str, start: int, ecol: str = "epoch_no") -> str:
    return (f"SELECT * FROM ({body}) v WHERE {ecol} IN (SELECT e FROM (SELECT e, e - row_number() OVER (ORDER BY e) "
            f"AS isl FROM (SELECT DISTINCT {ecol} AS e FROM ({body}) d WHERE {ecol} >= {start}) u) g "
            f"WHERE isl = {start - 1})")


def test_starts() -> dict[str, int]:
    """Backfill starts scaled to the stand-in's 84 epochs (reference start / 10)."""
    return {t: s // 10 for t, s in BACKFILL_START.items()}


def q_backfill_full(spark, sf_dir):
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    backfill_full(src, wh, "pool_update", TEST)
    return wh.read("pool_update")


def q_backfill_job(spark, sf_dir):
    """B-03: all 30 tables in full, with their contents and watermarks."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    report = backfill_job(src, wh, opts=TEST)
    li = wh.last_index().select("tablename", "last_epoch_no")
    landed = _contents(wh.read, list(BACKFILL_START) + BACKFILL_FULL).join(report.select("tablename", "rows"), "tablename")
    return landed.where("rows = n_rows").drop("rows").join(li, "tablename", "left")


LOST_FEE_SLOT = 1700


def q_guarded_load(spark, sf_dir):
    """S-02 in W-08: fees of one slot's transactions are lost in the source; the load of tx is refused whole, that of tx_hash not."""
    from .streaming.block_stream import _Overlay
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    fee = F.when(F.col("block_id") >= LOST_FEE_SLOT, F.lit(None)).otherwise(F.col("fee"))
    broken = _Overlay(src, tx=src["tx"].withColumn("fee", fee))
    for t in ("tx", "tx_hash"):
        wh.overwrite(t, derive(src, t).where(F.col("slot_no") <= CUT_SLOT), "epoch_no", slot=CUT_SLOT, epoch=CUT_EPOCH)
    report = slot_sync_job(broken, wh, replace(TEST, enforce=True), ["tx", "tx_hash"])
    last = report.groupBy("tablename").agg(F.max_by("status", "round").alias("status"), F.max("last_slot_no").alias("last_slot_no"))
    return _contents(wh.read, ["tx", "tx_hash"]).join(last, "tablename")


def _duck_guarded_load() -> str:
    end = f"(SELECT max(slot_no) FROM block) - {TEST.window.grace}"
    tx, hashes = (_duck_contents(t, f"SELECT * FROM ({_body(t)[1]}) w WHERE slot_no <= {top}") for t, top in (("tx", str(CUT_SLOT)), ("tx_hash", end)))
    return _with(["tx", "tx_hash"]) + (f"SELECT a.*, 'refused' AS status, CAST({CUT_SLOT} AS BIGINT) AS last_slot_no FROM ({tx}) a "
                                       f"UNION ALL SELECT b.*, 'loaded', {end} FROM ({hashes}) b")


class _Growing(Mapping):
    """A source that shows blocks up to ``CUT_SLOT`` when first asked, and all of them afterwards."""

    def __init__(self, src):
        self.src, self.asked = src, 0

    def __getitem__(self, name: str) -> DataFrame:
        self.asked += name == "block"
        return self.src[name].where(F.col("slot_no") <= CUT_SLOT) if name == "block" and self.asked == 1 else self.src[name]

    def __iter__(self):
        return iter(self.src)

    def __len__(self) -> int:
        return len(self.src)


def q_backfill_growing(spark, sf_dir):
    """B-03: blocks arrive while the backfill runs; the slot sync that follows finds them all, none twice."""
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    backfill_job(_Growing(src), wh, opts=TEST, tables=FORK_TABLES)
    started = {r["tablename"]: r["last_slot_no"] for r in wh.last_index().collect()}  # one row per table
    slot_sync_job(src, wh, TEST, FORK_TABLES)
    loaded = spark.createDataFrame([(t, started[t]) for t in FORK_TABLES], "tablename STRING, backfilled_to BIGINT")
    return _contents(wh.read, FORK_TABLES).join(loaded, "tablename").join(wh.last_index().select("tablename", "last_slot_no"), "tablename")


def _duck_backfill_growing() -> str:
    end = f"(SELECT max(slot_no) FROM block) - {TEST.window.grace}"
    parts = []
    for t in FORK_TABLES:
        rows = (f"SELECT * FROM ({_body(t)[1]}) w WHERE slot_no <= {end}" if TABLES[t].slot_mode == "replace" else _windowed(t, f"slot_no <= {end}"))
        early = (f"SELECT * FROM ({_body(t)[1]}) w WHERE slot_no <= {CUT_SLOT}" if TABLES[t].slot_mode == "replace" else _windowed(t, f"slot_no <= {CUT_SLOT}"))
        last = f"(SELECT max(slot_no) FROM block WHERE epoch_no = (SELECT max(epoch_no) FROM ({early}) l) AND slot_no <= {CUT_SLOT})"
        parts.append(f"SELECT r.*, {last} AS backfilled_to, {end} AS last_slot_no FROM ({_duck_contents(t, rows)}) r")
    return _with(FORK_TABLES) + " UNION ALL ".join(parts)


def _duck_backfill_job() -> str:
    parts = []
    for t in list(BACKFILL_START) + BACKFILL_FULL:
        body = _body(t)[1]
        last = f"(SELECT max(epoch_no) FROM ({body}) l)"
        if t == "tx_consumed_output":
            last = f"(SELECT max(epoch_no) FROM block JOIN ({body}) l ON block.slot_no = l.consumed_in_slot_no)"
        if TABLES[t].part_col is None:
            last = "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT r.*, CAST({last} AS BIGINT) AS last_epoch_no FROM ({_duck_contents(t, body)}) r")
    return _with(list(BACKFILL_START) + BACKFILL_FULL) + " UNION ALL ".join(parts)


def sync_backfill() -> tuple[dict[str, Query], dict[str, str]]:
    q: dict[str, Query] = {}
    o: dict[str, str] = {}
    q["w_source_head"] = q_head
    o["w_source_head"] = duck_with(["block"]) + DUCK_HEAD[1:-1]
    q["w_plan_slot_windows"] = q_plan_slots
    o["w_plan_slot_windows"] = duck_with(["block"]) + duck_plan_sql()
    q["p_plan_epochs"] = q_plan_epochs
    o["p_plan_epochs"] = duck_with(["block"]) + _duck_plan_epochs()
    q["w_empty_batch_policy"] = q_next_watermark
    o["w_empty_batch_policy"] = _duck_next_watermark()
    q["p_epoch_empty_policy"] = q_epoch_next_watermark
    o["p_epoch_empty_policy"] = _duck_epoch_next_watermark()
    q["w_extract_replace"] = q_extract_replace
    o["w_extract_replace"] = (_with(["tx"]) + f"SELECT * FROM ({_body('tx')[1]}) v WHERE slot_no BETWEEN "
                              f"{CUT_SLOT - TEST.window.delete} AND {DUCK_MAX}")
    q["w_extract_append"] = q_extract_append
    o["w_extract_append"] = _with(["rel_addr_txout"]) + _windowed(
        "rel_addr_txout", f"slot_no > {CUT_SLOT} AND slot_no <= {DUCK_MAX}")
    q["p_extract_epoch"] = q_extract_epoch
    o["p_extract_epoch"] = _with(["delegation"]) + _windowed("delegation", f"epoch_no = {RELOAD_EPOCH}")
    q["w_replace_merge"] = q_replace_merge
    o["w_replace_merge"] = _with(["tx"]) + f"SELECT * FROM ({_body('tx')[1]}) v WHERE slot_no <= {DUCK_MAX}"
    wins = [f"slot_no <= {CUT_SLOT}", f"slot_no > {CUT_SLOT} AND slot_no <= {DUCK_MAX}"]
    q["w_append_merge"] = q_append_merge
    o["w_append_merge"] = _with(["rel_addr_txout"]) + " UNION ALL ".join(
        f"({_windowed('rel_addr_txout', w)})" for w in wins)
    q["w_append_retry"] = q_append_retry
    o["w_append_retry"] = _with(["pool_update"]) + " UNION ALL ".join(
        f"({_windowed('pool_update', w)})" for w in (f"slot_no <= {CUT_SLOT}", f"slot_no > {CUT_SLOT} AND slot_no <= {MOVED_END}"))
    q["w_replace_rollback"] = q_replace_rollback
    o["w_replace_rollback"] = _with(["tx_hash"]) + _windowed("tx_hash", f"slot_no NOT BETWEEN {ROLLED_FROM} AND {CUT_SLOT}")
    q["p_epoch_replace_merge"] = q_epoch_replace
    o["p_epoch_replace_merge"] = _with(["delegation"]) + " UNION ALL ".join(
        [f"SELECT * FROM ({_windowed('delegation', w)}) v WHERE epoch_no <> {RELOAD_EPOCH}" for w in wins]
        + [f"SELECT * FROM ({_body('delegation')[1]}) v WHERE epoch_no = {RELOAD_EPOCH}"])
    q["p_epoch_append_merge"] = q_epoch_append
    o["p_epoch_append_merge"] = (_with(["reward"]) + f"SELECT * FROM ({_body('reward')[1]}) v "
                                 f"WHERE epoch_no <= {CUT_EPOCH + 1}")
    q["w_slot_sync_job"] = q_slot_sync_job
    o["w_slot_sync_job"] = _duck_slot_sync_job()
    q["w_zone_map"] = q_zone_map
    o["w_zone_map"] = _duck_zone_map()
    q["p_epoch_sync_job"] = q_epoch_sync_job
    o["p_epoch_sync_job"] = _duck_epoch_sync_job()
    q["b_backfill_by_epoch"] = q_backfill_epoch
    th = _body("tx_hash")[1].replace("JOIN block b ON b.id = t.block_id",
                                     f"JOIN (SELECT * FROM block WHERE epoch_no <> {GAP_EPOCH}) b ON b.id = t.block_id")
    o["b_backfill_by_epoch"] = _with(["tx_hash"]) + f"SELECT * FROM ({th}) v WHERE epoch_no >= {BACKFILL_FROM}"
    q["b_backfill_stop_at_gap"] = q_backfill_stop_at_gap
    o["b_backfill_stop_at_gap"] = _with(["tx_hash"]) + _duck_prefix(th, BACKFILL_FROM)
    q["b_backfill_full"] = q_backfill_full
    o["b_backfill_full"] = _with(["pool_update"]) + _body("pool_update")[1]
    q["s_guarded_load"] = q_guarded_load
    o["s_guarded_load"] = _duck_guarded_load()
    q["b_backfill_growing"] = q_backfill_growing
    o["b_backfill_growing"] = _duck_backfill_growing()
    q["b_backfill_job"] = q_backfill_job
    o["b_backfill_job"] = _duck_backfill_job()
    return q, o


# --- W-09: stream ------------------------------------------------------------------

ROLLBACK_SLOTS = 10


STREAM_APPEND = ["pool_update", "delegation"]


def _streamed(spark, sf_dir, tables: list[str]) -> Warehouse:
    """Blocks arrive as one file per ten epochs, two files a batch; a late file rewrites the last 10 slots (their
    time moves by an hour)."""
    from .streaming.block_stream import stream_sync
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    blocks = src["block"]
    block_dir = f"{wh.root}/incoming_blocks"
    top = blocks.agg(F.max("slot_no"), F.max("epoch_no")).first()
    for e in range(0, top[1] + 1, 10):
        blocks.where(F.col("epoch_no").between(e, e + 9)).coalesce(1).write.mode("append").parquet(block_dir)
    late = (blocks.where(F.col("slot_no") > top[0] - ROLLBACK_SLOTS)
            .withColumn("time", F.col("time") + F.expr("INTERVAL 1 HOUR")))
    late.coalesce(1).write.mode("append").parquet(block_dir)
    stream_sync(spark, src, block_dir, wh, tables, TEST, files_per_batch=2, block_schema=blocks.schema)
    return wh


def q_stream(spark, sf_dir):
    """W-09: tx after the stream."""
    return _streamed(spark, sf_dir, ["tx"]).read("tx")


def q_stream_append(spark, sf_dir):
    """W-09: what append tables hold after a backlog of several batches and a rollback, each entry once."""
    wh = _streamed(spark, sf_dir, STREAM_APPEND)
    entries = F.sum(F.size(F.from_json("delegations", "array<struct<slot_no BIGINT>>"))).cast("bigint")
    return (wh.read("pool_update").agg(F.lit("pool_update").alias("tablename"), F.count("*").alias("entries"))
            .unionByName(wh.read("delegation").agg(F.lit("delegation").alias("tablename"), entries.alias("entries"))))


# A fork from FORK_SLOT on: its blocks (a later time, the same ids) lie at every third slot, so most slots become empty.
FORK_SLOT, FORK_STEP, FIRST_PART = 2100, 3, 1200
STREAM = SyncOptions(window=SlotWindowConfig(cap=2000, grace=3, delete=10, rounds=3), cluster_size=CLUSTER, parallel_tables=8)
FORK_TABLES = ["block_hash", "tx", "pool_update"]
#: They count inputs and outputs and read nothing else of them.
FORK_COLUMNS = {"tx_out": ["tx_id"], "tx_in": ["tx_in_id"]}
#: The column by which a source relation hangs on a transaction; the others are delivered whole.
TX_LINK = {"tx_out": "tx_id", "tx_in": "tx_in_id", "collateral_tx_in": "tx_in_id", "delegation": "tx_id", "ma_tx_mint": "tx_id",
           "tx_metadata": "tx_id", "datum": "tx_id", "script": "tx_id", "redeemer": "tx_id", "stake_registration": "tx_id",
           "stake_deregistration": "tx_id", "withdrawal": "tx_id", "pool_metadata_ref": "registered_tx_id",
           "pool_update": "registered_tx_id", "pool_retire": "announced_tx_id"}
DELIVERED = ["tx", *TX_LINK, "stake_address", "pool_hash", "slot_leader", "multi_asset", "ma_tx_out", "redeemer_data", "pool_owner", "pool_offline_data"]
#: The list column of tables whose rows depend on the windows; their entries don't.
ENTRIES = {"delegation": "delegations", "ma_minting": "minting", "rel_addr_txout": "outputs", "rel_stake_txout": "outputs"}


def _fork(blocks: DataFrame) -> DataFrame:
    return (blocks.where((F.col("slot_no") >= FORK_SLOT) & ((F.col("slot_no") - FORK_SLOT) % FORK_STEP == 0))
            .withColumn("time", F.col("time") + F.expr("INTERVAL 1 HOUR")))


def q_stream_fork(spark, sf_dir):
    """W-09: blocks arrive as one file per ten epochs, two files a batch; then a fork that leaves slots empty."""
    from .streaming.block_stream import stream_sync
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh, FORK_COLUMNS)
    blocks, block_dir = src["block"], f"{wh.root}/incoming_blocks"
    for e in range(0, blocks.agg(F.max("epoch_no")).first()[0] + 1, 10):
        blocks.where(F.col("epoch_no").between(e, e + 9)).coalesce(1).write.mode("append").parquet(block_dir)
    stream_sync(spark, src, block_dir, wh, FORK_TABLES, STREAM, files_per_batch=2, block_schema=blocks.schema)
    _fork(blocks).coalesce(1).write.mode("append").parquet(block_dir)
    stream_sync(spark, src, block_dir, wh, FORK_TABLES, STREAM, files_per_batch=2, block_schema=blocks.schema)
    return _contents(wh.read, FORK_TABLES)


def _causal(src) -> dict[str, DataFrame]:
    """The stand-ins of inputs, without those that spend an output of the same or a later block."""
    tx = src["tx"].select("id", "block_id")
    made, spent = tx.toDF("tx_out_id", "_made"), tx.toDF("tx_in_id", "_spent")
    return {n: src[n].join(made, "tx_out_id").join(spent, "tx_in_id").where("_made < _spent").select(*src[n].columns) for n in ("tx_in", "collateral_tx_in")}


def _deliver(src, root: str, top: int, name: str, number: int) -> None:
    """Write delivery 1 (to FIRST_PART), 2 (the rest) or 3 (the fork's) of one relation."""
    df, slots = src[name], src["block"].select(F.col("id").alias("block_id"), "slot_no")
    if name in TX_LINK:
        tx = src["tx"].select(F.col("id").alias(TX_LINK[name]), "block_id").join(slots, "block_id").drop("block_id")
        df = df.join(tx.withColumnRenamed("slot_no", "_slot"), TX_LINK[name], "left").withColumn("_slot", F.coalesce("_slot", F.lit(0)))
    elif name == "tx":
        df = df.join(slots.withColumnRenamed("slot_no", "_slot"), "block_id")
    else:
        df = df.withColumn("_slot", F.col("slot_no") if name == "block" else F.lit(0))
    part = {1: F.col("_slot") <= FIRST_PART, 2: F.col("_slot") > FIRST_PART, 3: (F.col("_slot") >= FORK_SLOT) & ((F.col("_slot") - FORK_SLOT) % FORK_STEP == 0)}[number]
    rows = df.where(part).select(*src[name].columns)
    if name == "block" and number == 3:
        rows = _fork(rows)
    rows.coalesce(1).write.parquet(f"{root}/{name}/delivery={number}/upto_slot={FIRST_PART if number == 1 else top}")


def _entries(read, table: str) -> DataFrame:
    df, lists = read(table), ENTRIES[table]
    return df.select(*[c for c in df.columns if c != lists], F.explode(F.from_json(lists, "array<string>")).alias("entry"))


def _entry_contents(read, table: str) -> DataFrame:
    df = _entries(read, table)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in sorted(df.columns)])
    digits = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.lit(table).alias("tablename"), F.count(F.lit(1)).alias("n_rows"), F.sum(digits).cast("string").alias("checksum"))


def q_stream_relations(spark, sf_dir):
    """W-09: all relations arrive in deliveries of their own. First blocks run ahead of outputs, so that windows wait; then the
    outputs come; then a fork of blocks, which takes the tables back; then the other relations of the fork. Contents of all 23
    slot tables (entries of lists where rows depend on the windows)."""
    from .streaming.block_stream import stream_sync
    wh = scratch(spark)
    src = _mat(spark, sf_dir, wh)
    src = {n: src[n] for n in ["block", *DELIVERED]}
    src |= {n: MaterializedCatalog(_causal(src), f"{wh.root}/causal")[n] for n in ("tx_in", "collateral_tx_in")}
    top, root, schema = src["block"].agg(F.max("slot_no")).first()[0], f"{wh.root}/incoming", src["block"].schema

    def deliver(names, numbers):
        with shared_broadcasts(spark, 4), ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(lambda x: _deliver(src, root, top, *x), [(n, k) for n in names for k in numbers]))

    def run():
        stream_sync(spark, None, f"{root}/block", wh, SLOT_ORDER, STREAM, files_per_batch=1, block_schema=schema, delivered=root, delivered_names=DELIVERED)

    deliver(["block", *[n for n in DELIVERED if n != "tx_out"]], (1, 2))
    deliver(["tx_out"], (1,))
    run()
    deliver(["tx_out"], (2,))
    run()
    deliver(["block"], (3,))
    run()
    deliver(DELIVERED, (3,))
    run()
    plain = [t for t in SLOT_ORDER if t not in ENTRIES]
    out = _contents(wh.read, plain)
    for t in ENTRIES:
        out = out.unionByName(_entry_contents(wh.read, t))
    marks = wh.last_index().select("tablename", "last_slot_no")
    return out.join(marks, "tablename")


def _with_fork(names: list[str], causal: bool) -> str:
    """The stand-ins over the winning chain."""
    text = _with(names, ("block", "tx", "tx_in")).rstrip().replace("block AS (", "block0 AS (", 1)
    if causal:  # names that end in 0 are the stand-ins as they come
        text = text.replace("collateral_tx_in AS (", "collateral_tx_in0 AS (", 1).replace("\ntx_in AS (", "\ntx_in0 AS (", 1)
        text = text.replace("FROM tx_in WHERE", "FROM tx_in0 WHERE", 1)
        for n in ("tx_in", "collateral_tx_in"):
            text += (f", {n} AS (SELECT i.* FROM {n}0 i JOIN tx p ON p.id = i.tx_out_id JOIN tx c ON c.id = i.tx_in_id "
                     "WHERE p.block_id < c.block_id)")
    return text + (f", block AS (SELECT * REPLACE (CASE WHEN slot_no >= {FORK_SLOT} THEN time + INTERVAL 1 HOUR ELSE time END AS time) "
                   f"FROM block0 WHERE slot_no < {FORK_SLOT} OR (slot_no - {FORK_SLOT}) % {FORK_STEP} = 0) ")


def streaming() -> tuple[dict[str, Query], dict[str, str]]:
    moved = (f"(SELECT * REPLACE (CASE WHEN slot_no > (SELECT max(slot_no) FROM block) - {ROLLBACK_SLOTS} "
             f"THEN time + INTERVAL 1 HOUR ELSE time END AS time) FROM block)")
    body = _body("tx")[1].replace("JOIN block b ON b.id = t.block_id", f"JOIN {moved} b ON b.id = t.block_id")
    end = f"(SELECT max(slot_no) FROM block) - {TEST.window.grace}"
    entries = (f"SELECT 'pool_update' AS tablename, count(*) AS entries FROM ({_windowed('pool_update', f'slot_no <= {end}')}) v UNION ALL "
               f"SELECT 'delegation', CAST(sum(json_array_length(delegations)) AS BIGINT) FROM ({_windowed('delegation', f'slot_no <= {end}')}) v")
    return ({"w_stream_sync": q_stream, "w_stream_append": q_stream_append, "w_stream_fork": q_stream_fork, "w_stream_relations": q_stream_relations},
            {"w_stream_sync": _with(["tx"]) + f"SELECT * FROM ({body}) v WHERE slot_no <= {end}",
             "w_stream_append": _with(STREAM_APPEND) + entries,
             "w_stream_fork": _with_fork(FORK_TABLES, False) + " UNION ALL ".join(_duck_contents(t, _to_end(t)) for t in FORK_TABLES),
             "w_stream_relations": _duck_stream_relations()})


def _to_end(t: str) -> str:
    """Rows up to where the stream's last window ends."""
    end = f"(SELECT max(slot_no) FROM block) - {STREAM.window.grace}"
    if TABLES[t].slot_mode == "replace":
        return f"SELECT * FROM ({_body(t)[1]}) w WHERE {TABLES[t].slot_col} <= {end}"
    return _windowed(t, f"slot_no <= {end}")


def _duck_stream_relations() -> str:
    parts = []
    for t in SLOT_ORDER:
        if t not in ENTRIES:
            parts.append(_duck_contents(t, _to_end(t)))
            continue
        columns = {"delegation": ["epoch_no", "stake_addr_hash"], "ma_minting": ["fingerprint", "policyid", "name_bytes", "epoch_no"],
                   "rel_addr_txout": ["epoch_no", "address", "address_has_script", "payment_cred", "data_hash", "inline_datum", "reference_script"],
                   "rel_stake_txout": ["epoch_no", "address"]}[t]
        text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in sorted([*columns, "entry"]))
        rows = f"SELECT {', '.join(columns)}, unnest(json_extract_string({ENTRIES[t]}, '$[*]')) AS entry FROM ({_to_end(t)}) e"
        parts.append(f"SELECT '{t}' AS tablename, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(sha256({text}), 1, 12) AS BIGINT)) AS VARCHAR) "
                     f"AS checksum FROM ({rows}) v")
    end = f"(SELECT max(slot_no) FROM block) - {STREAM.window.grace}"
    return _with_fork(SLOT_ORDER, True) + f"SELECT c.*, {end} AS last_slot_no FROM (" + " UNION ALL ".join(parts) + ") c"


PARTS = (validation, sources_sinks, sync_backfill, streaming)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in PARTS:
        out.update(part()[0])
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in PARTS:
        out.update(part()[1])
    return out
