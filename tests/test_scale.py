"""What keeps jobs within memory, shuffles and time: relations written once, broadcasts shared out, one comparison at a time."""

import time

from pyspark.sql import functions as F

from utxolake.operators.outputs import rel_addr_txout
from utxolake.plans.validate import deep_compare_job
from utxolake.session import shared_broadcasts, shuffles_dropped
from utxolake.sources.loader import MaterializedCatalog
from utxolake.sources.sinks import Warehouse
from utxolake.sources.standin import StandIn

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_written_relations_are_what_others_are_derived_from(spark, tmp_path):
    plain = StandIn(spark, SF)
    cat = MaterializedCatalog(plain, str(tmp_path))
    for name in ("ma_tx_out", "ma_tx_mint", "redeemer"):
        assert "Window" not in _plan(cat.src[name]), name  # tx_out numbers the outputs, once
    for name in ("tx_out", "ma_tx_out", "redeemer", "collateral_tx_in", "pool_owner", "ada_pots"):
        assert cat[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(cat[name]).isEmpty(), name
    assert plain.written is None


def test_deep_compare_compares_table_by_table(spark, tmp_path):
    src, wh = StandIn(spark, SF), Warehouse(spark, str(tmp_path))
    for t in ("block_hash", "tx_hash"):
        from utxolake.plans.sync import backfill_full
        backfill_full(src, wh, t)
    out = deep_compare_job(src, wh, ["block_hash", "tx_hash"], epochs="all")
    staged = [n for n in wh._names(f"{wh.root}/_staging/deep_compare")]
    assert sorted(staged) == ["result_block_hash", "result_tx_hash"]
    assert {r[0] for r in out.select("status").distinct().collect()} == {"equal"}
    assert wh.read("log_deep_comparison").count() == out.count()


def test_jobs_at_once_share_the_broadcast_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "8m")
    try:
        with shared_broadcasts(spark, 4):
            assert spark.conf.get(LIMIT) == str(2 << 20)
            with shared_broadcasts(spark, 8):  # a job within a job doesn't share again
                assert spark.conf.get(LIMIT) == str(2 << 20)
            assert spark.conf.get(LIMIT) == str(2 << 20)
        assert spark.conf.get(LIMIT) == "8m"
        spark.conf.set(LIMIT, "-1")
        with shared_broadcasts(spark, 4):
            assert spark.conf.get(LIMIT) == "-1"
    finally:
        spark.conf.set(LIMIT, before)


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_written_queries_leave_no_shuffle_files(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, wh = spark.conf.get(setting), Warehouse(spark, str(tmp_path))
    rows = spark.range(1000).selectExpr("id % 7 AS epoch_no", "id AS slot_no").groupBy("epoch_no").count()
    there = _shuffle_files(spark)
    spark.conf.set(setting, "false")
    try:
        wh.overwrite("t", rows, "epoch_no")
        wh.write_stage(rows, "t")
        written = MaterializedCatalog({"r": rows}, f"{tmp_path}/source")["r"]
        with shuffles_dropped(spark), shuffles_dropped(spark):
            assert rows.count() == 7
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.set(setting, before)
    for _ in range(50):  # they go in the background
        if _shuffle_files(spark) <= there:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= there
    assert wh.read("t").count() == wh.read_stage("t").count() == written.count() == 7


def test_hashes_are_grouped_as_bytes(spark):
    src = StandIn(spark, SF)
    df = rel_addr_txout(src, cluster_size=5)
    plan = _plan(df)
    assert "lower(hex(" in plan and "lower(hex(" not in plan[plan.index("collect_list"):]
    assert df.where(F.length("payment_cred") != 64).isEmpty()


def test_newest_rows_of_deliveries_are_found_without_pruning_subqueries(spark, tmp_path):
    """Pruning folders by a join on ``delivery`` would hold a row per id on the driver."""
    from utxolake.streaming.chain import DeliveredCatalog
    root, schema = f"{tmp_path}/in", "id BIGINT, tx_id BIGINT"
    rows = {1: [(i, 1) for i in range(40)] + [(None, 1)], 2: [(i, 2) for i in (*range(30, 60), 35, 35)], 10: [(33, 10), (33, 10), (70, 10), (None, 10)]}
    for d, r in rows.items():
        spark.createDataFrame(r, schema).write.parquet(f"{root}/tx_out/delivery={d}/upto_slot={d}")
    df = DeliveredCatalog(Warehouse(spark, f"{tmp_path}/wh"), root, spark.range(1), ["tx_out"])["tx_out"]
    newest = {i: d for d in sorted(rows) for i, _ in rows[d] if i is not None}
    want = [(i, d) for d in rows for i, _ in rows[d] if i is None or newest[i] == d]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)
    assert "dynamicpruning" not in _plan(df)


def test_windows_of_the_empty_policy_are_counted_one_by_one(spark, monkeypatch):
    from utxolake import catalog_queries
    monkeypatch.setattr(catalog_queries, "SLOT_ORDER", ["tx", "pool_update", "rel_addr_txout"])
    shuffles = lambda: {n.split("_")[1] for n in _shuffle_files(spark)}
    there = shuffles()
    out = catalog_queries.q_next_watermark(spark, SF)
    assert {r[0] for r in out.select("tablename").distinct().collect()} == {"tx", "pool_update", "rel_addr_txout"}
    for _ in range(50):
        if len(shuffles() - there) <= 6:
            break
        time.sleep(0.1)
    assert len(shuffles() - there) <= 6  # of the order of inputs, which is checkpointed, of the plan and of the check above


def _outputs_source(spark):
    """Twelve addresses in four epochs, one of them null and one with most outputs; datum 3 comes twice, script 4 with another hash too."""
    block = spark.createDataFrame([(s, s, s // 3, s) for s in range(12)], "id BIGINT, slot_no BIGINT, epoch_no BIGINT, time BIGINT")
    tx = spark.createDataFrame([(t, t % 12, t // 12) for t in range(60)], "id BIGINT, block_id BIGINT, block_index BIGINT")
    outs = [(t, i, None if (t + i) % 13 == 0 else "hot" if (t * 3 + i) % 2 else f"a{(t + i) % 10}", (t * i) % 6 or None, (t + i) % 7 - 2 if (t + i) % 7 > 3 else None)
            for t in range(60) for i in range(t % 5 + 1)]
    tx_out = spark.createDataFrame(outs, "tx_id BIGINT, index BIGINT, address STRING, inline_datum_id BIGINT, reference_script_id BIGINT")
    tx_out = tx_out.selectExpr("*", "address = 'a1' AS address_has_script", "CAST(address AS BINARY) AS payment_cred", "CAST(NULL AS BINARY) AS data_hash",
                               "CASE WHEN tx_id % 3 > 0 THEN tx_id % 4 END AS stake_address_id")
    hashes = "id BIGINT, hash BINARY"
    stakes = spark.createDataFrame([(0, "s0"), (1, "s1"), (2, "s1"), (None, "s4"), (3, None)], "id BIGINT, view STRING")
    return {"block": block, "tx": tx, "tx_out": tx_out, "datum": spark.createDataFrame([(1, b"x"), (2, b"y"), (3, b"z"), (3, b"z")], hashes),
            "script": spark.createDataFrame([(2, b"r"), (4, b"s"), (4, b"t")], hashes), "stake_address": stakes}


def test_lists_of_hot_and_other_addresses_are_alike(spark, monkeypatch):
    """Addresses are ranked in one task or, if hot, slot by slot: the lists are those of ``clustered`` over all rows, as before."""
    from utxolake.operators import outputs
    src = _outputs_source(spark)
    ptr = outputs.tx_pointer(src)
    outs = src["tx_out"].join(ptr, "tx_id").withColumnRenamed("index", "idx")
    hashes = {n: src[n].select(F.col("id").alias(k), F.col("hash").alias(v)) for n, k, v in
              (("datum", "inline_datum_id", "inline_datum"), ("script", "reference_script_id", "reference_script"))}
    rows = outs.join(hashes["datum"], "inline_datum_id", "left").join(hashes["script"], "reference_script_id", "left")
    attrs = ["address_has_script", "payment_cred", "data_hash", "inline_datum", "reference_script"]
    keys = ["epoch_no", "address"]

    def lists(ranked, by):
        return sorted((repr(r[:-1]), r[-1]) for r in map(tuple, ranked.groupBy(*by, "cluster_no").agg(F.sort_array(F.collect_list(F.struct("slot_no", "txidx", "idx"))).alias("o"))
                      .select(*by, F.expr("to_json(transform(o, x -> struct(x.idx AS idx, x.slot_no AS slot_no, x.txidx AS txidx)))")).collect()))

    want = lists(outputs.clustered(rows, ["address"], 3, base=outs), keys + attrs)
    stakes = src["stake_address"].select(F.col("id").alias("stake_address_id"), F.col("view").alias("address"))
    want_stake = lists(outputs.clustered(outs.drop("address").join(stakes, "stake_address_id"), ["address"], 3), keys)
    for most in (0, 8, 30, 10**6):
        monkeypatch.setattr(outputs, "HOT", most)
        got = outputs.rel_addr_txout(src, cluster_size=3)
        unhexed = [F.unhex(c).alias(c) if c in attrs[1:] else c for c in got.columns]
        assert sorted((repr(r[:-1]), r[-1]) for r in map(tuple, got.select(*unhexed).collect())) == want, most
        assert sorted((repr(r[:-1]), r[-1]) for r in map(tuple, outputs.rel_stake_txout(src, cluster_size=3).collect())) == want_stake, most


def test_outputs_go_to_their_address_once(spark):
    """Of addresses that aren't hot: ranking and lists need one shuffle, and only outputs with a datum or script are shuffled for it."""
    from utxolake.operators import outputs
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(40).selectExpr("id % 2 AS epoch_no", "CAST(id % 5 AS STRING) AS address", "id AS slot_no", "id AS txidx", "id AS idx", "true AS _counts", "IF(id < 0, id, NULL) AS _cluster")
        plan = outputs._lists(rows, [], 3)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") <= 2, plan  # by slot, and by cluster if it groups by sorting
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    plan = _plan(rel_addr_txout(_outputs_source(spark)))
    assert "(isnotnull(inline_datum_id" in plan and "OR isnotnull(reference_script_id" in plan


def _lines(spark, tmp_path, keys):
    """A source of lineitem rows alone; they differ in their order keys only."""
    rows = [(k, i % 5, i, i, float(i), float(i), 0.0, 0.0, "A", "F") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                                     "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING")
    df.withColumn("l_shipdate", F.lit("1995-03-01").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return StandIn(spark, str(tmp_path))


def test_inputs_follow_from_the_number_of_outputs(spark, tmp_path, monkeypatch):
    """tx_in orders a row per transaction, not one per output, and joins nothing."""
    from utxolake.sources import standin
    monkeypatch.setattr(standin, "_TX_BUCKET", 8)  # looks back into the bucket before
    counts = {None: 4, -5: 1, 2: 1, 3: 12, 4: 1, 5: 1, 9: 2, 11: 1, 12: 1, 13: 1, 14: 1, 15: 1, 16: 1, 17: 1, 18: 9, 400: 7, 401: 3}
    src = _lines(spark, tmp_path, [k for k, n in counts.items() for _ in range(n)])
    places = [(k, i) for k, n in counts.items() for i in range(n)]
    want = sorted((a * 100 + i, a, b, j) for (a, i), (b, j) in zip(places[7:], places) if a is not None and b is not None and a > b)
    assert sorted(map(tuple, src["tx_in"].collect())) == want
    assert "Join" not in _plan(src["tx_in"]).split("RepartitionByExpression")[0]


def test_redeemers_are_written_out_in_their_group(spark):
    from utxolake.operators.scripts import redeemer
    src = StandIn(spark, SF)
    above, below = _plan(redeemer(src)).split("RepartitionByExpression", 1)
    assert "lower(hex(" in above and "lower(hex(" not in below
    twice = {**{n: src[n] for n in ("block", "tx", "redeemer_data")}, "redeemer": src["redeemer"].unionAll(src["redeemer"])}
    one, two = redeemer(src).agg(F.sum("count")).first()[0], redeemer(twice).agg(F.sum("count")).first()[0]
    assert two == 2 * one > 0


def test_lists_of_inputs_and_outputs_are_made_behind_their_shuffle(spark):
    from utxolake.operators.chain import tx_in_out
    assert _plan(tx_in_out(StandIn(spark, SF))).count("RepartitionByExpression [tx_id") == 2
    rows = [(1, 7, 0, "b", 5), (1, 7, 0, "a", 6), (2, 7, 1, "c", 1), (None, 7, 2, "d", 2)]  # ids and indexes may repeat
    cat = {"block": spark.sql("SELECT 1L id, 10L slot_no, 0L epoch_no, TIMESTAMP'2020-01-01' time"),
           "tx": spark.sql("SELECT 7L id, 1L block_id, 3L block_index"),
           "tx_out": spark.createDataFrame(rows, "id BIGINT, tx_id BIGINT, index BIGINT, address STRING, value BIGINT"),
           "tx_in": spark.sql("SELECT 1L id, 7L tx_in_id, 7L tx_out_id, 1L tx_out_index UNION ALL SELECT 2, 7, 7, 0"),
           "ma_tx_out": spark.sql("SELECT 1L id, 1L ident, 4L quantity, 1L tx_out_id UNION ALL SELECT 2, 1, 3, 1"),
           "multi_asset": spark.sql("SELECT 1L id, 'f' fingerprint")}
    got = tx_in_out(cat).collect()
    ma = '"out_ma":[{"fingerprint":"f","quantity":3},{"fingerprint":"f","quantity":4}]'
    assert [tuple(r) for r in got] == [(0, 10, 3, '[{"in_idx":0,"in_slot_no":10,"in_txidx":3},{"in_idx":1,"in_slot_no":10,"in_txidx":3}]',
        f'[{{"out_address":"a","out_idx":0,{ma},"out_value":6}},{{"out_address":"b","out_idx":0,{ma},"out_value":5}},'
        '{"out_address":"c","out_idx":1,"out_ma":null,"out_value":1},{"out_address":"d","out_idx":2,"out_ma":null,"out_value":2}]')]


def test_windows_leave_epochs_before_them_as_they_are(spark, tmp_path):
    """A slot bucket may span many epochs; those that a window doesn't reach are not written again."""
    from utxolake.plans.sync import merge_replace
    wh = Warehouse(spark, str(tmp_path), bucket_slots=100)
    rows = [(0, 1), (0, 9), (1, 10), (1, 15), (2, 12), (2, 20), (11, 110)]  # epochs need not follow the slots
    schema = "epoch_no BIGINT, slot_no BIGINT, n INT"

    def merge(rows, n, clean):
        wh.write_stage(spark.createDataFrame([(*r, n) for r in rows], schema), "block_hash")
        merge_replace(wh, "block_hash", clean)
        return {(x.part, x.bucket): x.load for x in wh.state("block_hash").leaves}, sorted(tuple(r) for r in wh.read("block_hash").select("epoch_no", "slot_no", "n").collect())

    wh.overwrite("block_hash", spark.createDataFrame([(*r, 1) for r in rows], schema), "epoch_no")
    before = {(x.part, x.bucket): x.load for x in wh.state("block_hash").leaves}
    after, held = merge([(2, 16), (2, 21)], 2, 16)
    assert held == [(0, 1, 1), (0, 9, 1), (1, 10, 1), (1, 15, 1), (2, 12, 1), (2, 16, 2), (2, 21, 2)]
    assert after[("0", 0)] == before[("0", 0)] and after[("1", 0)] == before[("1", 0)]
    assert after[("2", 0)] != before[("2", 0)] and ("11", 1) not in after
    _, held = merge([], 3, 50)  # beyond all: nothing changes
    assert len(held) == 7
    _, held = merge([(1, 10)], 4, 10)
    assert held == [(0, 1, 1), (0, 9, 1), (1, 10, 4)]


def test_a_written_source_may_lack_columns_that_nothing_reads(spark, tmp_path):
    plain = StandIn(spark, SF)
    cat = MaterializedCatalog(plain, str(tmp_path), {"tx_out": ["tx_id"], "tx_in": ["tx_in_id"]})
    assert cat["tx_out"].columns == ["tx_id"] and "Window" not in _plan(cat.src["tx_out"].select("tx_id"))
    for name, key in (("tx_out", "tx_id"), ("tx_in", "tx_in_id")):
        assert cat[name].exceptAll(plain[name].select(key)).isEmpty() and plain[name].select(key).exceptAll(cat[name]).isEmpty()
