from pyspark.sql import functions as F

from utxolake.operators.derive import DERIVE
from utxolake.operators.fingerprint import SPECS, fingerprint_compare, fingerprint_table, row_diff


def test_fingerprint_changes_iff_a_cell_changes(spark, src):
    tx = DERIVE["tx"](src)
    epoch = tx.agg(F.min("epoch_no")).first()[0]
    changed = tx.withColumn("fee", F.when((F.col("epoch_no") == epoch) & (F.col("txidx") == 0),
                                          F.col("fee") + 1).otherwise(F.col("fee")))
    cmp = fingerprint_compare(fingerprint_table("tx", tx), fingerprint_table("tx", changed), ["epoch_no"])
    status = {r["epoch_no"]: r["status"] for r in cmp.collect()}
    assert status[epoch] == "differ"
    assert all(s == "equal" for e, s in status.items() if e != epoch)
    assert row_diff(tx, changed).groupBy("side").count().count() == 2


def test_fingerprint_independent_of_partitioning(spark, src):
    tx = DERIVE["tx_hash"](src)
    a = fingerprint_table("tx_hash", tx.repartition(7)).orderBy("epoch_no").collect()
    b = fingerprint_table("tx_hash", tx.repartition(2, "slot_no")).orderBy("epoch_no").collect()
    assert a == b


def test_bucketed_fingerprint_is_stable(spark, src):
    tx = DERIVE["tx"](src)
    a = fingerprint_table("tx", tx.repartition(5), buckets=4).orderBy("epoch_no").collect()
    b = fingerprint_table("tx", tx.repartition(3), buckets=4).orderBy("epoch_no").collect()
    assert a == b
    assert sum(r["n_rows"] for r in a) == tx.count()


def test_compat_mode_drops_null_rows(spark, src):
    tx = DERIVE["tx"](src).withColumn("fee", F.when(F.col("txidx") == 0, F.lit(None)).otherwise(F.col("fee")))
    full = sum(r["n_rows"] for r in fingerprint_table("tx", tx).collect())
    compat = sum(r["n_rows"] for r in fingerprint_table("tx", tx, compat=True).collect())
    assert compat == full - tx.where("txidx = 0").count()


def test_every_table_has_a_spec():
    assert set(SPECS) == set(DERIVE)


def test_multiset_fingerprint(spark, src):
    tx = DERIVE["tx"](src)
    a = fingerprint_table("tx", tx.repartition(5), mode="multiset").orderBy("epoch_no").collect()
    b = fingerprint_table("tx", tx.repartition(2, "slot_no"), mode="multiset").orderBy("epoch_no").collect()
    assert a == b and sum(r["n_rows"] for r in a) == tx.count()
    epoch = a[0]["epoch_no"]
    changed = tx.withColumn("fee", F.when((F.col("epoch_no") == epoch) & (F.col("txidx") == 0),
                                          F.col("fee") + 1).otherwise(F.col("fee")))
    c = {r["epoch_no"]: r["hash_b64"] for r in fingerprint_table("tx", changed, mode="multiset").collect()}
    assert c[epoch] != a[0]["hash_b64"]
    assert all(c[r["epoch_no"]] == r["hash_b64"] for r in a[1:])
    one = fingerprint_table("meta", DERIVE["meta"](src), mode="multiset").collect()
    assert len(one) == 1 and len(one[0]["hash_b64"]) == 44
