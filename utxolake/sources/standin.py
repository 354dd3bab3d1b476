"""Stand-in source relations computed from the driver's TPC-H-like tables.

The real source is a normalized chain database (``block``, ``tx``, ``tx_out`` ...).
For tests and the bench every such relation is computed from the tables in an
``sf`` folder (orders -> transactions, lineitem -> outputs, customer -> stake
addresses, supplier -> pools, part -> assets / scripts / datums, events ->
metadata, nation -> cost models). Each rule is written once and rendered in two
dialects: Spark SQL (evaluated lazily, Catalyst plans it together with the
derivation that reads it) and DuckDB (the CTE prefix of the oracle SQL).

Hash columns are BINARY in Spark (``unhex(sha2(..))``) and lower-case hex text
in DuckDB, so the oracle may use them as they are where the derivation prints
``lower(hex(..))``. ``bytes`` / ``name`` are BINARY in Spark and text in DuckDB.
"""

from __future__ import annotations

import itertools
import re
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ordinal import ordinals, with_position

SPARK, DUCK = "spark", "duck"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class _D:
    """Dialect-specific spelling of the three rule primitives."""

    def __init__(self, dialect: str):
        self.d = dialect

    def sha(self, x: str) -> str:
        return f"unhex(sha2({x}, 256))" if self.d == SPARK else f"sha256({x})"

    def days(self, ts: str) -> str:
        if self.d == SPARK:
            return f"CAST(datediff(CAST({ts} AS DATE), DATE'1995-01-01') AS BIGINT)"
        return f"CAST(datediff('day', TIMESTAMP '1995-01-01', {ts}) AS BIGINT)"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.d == SPARK else f"(({a}) // ({b}))"

    def blob(self, x: str) -> str:
        return f"CAST({x} AS BINARY)" if self.d == SPARK else x

    def q(self, name: str) -> str:
        return f"`{name}`" if self.d == SPARK else f'"{name}"'


# Protocol parameter columns that the stand-in does not fill (NULL, typed).
# The parameter names of the epoch_param / param_proposal views.
PARAM_COLUMNS = [
    ("min_fee_a", "BIGINT"), ("min_fee_b", "BIGINT"), ("max_block_size", "BIGINT"),
    ("max_tx_size", "BIGINT"), ("max_bh_size", "BIGINT"), ("key_deposit", "BIGINT"),
    ("pool_deposit", "BIGINT"), ("max_epoch", "BIGINT"), ("optimal_pool_count", "BIGINT"),
    ("influence", "DOUBLE"), ("monetary_expand_rate", "DOUBLE"), ("treasury_growth_rate", "DOUBLE"),
    ("decentralisation", "DOUBLE"), ("protocol_major", "BIGINT"), ("protocol_minor", "BIGINT"),
    ("min_utxo_value", "BIGINT"), ("min_pool_cost", "BIGINT"), ("coins_per_utxo_size", "BIGINT"),
    ("price_mem", "DOUBLE"), ("price_step", "DOUBLE"), ("max_tx_ex_mem", "BIGINT"),
    ("max_tx_ex_steps", "BIGINT"), ("max_block_ex_mem", "BIGINT"), ("max_block_ex_steps", "BIGINT"),
    ("max_val_size", "BIGINT"), ("collateral_percent", "BIGINT"), ("max_collateral_inputs", "BIGINT"),
]


def _params(filled: dict[str, str], entropy_col: str, d: _D) -> str:
    cols = []
    for name, typ in PARAM_COLUMNS:
        cols.append(f"{filled[name]} AS {name}" if name in filled else f"CAST(NULL AS {typ}) AS {name}")
    blob_null = "CAST(NULL AS BINARY)" if d.d == SPARK else "CAST(NULL AS VARCHAR)"
    cols.append(f"{blob_null} AS {entropy_col}")
    return ", ".join(cols)


def _rules(d: _D) -> dict[str, tuple[tuple[str, ...], str]]:
    """name -> (dependencies, SELECT text). ``tx_in`` has a Spark-side builder."""
    S, DAYS, DIV, B, Q = d.sha, d.days, d.div, d.blob, d.q
    n_supp = "(SELECT count(*) FROM supplier)"
    n_ord = "(SELECT count(*) FROM orders)"
    return {
        "txx": (("orders",), f"""
            SELECT CAST(o_orderkey AS BIGINT) AS id, {DAYS('o_orderdate')} AS slot,
                   CAST(o_custkey AS BIGINT) AS ck, o_orderstatus AS st, o_orderpriority AS pr,
                   CAST(round(o_totalprice * 100) AS BIGINT) AS lov,
                   CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS BIGINT) AS bidx
            FROM orders"""),
        "block": (("orders", "lineitem", "txx"), f"""
            SELECT d.slot AS id, d.slot AS slot_no, {DIV('d.slot', '30')} AS epoch_no, d.ts AS time,
                   coalesce(c.n, 0) AS tx_count, 500 + coalesce(c.n, 0) * 300 AS size,
                   {S("concat('block', CAST(d.slot AS VARCHAR(20)))")} AS hash, d.slot % 10 AS slot_leader_id
            FROM (SELECT DISTINCT {DAYS('ts')} AS slot, ts
                  FROM (SELECT o_orderdate AS ts FROM orders UNION SELECT l_shipdate AS ts FROM lineitem) u) d
            LEFT JOIN (SELECT slot, count(*) AS n FROM txx GROUP BY slot) c ON c.slot = d.slot"""),
        "tx": (("txx",), f"""
            SELECT id, {S("concat('tx', CAST(id AS VARCHAR(20)))")} AS hash, slot AS block_id, bidx AS block_index,
                   lov AS out_sum, 155381 + lov % 99991 AS fee,
                   CAST(CASE WHEN id % 17 = 0 THEN 2000000 WHEN id % 19 = 0 THEN -2000000 ELSE 0 END AS INT) AS deposit,
                   200 + id % 15000 AS size,
                   CASE WHEN pr = '5-LOW' THEN slot END AS invalid_before,
                   CASE WHEN pr IN ('5-LOW', '2-HIGH') THEN slot + 7200 END AS invalid_hereafter,
                   (st <> 'P' OR id % 3 <> 0) AS valid_contract,
                   CASE WHEN pr = '1-URGENT' THEN 1 + id % 4000 ELSE 0 END AS script_size
            FROM txx"""),
        "tx_out": (("lineitem",), f"""
            SELECT l_orderkey * 100 + rn AS id, l_orderkey AS tx_id, rn AS {Q('index')},
                   CASE WHEN l_suppkey % 4 = 0 THEN concat('addr1q', CAST(l_suppkey AS VARCHAR(20)))
                        ELSE concat('Addr1W', CAST(l_suppkey AS VARCHAR(20))) END AS address,
                   (l_suppkey % 4 = 0) AS address_has_script,
                   CASE WHEN l_suppkey % 5 <> 0 THEN {S("concat('cred', CAST(l_suppkey AS VARCHAR(20)))")} END AS payment_cred,
                   CASE WHEN l_returnflag = 'A' THEN l_partkey END AS stake_address_id,
                   CAST(round(l_extendedprice * 100) AS BIGINT) AS value,
                   CASE WHEN l_returnflag = 'R' AND l_suppkey % 2 = 0
                        THEN {S("concat('datum', CAST(l_partkey AS VARCHAR(20)))")} END AS data_hash,
                   CASE WHEN l_returnflag = 'R' THEN l_partkey END AS inline_datum_id,
                   CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN l_partkey END AS reference_script_id,
                   l_partkey AS pk, l_quantity AS qty
            FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                         l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS BIGINT) AS rn
                  FROM lineitem) x"""),
        "tx_in": (("tx_out",), f"""
            SELECT a.tx_id * 100 + a.{Q('index')} AS id, a.tx_id AS tx_in_id, b.tx_id AS tx_out_id,
                   b.{Q('index')} AS tx_out_index
            FROM (SELECT *, row_number() OVER (ORDER BY tx_id, {Q('index')}) AS g FROM tx_out) a
            JOIN (SELECT *, row_number() OVER (ORDER BY tx_id, {Q('index')}) AS g FROM tx_out) b ON a.g = b.g + 7
            WHERE a.tx_id > b.tx_id"""),
        "collateral_tx_in": (("tx_in",), """
            SELECT id, tx_in_id, tx_out_id, tx_out_index FROM tx_in WHERE id % 11 = 0"""),
        "stake_address": (("customer",), f"""
            SELECT c_custkey AS id, {S("concat('stake', CAST(c_custkey AS VARCHAR(20)))")} AS hash_raw,
                   concat('stake1u', CAST(c_custkey AS VARCHAR(20))) AS {Q('view')}
            FROM customer"""),
        "pool_hash": (("supplier",), f"""
            SELECT s_suppkey AS id, {S("concat('pool', CAST(s_suppkey AS VARCHAR(20)))")} AS hash_raw FROM supplier"""),
        "slot_leader": (("supplier",), """
            SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS pool_hash_id FROM supplier"""),
        "delegation": (("txx", "supplier"), f"""
            SELECT id, ck AS addr_id, id % {n_supp} AS pool_hash_id, id AS tx_id,
                   {DIV('slot', '30')} + 2 AS active_epoch_no, id % 3 AS cert_index, slot AS slot_no
            FROM txx WHERE st = 'F'"""),
        "multi_asset": (("part",), f"""
            SELECT p_partkey AS id, {S('p_brand')} AS policy, {B('p_name')} AS name,
                   concat('asset1', CAST(p_partkey AS VARCHAR(20))) AS fingerprint
            FROM part"""),
        "ma_tx_out": (("tx_out",), f"""
            SELECT id * 10 AS id, pk AS ident, CAST(qty AS BIGINT) AS quantity, id AS tx_out_id
            FROM tx_out WHERE pk % 3 = 0
            UNION ALL
            SELECT id * 10 + 1, {DIV('pk', '2')}, CAST(1 AS BIGINT), id FROM tx_out WHERE pk % 6 = 0"""),
        "ma_tx_mint": (("tx_out",), """
            SELECT id, pk AS ident,
                   CASE WHEN qty < 10 THEN -CAST(qty AS BIGINT) ELSE CAST(qty AS BIGINT) END AS quantity, tx_id
            FROM tx_out WHERE pk % 4 = 1"""),
        "tx_metadata": (("events", "orders"), f"""
            SELECT event_id AS id, event_id % {n_ord} AS tx_id, 674 + event_id % 5 AS {Q('key')}, props AS json
            FROM events"""),
        "reward": (("txx", "supplier"), f"""
            SELECT id, ck AS addr_id,
                   CASE id % 4 WHEN 0 THEN 'member' WHEN 1 THEN 'leader' WHEN 2 THEN 'treasury' ELSE 'reserves' END AS type,
                   lov % 1000003 AS amount, {DIV('slot', '30')} AS earned_epoch,
                   {DIV('slot', '30')} + 2 AS spendable_epoch,
                   CASE WHEN id % 4 < 2 THEN id % {n_supp} END AS pool_id
            FROM txx"""),
        "datum": (("part", "orders"), f"""
            SELECT p_partkey AS id, {S("concat('datum', CAST(p_partkey AS VARCHAR(20)))")} AS hash,
                   p_partkey * 3 % {n_ord} AS tx_id, {B("concat('d', p_name, p_type)")} AS bytes,
                   concat('{{"int":', CAST(p_size AS VARCHAR(20)), ',"a":"', p_brand, '"}}') AS value
            FROM part WHERE p_partkey % 2 = 0"""),
        "script": (("part", "orders"), f"""
            SELECT p_partkey AS id, {S("concat('script', CAST(p_partkey AS VARCHAR(20)))")} AS hash,
                   p_partkey * 7 % {n_ord} AS tx_id,
                   CASE p_partkey % 3 WHEN 0 THEN 'timelock' WHEN 1 THEN 'plutusV1' ELSE 'plutusV2' END AS type,
                   CASE WHEN p_partkey % 3 = 0 THEN concat('{{"type":"sig","keyHash":"', p_brand, '"}}') END AS json,
                   CASE WHEN p_partkey % 3 <> 0 THEN {B("concat('plutus', p_name, p_type)")} END AS bytes,
                   CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size * 100 END AS INT) AS serialised_size
            FROM part WHERE p_partkey % 3 <> 1 OR p_size > 10"""),
        "redeemer_data": (("datum",), """SELECT id, hash, bytes, value FROM datum"""),
        "redeemer": (("tx_out",), f"""
            SELECT id, tx_id, pk - pk % 2 AS redeemer_data_id, pk % 900 AS unit_mem, pk * 11 AS unit_steps,
                   value % 997 AS fee, {Q('index')}, CASE WHEN pk % 2 = 0 THEN 'spend' ELSE 'mint' END AS purpose,
                   {S("concat('script', CAST(pk AS VARCHAR(20)))")} AS script_hash
            FROM tx_out WHERE id % 5 = 0"""),
        "stake_registration": (("txx",), f"""
            SELECT id, ck AS addr_id, id % 4 AS cert_index, {DIV('slot', '30')} AS epoch_no, id AS tx_id
            FROM txx WHERE id % 6 = 1"""),
        "stake_deregistration": (("txx",), f"""
            SELECT id, ck AS addr_id, id % 4 AS cert_index, {DIV('slot', '30')} AS epoch_no, id AS tx_id
            FROM txx WHERE id % 12 = 2"""),
        "withdrawal": (("txx",), """
            SELECT id, ck AS addr_id, lov % 777777 AS amount, id AS tx_id FROM txx WHERE st = 'O'"""),
        "epoch_stake": (("txx", "supplier"), f"""
            SELECT max(id) AS id, ck AS addr_id, max(id) % {n_supp} AS pool_id,
                   CAST(sum(lov) AS DECIMAL(38, 0)) AS amount, {DIV('slot', '30')} AS epoch_no
            FROM txx GROUP BY ck, {DIV('slot', '30')}"""),
        "pool_metadata_ref": (("supplier",), f"""
            SELECT s_suppkey AS id, s_suppkey AS pool_id,
                   concat('https://pool.example/', CAST(s_suppkey AS VARCHAR(20))) AS url,
                   {S("concat('pmr', CAST(s_suppkey AS VARCHAR(20)))")} AS hash, s_suppkey * 13 AS registered_tx_id
            FROM supplier WHERE s_suppkey % 7 <> 0"""),
        "pool_update": (("txx", "supplier"), f"""
            SELECT id, id % {n_supp} AS hash_id, id % 2 AS cert_index,
                   {S("concat('vrf', CAST(id AS VARCHAR(20)))")} AS vrf_key_hash, lov AS pledge,
                   ck AS reward_addr_id, CASE WHEN id % 7 = 0 THEN NULL ELSE id % {n_supp} END AS meta_id,
                   CAST(id % 100 AS DOUBLE) / 400 AS margin, CAST(340000000 AS INT) AS fixed_cost,
                   id AS registered_tx_id, {DIV('slot', '30')} + 2 AS active_epoch_no
            FROM txx WHERE id % 10 = 3"""),
        "pool_retire": (("txx", "supplier"), f"""
            SELECT id, id % {n_supp} AS hash_id, CAST(0 AS INT) AS cert_index, id AS announced_tx_id,
                   {DIV('slot', '30')} + 3 AS retiring_epoch
            FROM txx WHERE id % 50 = 7"""),
        "pool_owner": (("pool_update",), f"""
            SELECT id, reward_addr_id AS addr_id, id AS pool_update_id FROM pool_update
            UNION ALL
            SELECT id + 1000000, {DIV('reward_addr_id', '2')} + 1, id FROM pool_update WHERE id % 20 = 3"""),
        "pool_offline_data": (("supplier",), """
            SELECT s_suppkey AS id, s_suppkey AS pool_id, concat('T', CAST(s_suppkey AS VARCHAR(20))) AS ticker_name,
                   concat('{"ticker":"T', CAST(s_suppkey AS VARCHAR(20)), '","name":"', s_name, '","homepage":"h',
                          CAST(s_suppkey AS VARCHAR(20)), '","extra":1}') AS json,
                   CASE WHEN s_suppkey % 9 <> 0 THEN s_suppkey END AS pmr_id
            FROM supplier"""),
        "cost_model": (("nation",), f"""
            SELECT CAST(n_nationkey AS INT) AS id,
                   concat('{{"PlutusV1":{{"b":', CAST(n_regionkey AS VARCHAR(20)), ',"a":1}}}}') AS costs,
                   {S('n_name')} AS hash
            FROM nation"""),
        "epoch_param": (("block",), f"""
            SELECT e AS epoch_no, {_params({
                "min_fee_a": "CAST(44 AS BIGINT)", "min_fee_b": "CAST(155381 AS BIGINT)",
                "max_block_size": "65536 + e", "decentralisation": "CAST(e % 10 AS DOUBLE) / 10"}, "extra_entropy", d)},
                   CASE WHEN e % 3 = 0 THEN {S("concat('nonce', CAST(e AS VARCHAR(20)))")} END AS nonce,
                   CASE WHEN e % 4 = 0 THEN e % 25 END AS cost_model_id
            FROM (SELECT DISTINCT epoch_no AS e FROM block) x"""),
        "param_proposal": (("txx",), f"""
            SELECT id, {DIV('slot', '30')} AS epoch_no, {S("concat('gen', CAST(id % 7 AS VARCHAR(20)))")} AS {Q('key')},
                   {_params({"min_fee_a": "CASE WHEN id % 2 = 0 THEN id % 100 END"}, "entropy", d)},
                   CASE WHEN id % 5 = 0 THEN id % 25 END AS cost_model_id, id AS registered_tx_id
            FROM txx WHERE id % 101 = 0"""),
        "ada_pots": (("tx", "block"), """
            SELECT b.epoch_no, min(b.slot_no) AS slot_no, CAST(NULL AS BIGINT) AS treasury,
                   CAST(NULL AS BIGINT) AS reserves, CAST(NULL AS BIGINT) AS rewards,
                   CAST(sum(t.out_sum) AS BIGINT) AS utxo, CAST(sum(t.deposit) AS BIGINT) AS deposits,
                   CAST(sum(t.fee) AS BIGINT) AS fees
            FROM tx t JOIN block b ON b.id = t.block_id GROUP BY b.epoch_no"""),
        # Single-row tables, derived from the data so that they follow the input.
        "meta": (("block",), """
            SELECT min(time) AS start_time, 'standin' AS network_name, '1' AS version FROM block"""),
        "schema_version": (("region",), """
            SELECT CAST(min(r_regionkey) + 1 AS BIGINT) AS stage_one, CAST(min(r_regionkey) + 2 AS BIGINT) AS stage_two,
                   CAST(min(r_regionkey) + 3 AS BIGINT) AS stage_three FROM region"""),
    }


SOURCE_NAMES = tuple(k for k in _rules(_D(DUCK)) if k != "txx")


def _closure(names: list[str], rules) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in BASE_TABLES:
            return
        for dep in rules[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duck_with(names: list[str]) -> str:
    """``WITH`` prefix defining the named stand-ins (and what they need) for DuckDB."""
    rules = _rules(_D(DUCK))
    parts = [f"{n} AS ({rules[n][1].strip()})" for n in _closure(list(names), rules)]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


_SEQ = itertools.count()
#: Inputs spend the output so many places before; transactions per bucket in which that is looked up.
_BACK, _TX_BUCKET = 7, 1 << 14
_FROM_JOIN = re.compile(r"\b(FROM|JOIN)\s+([a-z_]+)\b")


class StandIn:
    """Lazy catalog of stand-in relations for one ``sf`` folder (``src[name]``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._rules = _rules(_D(SPARK))
        self._cache: dict[str, DataFrame] = {}
        self.builders: dict[str, Callable[[], DataFrame]] = {"tx_in": self._tx_in}
        self._tag = f"_standin{next(_SEQ)}"
        self._lock = threading.RLock()
        self.written: Mapping[str, DataFrame] | None = None

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._cache:
                self._cache[name] = self._build(name)
            return self._cache[name]

    def __contains__(self, name: str) -> bool:
        return name in self._rules

    def keys(self):
        return [k for k in self._rules if k != "txx"]

    def over(self, written: Mapping[str, DataFrame]) -> StandIn:
        """The same catalog, which derives relations from those of ``written`` (its own, written once), not from the tables
        again."""
        out = StandIn(self.spark, self.sf_dir)
        out.written = written
        return out

    def _dep(self, name: str) -> DataFrame:
        return self[name] if self.written is None or name not in SOURCE_NAMES else self.written[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name in self.builders:
            return self.builders[name]()
        deps, sql = self._rules[name]
        # Inputs become session views under names private to this catalog; the
        # query is analyzed at once, so the views can be replaced later.
        for dep in deps:
            self._dep(dep).createOrReplaceTempView(f"{self._tag}_{dep}")
        sql = _FROM_JOIN.sub(
            lambda m: f"{m.group(1)} {self._tag}_{m.group(2)}" if m.group(2) in deps else m.group(0), sql)
        return self.spark.sql(sql)

    def _tx_in(self) -> DataFrame:
        # a.g = b.g + 7 over the global (tx_id, index) order. The indexes of a transaction count from 0, so the order
        # follows from how many outputs each has: one row per transaction is ordered, not one per output.
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        per_tx = self._dep("tx_out").groupBy("tx_id").agg(F.count(F.lit(1)).alias("n"))
        # one reliable checkpoint (shared checkpoint dir), so that ordinals and offsets see the same ranges
        ranged = with_position(per_tx.repartitionByRange("tx_id").sortWithinPartitions("tx_id")).checkpoint(eager=True)
        own = F.expr(f"t div {_TX_BUCKET}")
        # each bucket also gets the last transactions of the one before it, which hold the outputs it looks back to
        ahead = F.when(F.col("t") % _TX_BUCKET >= _TX_BUCKET - _BACK, F.array(own, own + 1)).otherwise(F.array(own))
        # only the first outputs of a transaction look back to another one, and only its last are looked back to
        n, zero = F.col("n"), F.lit(0).cast("bigint")
        ends = F.when(n <= 2 * _BACK, F.sequence(zero, n - 1)).otherwise(
            F.concat(F.sequence(zero, zero + (_BACK - 1)), F.sequence(n - _BACK, n - 1)))
        order = Window.partitionBy("_bucket").orderBy("t", "index")
        return (
            ordinals(ranged, "t")
            .select("tx_id", "n", "t", F.explode(ahead).alias("_bucket"))
            .repartition("_bucket")
            .select("tx_id", "t", "_bucket", F.explode(ends).alias("index"))
            .withColumn("tx_out_id", F.lag("tx_id", _BACK).over(order))
            .withColumn("tx_out_index", F.lag("index", _BACK).over(order))
            .where((F.col("_bucket") == own) & (F.col("tx_id") > F.col("tx_out_id")))
            .select((F.col("tx_id") * 100 + F.col("index")).alias("id"), F.col("tx_id").alias("tx_in_id"),
                    "tx_out_id", "tx_out_index")
        )
