"""Target table schemas and their enforcement (S-02).

Fixed values: the declared target schemas, written as Spark DDL. INTEGER is
BIGINT, NUMERIC / DECIMAL is DECIMAL(38,9), BYTES is BINARY (base64 text on
the wire), JSON is canonical JSON text, DATETIME is TIMESTAMP_NTZ; REQUIRED is
NOT NULL. ``block`` has no schema file upstream; it follows its view.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_DDL: dict[str, str] = {
    "ada_pots": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, treasury DECIMAL(38,9) NOT NULL, reserves "
        "DECIMAL(38,9) NOT NULL, rewards DECIMAL(38,9) NOT NULL, utxo DECIMAL(38,9) NOT NULL, deposits "
        "DECIMAL(38,9) NOT NULL, fees DECIMAL(38,9) NOT NULL"
    ),
    "block_hash": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT, block_hash STRING NOT NULL"
    ),
    "collateral": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, epoch_no_out BIGINT NOT "
        "NULL, slot_no_out BIGINT NOT NULL, txidx_out BIGINT NOT NULL, tx_out_index BIGINT NOT NULL"
    ),
    "cost_model": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, costs STRING NOT NULL, cost_model_hash STRING NOT "
        "NULL"
    ),
    "datum": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, datum_hash STRING NOT "
        "NULL, bytes BINARY NOT NULL, value STRING NOT NULL"
    ),
    "delegation": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, delegations STRING NOT NULL"
    ),
    "epoch_param": (
        "epoch_no BIGINT NOT NULL, min_fee_a BIGINT NOT NULL, min_fee_b BIGINT NOT NULL, max_block_size "
        "BIGINT NOT NULL, max_tx_size BIGINT NOT NULL, max_bh_size BIGINT NOT NULL, key_deposit BIGINT NOT "
        "NULL, pool_deposit BIGINT NOT NULL, max_epoch BIGINT NOT NULL, optimal_pool_count BIGINT NOT NULL, "
        "influence DECIMAL(38,9) NOT NULL, monetary_expand_rate DECIMAL(38,9) NOT NULL, treasury_growth_rate "
        "DECIMAL(38,9) NOT NULL, decentralisation DECIMAL(38,9) NOT NULL, extra_entropy STRING, "
        "protocol_major BIGINT NOT NULL, protocol_minor BIGINT NOT NULL, min_utxo_value BIGINT NOT NULL, "
        "min_pool_cost BIGINT NOT NULL, nonce STRING, coins_per_utxo_size BIGINT, cost_model STRING, "
        "price_mem DECIMAL(38,9), price_step DECIMAL(38,9), max_tx_ex_mem BIGINT, max_tx_ex_steps BIGINT, "
        "max_block_ex_mem BIGINT, max_block_ex_steps BIGINT, max_val_size BIGINT, collateral_percent BIGINT, "
        "max_collateral_inputs BIGINT"
    ),
    "epoch_stake": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, pool_hash STRING NOT NULL, amount "
        "DECIMAL(38,9) NOT NULL"
    ),
    "log_deep_comparison": (
        "epoch_no BIGINT NOT NULL, table_name STRING NOT NULL, start_time TIMESTAMP_NTZ NOT NULL, end_time "
        "TIMESTAMP_NTZ NOT NULL, pg_query STRING NOT NULL, bq_query STRING NOT NULL, pg_hash STRING NOT NULL, "
        "bq_hash STRING NOT NULL"
    ),
    "ma_minting": (
        "fingerprint STRING NOT NULL, policyid STRING NOT NULL, name_bytes BINARY NOT NULL, epoch_no BIGINT "
        "NOT NULL, minting STRING NOT NULL"
    ),
    "meta": (
        "start_time TIMESTAMP_NTZ NOT NULL, network_name STRING NOT NULL, version STRING NOT NULL"
    ),
    "param_proposal": (
        "epoch_no BIGINT NOT NULL, key STRING NOT NULL, min_fee_a BIGINT, min_fee_b BIGINT, max_block_size "
        "BIGINT, max_tx_size BIGINT, max_bh_size BIGINT, key_deposit BIGINT, pool_deposit BIGINT, max_epoch "
        "BIGINT, optimal_pool_count BIGINT, influence DECIMAL(38,9), monetary_expand_rate DECIMAL(38,9), "
        "treasury_growth_rate DECIMAL(38,9), decentralisation DECIMAL(38,9), entropy STRING, protocol_major "
        "BIGINT, protocol_minor BIGINT, min_utxo_value BIGINT, min_pool_cost BIGINT, coins_per_utxo_size "
        "BIGINT, cost_model STRING, price_mem DECIMAL(38,9), price_step DECIMAL(38,9), max_tx_ex_mem BIGINT, "
        "max_tx_ex_steps BIGINT, max_block_ex_mem BIGINT, max_block_ex_steps BIGINT, max_val_size BIGINT, "
        "collateral_percent BIGINT, max_collateral_inputs BIGINT, registered_tx_slot_no BIGINT NOT NULL, "
        "registered_tx_index BIGINT NOT NULL"
    ),
    "pool_offline_data": (
        "pool_hash STRING NOT NULL, epoch_no BIGINT NOT NULL, ticker_name STRING NOT NULL, json STRING NOT "
        "NULL, metadata_url STRING NOT NULL, metadata_hash STRING NOT NULL, metadata_registered_tx_hash "
        "STRING NOT NULL"
    ),
    "pool_owner": (
        "pool_hash STRING NOT NULL, epoch_no BIGINT NOT NULL, addr_hash STRING NOT NULL, slot_no BIGINT NOT "
        "NULL, txidx BIGINT NOT NULL"
    ),
    "pool_retire": (
        "pool_hash STRING NOT NULL, retiring_epoch BIGINT NOT NULL, epoch_no BIGINT NOT NULL, cert_index "
        "BIGINT NOT NULL, announced_tx_hash STRING NOT NULL, slot_no BIGINT NOT NULL, announced_txidx BIGINT "
        "NOT NULL"
    ),
    "pool_update": (
        "active_epoch_no BIGINT NOT NULL, pool_hash STRING NOT NULL, cert_index BIGINT NOT NULL, vrf_key_hash "
        "STRING NOT NULL, pledge DECIMAL(38,9) NOT NULL, reward_addr STRING NOT NULL, margin DECIMAL(38,9) "
        "NOT NULL, fixed_cost DECIMAL(38,9) NOT NULL, registered_tx_hash STRING NOT NULL, epoch_no BIGINT NOT "
        "NULL, metadata_url STRING, metadata_hash STRING, metadata_registered_tx_hash STRING"
    ),
    "redeemer": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, count BIGINT NOT NULL, "
        "redeemers STRING NOT NULL"
    ),
    "rel_addr_txout": (
        "epoch_no BIGINT NOT NULL, address STRING NOT NULL, address_has_script BOOLEAN NOT NULL, payment_cred "
        "STRING, data_hash STRING, inline_datum STRING, reference_script STRING, outputs STRING NOT NULL"
    ),
    "rel_stake_hash": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, stake_address STRING NOT NULL, stake_addr_hash "
        "STRING NOT NULL"
    ),
    "rel_stake_txout": (
        "epoch_no BIGINT NOT NULL, address STRING NOT NULL, outputs STRING NOT NULL"
    ),
    "reward": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, type STRING NOT NULL, amount "
        "DECIMAL(38,9) NOT NULL, earned_epoch BIGINT NOT NULL, pool_hash STRING"
    ),
    "schema_version": (
        "stage_one BIGINT NOT NULL, stage_two BIGINT NOT NULL, stage_three BIGINT NOT NULL"
    ),
    "script": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, script_hash STRING NOT "
        "NULL, type STRING NOT NULL, json STRING, bytes BINARY, serialised_size BIGINT"
    ),
    "stake_deregistration": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, cert_index BIGINT NOT NULL, slot_no "
        "BIGINT NOT NULL, txidx BIGINT NOT NULL"
    ),
    "stake_registration": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, cert_index BIGINT NOT NULL, slot_no "
        "BIGINT NOT NULL, txidx BIGINT NOT NULL"
    ),
    "tx": (
        "epoch_no BIGINT NOT NULL, tx_hash STRING NOT NULL, block_time TIMESTAMP_NTZ NOT NULL, slot_no BIGINT "
        "NOT NULL, txidx BIGINT NOT NULL, out_sum DECIMAL(38,9) NOT NULL, fee DECIMAL(38,9) NOT NULL, deposit "
        "DECIMAL(38,9) NOT NULL, size BIGINT NOT NULL, invalid_before DECIMAL(38,9), invalid_after "
        "DECIMAL(38,9), valid_script BOOLEAN NOT NULL, script_size BIGINT NOT NULL, count_inputs BIGINT NOT "
        "NULL, count_outputs BIGINT NOT NULL"
    ),
    "tx_consumed_output": (
        "slot_no BIGINT, txidx BIGINT NOT NULL, index BIGINT NOT NULL, consumed_in_slot_no BIGINT NOT NULL, "
        "consumed_in_txidx BIGINT NOT NULL"
    ),
    "tx_hash": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, tx_hash STRING NOT NULL"
    ),
    "tx_in_out": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, inputs STRING, outputs "
        "STRING"
    ),
    "tx_metadata": (
        "epoch_no BIGINT NOT NULL, tx_hash STRING NOT NULL, slot_no BIGINT NOT NULL, txidx BIGINT NOT NULL, "
        "metadata STRING NOT NULL"
    ),
    "withdrawal": (
        "epoch_no BIGINT NOT NULL, stake_addr_hash STRING NOT NULL, amount DECIMAL(38,9) NOT NULL, slot_no "
        "BIGINT NOT NULL, txidx BIGINT NOT NULL"
    ),
    "block": (
        "epoch_no BIGINT NOT NULL, slot_no BIGINT NOT NULL, block_time TIMESTAMP_NTZ NOT NULL, "
        "block_size BIGINT NOT NULL, tx_count BIGINT NOT NULL, sum_tx_fee DECIMAL(38,9) NOT NULL, "
        "script_count BIGINT NOT NULL, sum_script_size BIGINT NOT NULL, pool_hash STRING"
    ),
}


def target_schema(table: str) -> T.StructType:
    return T._parse_datatype_string(TARGET_DDL[table])


class SchemaViolation(ValueError):
    """A load that the target schema refuses: column and kind of each problem, with its number of rows."""

    def __init__(self, table: str, problems: dict[tuple[str, str], int | None]):
        self.table, self.problems = table, problems
        super().__init__(f"{table}: " + ", ".join(f"{c} {k}" + (f" ({n} rows)" if n is not None else "") for (c, k), n in sorted(problems.items())))


def watch_schema(df: DataFrame, table: str, hidden: Iterable[str] = ()) -> tuple[DataFrame, Callable[[], dict[tuple[str, str], int | None]]]:
    """``df`` with counters of what its table's schema forbids, and a function that gives the problems once it was written.

    Problems are ``missing`` and ``unknown`` columns, values that don't ``cast`` to the declared type, and ``null`` in NOT NULL
    columns. Values stay in the type they come in. ``hidden`` columns are storage extras.
    """
    schema, have = target_schema(table), set(df.columns) - set(hidden)
    static = {(f.name, "missing"): None for f in schema.fields if f.name not in have} | {(c, "unknown"): None for c in have - set(schema.names)}
    counters: dict[tuple[str, str], Column] = {}
    for f in schema.fields:
        if f.name not in have:
            continue
        source, kind = F.col(f.name), df.schema[f.name].dataType
        if kind != f.dataType:
            binary = isinstance(f.dataType, T.BinaryType) and isinstance(kind, T.StringType)
            cast = F.try_to_binary(source, F.lit("base64")) if binary else source.try_cast(f.dataType)
            counters[f.name, "cast"] = F.count_if(source.isNotNull() & cast.isNull())
        if not f.nullable:
            counters[f.name, "null"] = F.count_if(source.isNull())
    if not counters:
        return df, lambda: static
    names, obs = list(counters), Observation(f"{table}-schema-{uuid.uuid4().hex[:8]}")
    watched = df.observe(obs, *[counters[n].alias(f"c{i}") for i, n in enumerate(names)])

    def problems() -> dict[tuple[str, str], int | None]:
        found = observed(obs)
        return static | {n: found[f"c{i}"] for i, n in enumerate(names) if found.get(f"c{i}")}

    return watched, problems


def observed(obs: Observation) -> dict:
    """What a write observed. Where the adaptive plan found no rows it leaves the observing node out; then nothing."""
    try:
        return obs.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "AssertionError":
            return {}
        raise


def enforce_schema(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Cast ``df`` to the target schema in declared order and report violations.

    Returns ``(typed, violations)``; ``violations`` has one row per problem kind
    and column: ``missing`` / ``unknown`` columns, values that do not ``cast``,
    and ``null`` in a NOT NULL column (``n_bad`` rows each), all counted in one
    aggregation pass. Spark's Parquet writer does not enforce NOT NULL; ``watch_schema``
    counts the same in the pass that writes a load.
    """
    schema = target_schema(table)
    have = set(df.columns)
    typed_cols, checks = [], []
    for f in schema.fields:
        if f.name not in have:
            typed_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if isinstance(f.dataType, T.BinaryType) and isinstance(df.schema[f.name].dataType, T.StringType):
            out = F.try_to_binary(src, F.lit("base64"))
        elif df.schema[f.name].dataType == f.dataType:
            out = src
        else:
            out = src.try_cast(f.dataType)
        typed_cols.append(out.alias(f.name))
        checks.append((f.name, "cast", F.count_if(src.isNotNull() & out.isNull())))
        if not f.nullable:
            checks.append((f.name, "null", F.count_if(src.isNull())))
    typed = df.select(*typed_cols)
    spark = df.sparkSession
    static = [(table, f.name, "missing", None) for f in schema.fields if f.name not in have]
    static += [(table, c, "unknown", None) for c in df.columns if c not in schema.fieldNames()]
    rows_schema = "table STRING, column STRING, kind STRING, n_bad BIGINT"
    counted = df.agg(*[c.alias(f"{i}") for i, (_, _, c) in enumerate(checks)]) if checks else None
    parts = []
    if counted is not None:
        stack = ", ".join(f"'{n}', '{k}', `{i}`" for i, (n, k, _) in enumerate(checks))
        parts.append(counted.selectExpr(f"stack({len(checks)}, {stack}) AS (column, kind, n_bad)")
                     .select(F.lit(table).alias("table"), "column", "kind", "n_bad")
                     .where(F.col("n_bad") > 0))
    if static:
        parts.append(spark.createDataFrame(static, rows_schema))
    violations = parts[0] if parts else spark.createDataFrame([], rows_schema)
    for p in parts[1:]:
        violations = violations.unionByName(p)
    return typed, violations
