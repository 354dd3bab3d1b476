"""Row text, row hashes and per-epoch table fingerprints: V-01 ... V-09.

row text     ``'(' || c1 || ',' || c2 ... || ')'``                       (V-01)
row hash     ``base64(sha256(row text))``                                 (V-02)
fingerprint  ``base64(sha256(listagg(row hash, ',') ordered by the sort
             keys))`` per epoch (and shard)                               (V-03, V-05)

With ``compat=True`` only the configured columns are NULL-coalesced, so a NULL
elsewhere makes the row text NULL and the row silently drops out, as in the
reference; the default coalesces every column (SURVEY Q11). Doubles are hashed
as fixed-point decimals (trailing zeros trimmed), never in float notation.

``buckets=n`` computes a two-level fingerprint for epochs too large for one
task: rows go to ``n`` buckets by their hash, each bucket is digested in hash
order, the epoch digest is the hash over the bucket digests. Both copies must
use the same ``n``; the result is then independent of partitioning.

``mode="multiset"`` needs no list at all: each row's sha256 is read as ten
24-bit parts and one of 16, and the parts are summed per group, each modulo its
width (an additive multiset hash). It is a plain ``sum`` with map-side combine, so no task holds
more than one partial sum per group, whatever the skew; any changed, missing or
extra row changes it except with negligible probability. Both copies must use
the same mode.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encoding import canonical_json, sha256_b64


@dataclass(frozen=True)
class FingerprintSpec:
    columns: list[str]
    nullable: list[str] = field(default_factory=list)  # columns coalesced to 'null' in compat mode
    sort: list[str] = field(default_factory=list)
    by: list[str] = field(default_factory=lambda: ["epoch_no"])
    json: list[str] = field(default_factory=list)  # hashed in canonical JSON form (V-07)
    upper: list[str] = field(default_factory=list)  # sort keys compared case-insensitively
    first_output: str | None = None  # sort by the first list element's (slot_no, txidx, idx)
    shards: tuple[str, int] | None = None  # (column, n): V-05 sharding


_PP_NN = ["epoch_no", "key", "registered_tx_slot_no", "registered_tx_index"]
_EP = ["epoch_no", "min_fee_a", "min_fee_b", "max_block_size", "max_tx_size", "max_bh_size", "key_deposit",
       "pool_deposit", "max_epoch", "optimal_pool_count", "influence", "monetary_expand_rate",
       "treasury_growth_rate", "decentralisation", "extra_entropy", "protocol_major", "protocol_minor",
       "min_utxo_value", "min_pool_cost", "nonce", "coins_per_utxo_size", "price_mem", "price_step",
       "max_tx_ex_mem", "max_tx_ex_steps", "max_block_ex_mem", "max_block_ex_steps", "max_val_size",
       "collateral_percent", "max_collateral_inputs"]
_PP = ["epoch_no", "key", "min_fee_a", "min_fee_b", "max_block_size", "max_tx_size", "max_bh_size", "key_deposit",
       "pool_deposit", "max_epoch", "optimal_pool_count", "influence", "monetary_expand_rate",
       "treasury_growth_rate", "decentralisation", "entropy", "protocol_major", "protocol_minor",
       "min_utxo_value", "min_pool_cost", "coins_per_utxo_size", "price_mem", "price_step", "max_tx_ex_mem",
       "max_tx_ex_steps", "max_block_ex_mem", "max_block_ex_steps", "max_val_size", "collateral_percent",
       "max_collateral_inputs", "registered_tx_slot_no", "registered_tx_index"]

# Columns hashed per table and their order; datum is ours.
SPECS: dict[str, FingerprintSpec] = {
    "redeemer": FingerprintSpec(["epoch_no", "slot_no", "txidx", "count"], sort=["epoch_no", "slot_no", "txidx"]),
    "script": FingerprintSpec(["epoch_no", "slot_no", "txidx", "script_hash", "type", "bytes", "serialised_size"],
                              nullable=["bytes", "serialised_size"],
                              sort=["epoch_no", "slot_no", "txidx", "script_hash"]),
    "epoch_param": FingerprintSpec(_EP, nullable=_EP[_EP.index("extra_entropy"):], sort=["epoch_no"]),
    "param_proposal": FingerprintSpec(_PP, nullable=[c for c in _PP if c not in _PP_NN],
                                      sort=["epoch_no", "registered_tx_slot_no", "registered_tx_index", "key"]),
    "ada_pots": FingerprintSpec(["epoch_no", "slot_no", "treasury", "reserves", "rewards", "utxo", "deposits",
                                 "fees"], sort=["epoch_no"]),
    "epoch_stake": FingerprintSpec(["epoch_no", "stake_addr_hash", "pool_hash", "amount"],
                                   sort=["epoch_no", "stake_addr_hash", "pool_hash"]),
    "block": FingerprintSpec(["epoch_no", "slot_no", "block_time", "block_size", "tx_count", "sum_tx_fee",
                              "script_count", "sum_script_size"], sort=["epoch_no", "slot_no"]),
    "block_hash": FingerprintSpec(["epoch_no", "slot_no", "block_hash"], sort=["epoch_no", "slot_no"]),
    "stake_registration": FingerprintSpec(["epoch_no", "slot_no", "txidx", "stake_addr_hash", "cert_index"],
                                          sort=["epoch_no", "slot_no", "txidx", "stake_addr_hash", "cert_index"]),
    "stake_deregistration": FingerprintSpec(["epoch_no", "slot_no", "txidx", "stake_addr_hash", "cert_index"],
                                            sort=["epoch_no", "slot_no", "txidx", "stake_addr_hash", "cert_index"]),
    "reward": FingerprintSpec(["epoch_no", "stake_addr_hash", "type", "amount", "earned_epoch", "pool_hash"],
                              sort=["epoch_no", "stake_addr_hash", "type", "pool_hash"]),
    "withdrawal": FingerprintSpec(["epoch_no", "stake_addr_hash", "amount", "slot_no", "txidx"],
                                  sort=["epoch_no", "slot_no", "txidx", "stake_addr_hash"]),
    "delegation": FingerprintSpec(["epoch_no", "stake_addr_hash", "delegations"], json=["delegations"],
                                  sort=["epoch_no", "stake_addr_hash"]),
    "tx": FingerprintSpec(["epoch_no", "tx_hash", "block_time", "slot_no", "txidx", "out_sum", "fee", "deposit",
                           "size", "invalid_before", "invalid_after", "valid_script", "script_size",
                           "count_inputs", "count_outputs"], nullable=["invalid_before", "invalid_after"],
                          sort=["epoch_no", "slot_no", "txidx"]),
    "tx_in_out": FingerprintSpec(["epoch_no", "slot_no", "txidx", "inputs", "outputs"], nullable=["outputs"],
                                 json=["inputs", "outputs"], sort=["epoch_no", "slot_no", "txidx"]),
    "tx_hash": FingerprintSpec(["epoch_no", "slot_no", "txidx", "tx_hash"], sort=["epoch_no", "slot_no", "txidx"]),
    "rel_addr_txout": FingerprintSpec(["epoch_no", "address", "outputs"], json=["outputs"],
                                      sort=["epoch_no", "address"], upper=["address"], first_output="outputs"),
    "rel_stake_txout": FingerprintSpec(["epoch_no", "address", "outputs"], json=["outputs"],
                                       sort=["epoch_no", "address"], upper=["address"], first_output="outputs"),
    "rel_stake_hash": FingerprintSpec(["epoch_no", "slot_no", "stake_address", "stake_addr_hash"],
                                      sort=["epoch_no", "slot_no", "stake_address"]),
    "collateral": FingerprintSpec(["epoch_no", "slot_no", "txidx", "epoch_no_out", "slot_no_out", "txidx_out",
                                   "tx_out_index"],
                                  sort=["epoch_no", "slot_no", "txidx", "epoch_no_out", "slot_no_out", "txidx_out",
                                        "tx_out_index"]),
    "tx_metadata": FingerprintSpec(["epoch_no", "slot_no", "txidx", "tx_hash"],
                                   sort=["epoch_no", "slot_no", "txidx", "tx_hash"]),
    "tx_consumed_output": FingerprintSpec(["slot_no", "txidx", "index", "consumed_in_slot_no", "consumed_in_txidx"],
                                          sort=["slot_no", "txidx", "index"], shards=("consumed_in_slot_no", 4)),
    "ma_minting": FingerprintSpec(["fingerprint", "policyid", "name_bytes", "epoch_no", "minting"],
                                  json=["minting"], sort=["fingerprint"]),
    "pool_offline_data": FingerprintSpec(["pool_hash", "epoch_no", "ticker_name", "json", "metadata_url",
                                          "metadata_hash", "metadata_registered_tx_hash"], json=["json"],
                                         sort=["epoch_no", "pool_hash", "metadata_registered_tx_hash"]),
    "pool_owner": FingerprintSpec(["pool_hash", "epoch_no", "addr_hash", "slot_no", "txidx"],
                                  sort=["epoch_no", "slot_no", "txidx", "pool_hash", "addr_hash"]),
    "pool_retire": FingerprintSpec(["pool_hash", "retiring_epoch", "epoch_no", "cert_index", "announced_tx_hash",
                                    "slot_no", "announced_txidx"],
                                   sort=["epoch_no", "slot_no", "announced_txidx", "pool_hash"]),
    "pool_update": FingerprintSpec(["active_epoch_no", "pool_hash", "cert_index", "vrf_key_hash", "pledge",
                                    "reward_addr", "margin", "fixed_cost", "registered_tx_hash", "epoch_no",
                                    "metadata_url", "metadata_hash", "metadata_registered_tx_hash"],
                                   nullable=["metadata_url", "metadata_hash", "metadata_registered_tx_hash"],
                                   sort=["epoch_no", "pool_hash", "registered_tx_hash", "cert_index"]),
    "meta": FingerprintSpec(["start_time", "network_name", "version"], by=[]),
    "schema_version": FingerprintSpec(["stage_one", "stage_two", "stage_three"], by=[]),
    "datum": FingerprintSpec(["epoch_no", "slot_no", "txidx", "datum_hash", "bytes", "value"], json=["value"],
                             sort=["epoch_no", "slot_no", "txidx", "datum_hash"]),
}


def _fixed_point(c: Column) -> Column:
    """The shortest decimal text that names the double, without exponent or trailing zeros; beyond
    38 digits, the text with its exponent."""
    shortest = c.cast("string")
    plain = shortest.try_cast("decimal(38,20)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(c == 0, "0").when((F.abs(c) < 1e17) & (F.abs(c) >= 1e-4), plain).otherwise(shortest)


def cell_text(df: DataFrame, name: str, spec: FingerprintSpec) -> Column:
    """V-06/V-07: the text of one cell as it goes into the row text."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if name in spec.json:
        return canonical_json(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _fixed_point(c)
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    return c.cast("string")


def row_text(df: DataFrame, spec: FingerprintSpec, compat: bool = False) -> Column:
    """V-01."""
    parts: list[Column] = []
    for i, name in enumerate(spec.columns):
        t = cell_text(df, name, spec)
        if not compat or name in spec.nullable:
            t = F.coalesce(t, F.lit("null"))
        if i:
            parts.append(F.lit(","))
        parts.append(t)
    return F.concat(F.lit("("), *parts, F.lit(")"))


def row_hashes(df: DataFrame, spec: FingerprintSpec, compat: bool = False, digest: bool = False) -> DataFrame:
    """V-02 / V-04: one ``row_hash`` per row, with the grouping and sort columns kept.

    The first list element's keys (``_fo_*``) are read from the same parsed JSON
    as the canonical text, in one projection, so each list is parsed once.
    """
    keep = list(dict.fromkeys([*spec.by, *spec.sort] + ([spec.shards[0]] if spec.shards else [])))
    extra = []
    if spec.first_output:
        v = F.parse_json(spec.first_output)
        extra = [F.try_variant_get(v, f"$[0].{f}", "bigint").alias(f"_fo_{f}") for f in ("slot_no", "txidx", "idx")]
    if digest:  # the hexadecimal digest, for sums of its parts
        return df.select(*keep, F.sha2(row_text(df, spec, compat), 256).alias("row_sha"))
    return df.select(*keep, sha256_b64(row_text(df, spec, compat)).alias("row_hash"), *extra)


def _sort_exprs(spec: FingerprintSpec) -> list[str]:
    keys = [f"upper({k})" if k in spec.upper else k for k in spec.sort]
    if spec.first_output:
        keys += [f"_fo_{f}" for f in ("slot_no", "txidx", "idx")]
    return keys + ["row_hash"]


# Parts of a row's sha256, in hexadecimal digits (ten of 24 bits and one of 16): their BIGINT sums cannot overflow
# below 2^39 rows
_PARTS = [6] * 10 + [4]


def _multiset(h: DataFrame, by: list[str]) -> DataFrame:
    # two parts are read as one number and split by its bits; reading digits is what costs
    pairs = [F.conv(F.substring("row_sha", 12 * k + 1, 12), 16, 10).cast("bigint").alias(f"_w{k}") for k in range(5)]
    h = h.select(*by, *pairs, F.conv(F.substring("row_sha", 61, 4), 16, 10).cast("bigint").alias("_p10"))
    low = (1 << 24) - 1
    parts = [F.shiftright(f"_w{i // 2}", 24) if i % 2 == 0 else F.col(f"_w{i // 2}").bitwiseAND(F.lit(low)) for i in range(10)] + [F.col("_p10")]
    sums = [F.sum(c).alias(f"_s{i}") for i, c in enumerate(parts)]
    agg = (h.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sums) if by
           else h.agg(F.count(F.lit(1)).alias("n_rows"), *sums))
    digest = F.concat(*[F.lpad(F.lower(F.hex(F.pmod(F.col(f"_s{i}"), F.lit(16**n)))), n, "0") for i, n in enumerate(_PARTS)])
    return agg.select(*by, "n_rows", F.base64(F.unhex(digest)).alias("hash_b64"))


def table_fingerprint(df: DataFrame, spec: FingerprintSpec, compat: bool = False,
                      buckets: int | None = None, mode: str = "exact") -> DataFrame:
    """V-03 (+V-05 when the spec is sharded): ``by..., [shard], n_rows, hash_b64`` per group.

    ``mode``: ``exact`` (the reference digest), ``multiset`` (sum of row hashes,
    skew-proof); ``buckets`` selects the two-level exact variant.
    """
    name = "row_sha" if mode == "multiset" else "row_hash"
    h = row_hashes(df, spec, compat, mode == "multiset").where(F.col(name).isNotNull())
    by = list(spec.by)
    if spec.shards:
        col, n = spec.shards
        h = h.withColumn("shard", F.pmod(F.col(col), F.lit(n)))
        by = [*by, "shard"]
    if mode == "multiset":
        return _multiset(h, by)
    if buckets:
        # level 1: one digest per (group, bucket), rows in hash order
        part = (h.withColumn("_bucket", F.pmod(F.xxhash64("row_hash"), F.lit(buckets)))
                .groupBy(*by, "_bucket")
                .agg(F.count(F.lit(1)).alias("_n"),
                     sha256_b64(F.expr("listagg(row_hash, ',') WITHIN GROUP (ORDER BY row_hash)")).alias("_d")))
        return part.groupBy(*by).agg(
            F.sum("_n").alias("n_rows"),
            sha256_b64(F.expr("listagg(_d, ',') WITHIN GROUP (ORDER BY _bucket)")).alias("hash_b64"))
    order = ", ".join(_sort_exprs(spec) if not spec.shards else ["row_hash"])
    agg = [F.count(F.lit(1)).alias("n_rows"),
           sha256_b64(F.expr(f"listagg(row_hash, ',') WITHIN GROUP (ORDER BY {order})")).alias("hash_b64")]
    return h.groupBy(*by).agg(*agg) if by else h.agg(*agg)


def consumed_output_epochs(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """tx_consumed_output has no epoch column; its epoch is the consumer block's."""
    return df.join(blocks.select(F.col("slot_no").alias("consumed_in_slot_no"), "epoch_no").distinct(),
                   "consumed_in_slot_no")


def fingerprint_compare(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """V-08: full outer join of two fingerprint results on ``keys``.

    ``status`` is ``equal``, ``differ``, ``left_only`` or ``right_only``.
    """
    l = left.select(*keys, F.col("n_rows").alias("left_rows"), F.col("hash_b64").alias("left_hash"))
    r = right.select(*keys, F.col("n_rows").alias("right_rows"), F.col("hash_b64").alias("right_hash"))
    j = l.join(r, keys, "full_outer")
    status = (F.when(F.col("left_hash").isNull(), F.lit("right_only"))
              .when(F.col("right_hash").isNull(), F.lit("left_only"))
              .when(F.col("left_hash") == F.col("right_hash"), F.lit("equal"))
              .otherwise(F.lit("differ")))
    return j.withColumn("status", status)


def row_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """V-09: the rows of one side that the other lacks (multiset difference), labelled by side.

    Each side is read once: rows count +1 and -1, and what doesn't cancel out differs.
    """
    cols = left.columns
    both = (left.withColumn("_n", F.lit(1).cast("bigint"))
            .unionByName(right.select(*cols).withColumn("_n", F.lit(-1).cast("bigint"))))
    rest = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n")))
    return rest.select(*cols, side.alias("side"), copies.alias("_copy")).drop("_copy")


def fingerprint_table(name: str, df: DataFrame, blocks: DataFrame | None = None, compat: bool = False,
                      buckets: int | None = None, mode: str = "exact") -> DataFrame:
    """Fingerprint one derived / target table by its configuration in ``SPECS``."""
    spec = SPECS[name]
    if spec.shards and "epoch_no" not in df.columns:
        if blocks is None:
            raise ValueError(f"{name}: block relation needed to find the consumer epoch")
        df = consumed_output_epochs(df, blocks)
    return table_fingerprint(df, spec, compat=compat, buckets=buckets, mode=mode)
