"""Per-table facts the jobs need: sync mode, empty-batch policy, backfill start.

Fixed values (SURVEY §2.3-§2.5): the table orders of the two sync jobs, the
tables of each merge mode and empty-batch policy, and the backfill start
epochs of the reference deployment.
"""

from __future__ import annotations

from dataclasses import dataclass

SLOT_ORDER = ["tx", "tx_in_out", "tx_consumed_output", "tx_hash", "tx_metadata", "block", "block_hash",
              "rel_addr_txout", "rel_stake_txout", "rel_stake_hash", "collateral", "ma_minting", "script",
              "pool_offline_data", "pool_owner", "pool_retire", "pool_update", "redeemer", "stake_registration",
              "stake_deregistration", "withdrawal", "delegation", "datum"]

EPOCH_ORDER = ["epoch_param", "ada_pots", "param_proposal", "ma_minting", "pool_update", "pool_offline_data",
               "delegation", "reward", "rel_addr_txout", "rel_stake_txout", "epoch_stake"]

SLOT_APPEND = {"rel_addr_txout", "rel_stake_txout", "ma_minting", "pool_offline_data", "pool_update", "delegation"}

SLOT_EMPTY = {
    **{t: "fail" for t in ["block", "block_hash", "collateral", "redeemer", "tx", "tx_hash", "tx_in_out",
                           "tx_metadata"]},
    **{t: "keep" for t in ["delegation", "ma_minting", "rel_addr_txout", "rel_stake_txout", "stake_registration",
                           "stake_deregistration", "withdrawal"]},
    **{t: "advance" for t in ["datum", "pool_offline_data", "pool_owner", "pool_retire", "pool_update",
                              "rel_stake_hash", "script", "tx_consumed_output"]},
}

EPOCH_CLOSED = {"delegation", "ma_minting", "pool_offline_data", "pool_update", "rel_addr_txout", "rel_stake_txout"}
EPOCH_EMPTY_ADVANCE = {"ada_pots", "epoch_param", "epoch_stake", "param_proposal"}

BACKFILL_START = {"block": 0, "tx": 0, "tx_hash": 0, "tx_consumed_output": 0, "rel_addr_txout": 0,
                  "delegation": 208, "rel_stake_txout": 208, "stake_registration": 208, "reward": 209,
                  "withdrawal": 209, "stake_deregistration": 209, "epoch_stake": 210, "tx_metadata": 216,
                  "script": 238, "rel_stake_hash": 242, "ma_minting": 251, "tx_in_out": 287, "redeemer": 290,
                  "block_hash": 330, "collateral": 340}
BACKFILL_FULL = ["ada_pots", "datum", "epoch_param", "meta", "param_proposal", "pool_offline_data", "pool_owner",
                 "pool_retire", "pool_update", "schema_version"]

# Tables whose epoch_no is not the block's (filter the derived rows, not the blocks).
OWN_EPOCH = {"epoch_param", "ada_pots", "epoch_stake", "reward", "param_proposal", "stake_registration",
             "stake_deregistration"}


@dataclass(frozen=True)
class TableSpec:
    name: str
    slot_mode: str | None  # "replace" (W-05) | "append" (W-06) | None
    slot_empty: str | None  # "fail" | "keep" | "advance"
    epoch_mode: str | None  # "closed" (P-03 replace) | "next" (P-04 append) | None
    epoch_empty: str | None  # "advance" | "keep"
    slot_col: str | None  # column holding the block slot in the derived rows
    part_col: str | None  # storage partition column
    backfill_start: int | None  # None: whole table at once (B-02)


def _spec(name: str) -> TableSpec:
    slot_mode = None if name not in SLOT_ORDER else ("append" if name in SLOT_APPEND else "replace")
    epoch_mode = None if name not in EPOCH_ORDER else ("closed" if name in EPOCH_CLOSED else "next")
    slot_col = {"tx_consumed_output": "consumed_in_slot_no"}.get(name, "slot_no") if slot_mode == "replace" else None
    part_col = {"tx_consumed_output": "consumed_in_epoch_no", "meta": None, "schema_version": None}.get(
        name, "epoch_no")
    return TableSpec(
        name=name, slot_mode=slot_mode, slot_empty=SLOT_EMPTY.get(name), epoch_mode=epoch_mode,
        epoch_empty=None if epoch_mode is None else ("advance" if name in EPOCH_EMPTY_ADVANCE else "keep"),
        slot_col=slot_col, part_col=part_col, backfill_start=BACKFILL_START.get(name),
    )


ALL_TABLES = list(dict.fromkeys(SLOT_ORDER + EPOCH_ORDER + list(BACKFILL_START) + BACKFILL_FULL))
TABLES: dict[str, TableSpec] = {n: _spec(n) for n in ALL_TABLES}
