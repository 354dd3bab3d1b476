"""Name -> derivation function for the 30 target tables."""

from __future__ import annotations

from . import assets, chain, epochs, outputs, pools, scripts, staking

DERIVE = {
    "block": chain.block,
    "block_hash": chain.block_hash,
    "tx": chain.tx,
    "tx_hash": chain.tx_hash,
    "tx_in_out": chain.tx_in_out,
    "tx_consumed_output": chain.tx_consumed_output,
    "tx_metadata": chain.tx_metadata,
    "collateral": chain.collateral,
    "datum": scripts.datum,
    "script": scripts.script,
    "redeemer": scripts.redeemer,
    "rel_addr_txout": outputs.rel_addr_txout,
    "rel_stake_txout": outputs.rel_stake_txout,
    "rel_stake_hash": staking.rel_stake_hash,
    "ma_minting": assets.ma_minting,
    "delegation": staking.delegation,
    "stake_registration": staking.stake_registration,
    "stake_deregistration": staking.stake_deregistration,
    "reward": staking.reward,
    "withdrawal": staking.withdrawal,
    "epoch_stake": staking.epoch_stake,
    "pool_update": pools.pool_update,
    "pool_retire": pools.pool_retire,
    "pool_owner": pools.pool_owner,
    "pool_offline_data": pools.pool_offline_data,
    "epoch_param": epochs.epoch_param,
    "param_proposal": epochs.param_proposal,
    "ada_pots": epochs.ada_pots,
    "meta": epochs.meta,
    "schema_version": epochs.schema_version,
}
