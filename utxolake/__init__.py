"""utxolake: analytic tables of a UTXO ledger, derived, synced and checked on Spark.

Entry points::

    from utxolake import DERIVE, load_source, Warehouse, SyncOptions
    from utxolake import slot_sync_job, epoch_sync_job, backfill_job, deep_compare_job, stream_sync
"""

__version__ = "0.1.0"

_EXPORTS = {
    "DERIVE": "utxolake.operators.derive",
    "fingerprint_table": "utxolake.operators.fingerprint",
    "load_source": "utxolake.sources.loader",
    "Warehouse": "utxolake.sources.sinks",
    "enforce_schema": "utxolake.sources.schemas",
    "SyncOptions": "utxolake.plans.sync",
    "slot_sync_job": "utxolake.plans.sync",
    "epoch_sync_job": "utxolake.plans.sync",
    "backfill_job": "utxolake.plans.sync",
    "deep_compare_job": "utxolake.plans.validate",
    "stream_sync": "utxolake.streaming.block_stream",
}


def __getattr__(name):  # lazy: importing the package does not import pyspark modules eagerly
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
