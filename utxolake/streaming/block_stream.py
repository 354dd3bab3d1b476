"""W-09: slot sync fed by a stream of arriving block files.

``readStream`` watches the folder that receives block exports. Each micro-batch
(``foreachBatch``) adds its deliveries to the chain (``chain.apply_delivery``), which finds forks and
retires the blocks that lost, and the tables are synced with the window loads of the batch job
(W-05 / W-06) over the chain, never over files that have not been delivered yet. A replayed batch
changes nothing that it has changed before.

Where the chain changed at or below a table's watermark, the table is first cut back to just below the
change, in one version: replace tables lose the rows from that slot on; append tables, whose rows
have no slot, get their epochs from the change's on anew, up to the slot before it. Then the sync goes on from
there. A table notes the version of the chain it has seen together with its rows, so a crash in between loses no change.

Other relations than ``block`` come from ``relations``, called for every sync, or from folders of deliveries
(``delivered``). Those arrive independently of each other and of the blocks; a window then
ends no later than the slot to which every relation is complete (``chain.barrier``). A run that finds no new blocks still
syncs what the barrier lets through.

``trigger(availableNow=True)`` drains what is there and stops, so the same code runs as a scheduled job or, with a
processing-time trigger, continuously. The stream checkpoint and the target live on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import TABLES
from ..plans.sync import EmptyBatchError, SyncOptions, _replaced, derive, load_window
from ..session import shared_broadcasts
from ..sources.sinks import TableState, Warehouse
from .chain import CHAIN, DeliveredCatalog, apply_delivery, barrier, chain_blocks, chain_epoch_before, chain_head, first_change, needed_changes, with_delivery


class _Overlay(Mapping):
    """A catalog with some relations replaced."""

    def __init__(self, base, **over: DataFrame):
        self.base, self.over = base, over

    def __getitem__(self, k: str) -> DataFrame:
        return self.over[k] if k in self.over else self.base[k]

    def __iter__(self):
        return iter(set(self.over) | set(getattr(self.base, "keys", lambda: [])()))

    def __len__(self) -> int:
        return len(list(iter(self)))


def roll_back(cat, wh: Warehouse, table: str, base: TableState, chain: TableState, slot: int, opts: SyncOptions) -> None:
    """Take back what the table has from blocks at or above ``slot``; its watermark becomes the slot before."""
    spec, seen = TABLES[table], {"chain": chain.version}
    if spec.slot_mode == "replace":
        leaves, carried = _replaced(wh, table, base, slot)
        load = None if carried is None else wh.write_load(table, carried, spec.part_col, columns=wh.columns(base))
    else:
        epoch = chain_epoch_before(wh, chain, slot)
        before = F.col("slot_no") < slot
        rows = derive(cat, table, before if epoch is None else before & (F.col("epoch_no") >= epoch), opts).withColumn("_batch", F.lit(slot - 1).cast("bigint"))
        leaves = [leaf for leaf in base.leaves if epoch is None or int(leaf.part) >= epoch]
        load = wh.write_load(table, rows, spec.part_col, columns=wh.columns(base))
        # earlier epochs keep batches that end beyond the watermark from now on
        seen["settled"] = sorted({leaf.load for leaf in base.leaves - frozenset(leaves) if leaf.bucket >= slot})
    wh.publish(table, base, load, leaves, slot - 1, extra=seen)


def sync_table(cat, wh: Warehouse, table: str, chain: TableState, head: int, opts: SyncOptions) -> None:
    """Bring one table from its watermark to ``head``, behind the changes of the chain that it hasn't seen."""
    base, cfg = wh.state(table), opts.window
    changed = first_change(chain, base.extra.get("chain", -1))
    if base.slot is not None and changed is not None and changed <= base.slot:
        roll_back(cat, wh, table, base, chain, changed, opts)
    last = wh.watermark(table)[0]
    last = -1 if last is None else last
    while last < head - cfg.grace:
        mx = min(head, last + cfg.cap) - cfg.grace
        try:
            _, new = load_window(cat, wh, table, last, last - cfg.delete, mx, opts, {"chain": chain.version})
        except EmptyBatchError:  # W-07 "fail": the table waits for the next batch
            return
        if new == last:
            return
        last = new


def sync_tables(wh: Warehouse, tables: list[str], opts: SyncOptions, catalog: Callable[[DataFrame], Mapping]) -> None:
    """Sync all tables to the chain's head, or to the barrier of delivered relations if that is lower."""
    chain = wh.state(CHAIN)
    head = chain_head(wh, chain) if chain.schema is not None else None
    if head is None:
        return
    cat = catalog(chain_blocks(wh, chain))
    arrived = cat.marks if isinstance(cat, DeliveredCatalog) else {}
    changes = chain.extra.get("changes", [])
    if arrived:
        head = min(head, barrier(arrived, [(int(c["delivery"]), c["slot"]) for c in changes if c["fork"] and c["delivery"].isdigit()]))
    with shared_broadcasts(wh.spark, min(opts.parallel_tables, len(tables))), ThreadPoolExecutor(max_workers=max(1, opts.parallel_tables)) as pool:
        list(pool.map(lambda t: sync_table(cat, wh, t, chain, head, opts), tables))
    seen = min((wh.state(t).extra.get("chain", -1) for t in tables), default=-1)
    needed = needed_changes(changes, seen, arrived)
    if len(needed) < len(changes):
        dropped = {c["version"] for c in changes} - {c["version"] for c in needed}
        wh.annotate(CHAIN, lambda s: replace(s, extra=s.extra | {"changes": [c for c in s.extra.get("changes", []) if c["version"] not in dropped]}))


def stream_sync(spark: SparkSession, src, block_dir: str, wh: Warehouse, tables: list[str],
                opts: SyncOptions | None = None, checkpoint: str | None = None, files_per_batch: int = 8,
                block_schema=None, relations: Callable[[], Mapping] | None = None, delivered: str | None = None,
                delivered_names: Iterable[str] | None = None):
    """Run the stream until the folder is drained; returns the finished ``StreamingQuery``.

    ``delivered`` is the folder of the other relations' deliveries (``<relation>/delivery=<k>/upto_slot=<n>``), of which
    ``delivered_names`` (default: those that have a folder) must all arrive before a window runs.
    """
    opts = opts or SyncOptions()
    schema = block_schema or src["block"].schema
    checkpoint = checkpoint or f"{wh.root}/_stream_checkpoint"
    names = list(delivered_names) if delivered_names is not None else None

    def catalog(blocks: DataFrame) -> Mapping:
        if delivered is not None:
            return DeliveredCatalog(wh, delivered, blocks, names)
        return _Overlay(relations() if relations else src, block=blocks)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for r in sorted(r[0] for r in batch.select("_delivery").distinct().collect()):  # one per file at most
                apply_delivery(wh, batch.where(F.col("_delivery") == r), r)
        finally:
            batch.unpersist()
        sync_tables(wh, tables, opts, catalog)

    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(block_dir)
    query = (with_delivery(files).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is None:
        sync_tables(wh, tables, opts, catalog)  # relations may have arrived without blocks
    return query
