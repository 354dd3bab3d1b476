"""Slot sync, epoch sync and backfill jobs (W-03 ... W-08, P-02 ... P-06, B-01 ... B-03).

Every table load is: derive the window / epoch (a lazy plan over the source), write it
as a load of the target (row count S-04), apply the empty-batch policy (W-07 / P-05), and
publish a version of the table that has the new rows, lacks those they replace (W-05, W-06, P-03,
P-04) and carries the new watermark (S-08). A failure before that leaves the table as it was.

* Replace tables give up the slot buckets from ``clean`` on; of the one that ``clean`` lies in, the
  rows before it in the epochs that reach it are carried over. So what a window writes doesn't depend on the epoch's
  size, nor on how many epochs a bucket spans.
* Append tables carry ``_batch`` (the window end) and have a bucket per batch; batches beyond the
  watermark give way.
* Epoch loads replace whole epochs.

The driver only handles plans and folder names: one row per table and round, one name per
epoch and bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.derive import DERIVE
from ..session import shared_broadcasts
from ..sources.schemas import TARGET_DDL, SchemaViolation, watch_schema
from ..sources.sinks import HIDDEN, CommitConflict, Leaf, Load, TableState, Warehouse
from .registry import BACKFILL_FULL, BACKFILL_START, EPOCH_CLOSED, EPOCH_ORDER, OWN_EPOCH, SLOT_ORDER, TABLES
from .windows import SlotWindowConfig, plan_epochs, plan_slot_windows, source_head
from .zones import ZoneMap, zones_for


class EmptyBatchError(RuntimeError):
    pass


@dataclass
class SyncOptions:
    window: SlotWindowConfig = field(default_factory=SlotWindowConfig)
    cluster_size: int = 1000
    stall_safe: bool = True  # Q6: "keep" on an empty capped window would stall; advance instead
    catch_up: bool = True  # P-01 mode closed_all
    parallel_tables: int = 4  # independent tables run as concurrent Spark jobs
    max_list: int | None = None  # split delegation / minting lists longer than this into rows (off: as upstream)
    transforms: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)  # per table, on what is loaded
    zone_slots: int | None = 1000  # slots per zone of the map of source ids (None: ids are looked up per window)
    enforce: bool = False  # S-02: refuse a load with rows that the target schema forbids
    reload_open: tuple[str, ...] = ()  # Q17: next-mode tables whose last loaded epoch is reloaded too


def derive(src, table: str, where: Column | None = None, opts: SyncOptions | None = None) -> DataFrame:
    """Derivation with the storage extras: consumer epoch of tx_consumed_output."""
    kw = {}
    if table in ("rel_addr_txout", "rel_stake_txout"):
        kw["cluster_size"] = (opts or SyncOptions()).cluster_size
    if table == "tx_consumed_output":
        kw["with_epoch"] = True
    if table in ("delegation", "ma_minting") and opts is not None and opts.max_list:
        kw["max_list"] = opts.max_list
    out = DERIVE[table](src, where, **kw) if where is not None else DERIVE[table](src, **kw)
    return opts.transforms[table](out) if opts is not None and table in opts.transforms else out


def extract_replace(src, table: str, clean: int, mx: int, opts: SyncOptions | None = None) -> DataFrame:
    """W-03: rows with ``clean <= slot <= max`` (blocks filtered before the joins)."""
    return derive(src, table, F.col("slot_no").between(clean, mx), opts)


def extract_append(src, table: str, last: int, mx: int, opts: SyncOptions | None = None) -> DataFrame:
    """W-04: rows of blocks with ``last < slot <= max``, filtered before aggregation."""
    return derive(src, table, (F.col("slot_no") > last) & (F.col("slot_no") <= mx), opts)


def extract_epoch(src, table: str, epoch: int, opts: SyncOptions | None = None) -> DataFrame:
    """P-02. Tables with an epoch column of their own are filtered on it (the
    filter reaches the source scan); the others through their blocks."""
    if table in OWN_EPOCH:
        return derive(src, table, opts=opts).where(F.col("epoch_no") == epoch)
    return derive(src, table, F.col("epoch_no") == epoch, opts)


def extract_epochs(src, table: str, epochs: list[int], opts: SyncOptions | None = None) -> DataFrame:
    """P-02 for several epochs at once."""
    cond = F.col("epoch_no").isin(epochs)
    if table in OWN_EPOCH:
        return derive(src, table, opts=opts).where(cond)
    return derive(src, table, cond, opts)


def _load(wh: Warehouse, table: str, rows: DataFrame, opts: SyncOptions | None, **kw) -> Load:
    """Write a load; with ``enforce`` one that the target schema forbids is discarded (``SchemaViolation``)."""
    if opts is None or not opts.enforce or table not in TARGET_DDL:
        return wh.write_load(table, rows, TABLES[table].part_col, **kw)
    watched, problems = watch_schema(rows, table, HIDDEN)
    load = wh.write_load(table, watched, TABLES[table].part_col, **kw)
    if found := problems():
        wh.discard(table, load)
        raise SchemaViolation(table, found)
    return load


def _replaced(wh: Warehouse, table: str, base: TableState, clean: int) -> tuple[list[Leaf], DataFrame | None]:
    """W-05: the leaves that can hold rows with ``slot >= clean``, and their rows below it (None: they have none).

    Of the bucket that ``clean`` lies in, epochs without such rows stay as they are. If it holds several, a small job
    over their slots tells which.
    """
    first, slot = clean // wh.bucket_slots, F.col(TABLES[table].slot_col)
    leaves = [leaf for leaf in base.leaves if leaf.bucket >= first]
    edge = [leaf for leaf in leaves if leaf.bucket == first]
    if not edge or clean % wh.bucket_slots == 0:
        return leaves, None
    held = wh.read_leaves(table, base, edge)
    if len({leaf.part for leaf in edge}) > 1:
        reached = {str(r[0]) for r in held.where(slot >= clean).select(base.part_col).distinct().collect()}  # epochs of one bucket
        stay = {leaf for leaf in edge if leaf.part not in reached and leaf.part.lstrip("-").isdigit()}
        leaves, edge = [leaf for leaf in leaves if leaf not in stay], [leaf for leaf in edge if leaf not in stay]
        if not edge:
            return leaves, None
        held = wh.read_leaves(table, base, edge)
    return leaves, held.where(slot < clean)


def _appended(base: TableState, last: int) -> list[Leaf]:
    """W-06: leaves of batches beyond the watermark ``last``, but for those that stayed when the watermark went back."""
    return [leaf for leaf in base.leaves if leaf.bucket > last and leaf.load not in base.extra.get("settled", ())]


def merge_replace(wh: Warehouse, table: str, clean: int, slot: int | None = None) -> int:
    """W-05: target rows with ``slot >= clean`` give way to the staged rows, also if none were staged."""
    return _merge_replace(wh, table, wh.state(table), wh.read_stage(table), clean, slot)


def _merge_replace(wh: Warehouse, table: str, base: TableState, rows: DataFrame, clean: int, slot: int | None) -> int:
    drop, carried = _replaced(wh, table, base, clean)
    load = wh.write_load(table, rows, TABLES[table].part_col, carried, wh.columns(base), window=True)
    wh.publish(table, base, load, drop, slot)
    return load.rows


def merge_append(wh: Warehouse, table: str, batch: int, last: int, slot: int | None = None) -> int:
    """W-06: add the staged rows as batch ``batch``. Batches beyond the watermark ``last`` give way."""
    base = wh.state(table)
    staged = wh.read_stage(table).withColumn("_batch", F.lit(batch).cast("bigint"))
    load = wh.write_load(table, staged, TABLES[table].part_col, columns=wh.columns(base), window=True)
    wh.publish(table, base, load, _appended(base, last), slot)
    return load.rows


def merge_epoch(wh: Warehouse, table: str, epoch: int) -> None:
    """P-03 / P-04: the epoch becomes exactly the staged rows."""
    merge_epochs(wh, table, {epoch})


def merge_epochs(wh: Warehouse, table: str, epochs: set) -> None:
    """P-03 / P-04 for several epochs: each becomes exactly its staged rows."""
    base = wh.state(table)
    load = wh.write_load(table, _with_batch(wh.read_stage(table), table), TABLES[table].part_col, columns=wh.columns(base))
    wh.publish(table, base, load, _of_epochs(base, set(epochs) | load.epochs()))


def _of_epochs(base: TableState, epochs: set) -> list[Leaf]:
    names = {str(e) for e in epochs}
    return [leaf for leaf in base.leaves if leaf.part in names]


def next_watermark(policy: str, rows: int, planned: int, current: int, stall_safe: bool = True) -> int:
    """W-07 / P-05: the watermark after a load of ``rows`` rows."""
    if rows > 0 or policy == "advance" or (policy == "keep" and stall_safe):
        return planned
    if policy == "fail":
        raise EmptyBatchError("empty batch")
    return current


def sync_table_slots(src, wh: Warehouse, table: str, last: int, head: int, opts: SyncOptions) -> tuple[int, int]:
    """One round of W-05 or W-06 for one table; returns (rows, new watermark)."""
    cfg, spec = opts.window, TABLES[table]
    if head < last:
        raise RuntimeError(f"{table}: source head {head} behind watermark {last}")
    mx = min(head, last + cfg.cap) - cfg.grace
    return load_window(src, wh, table, last, last - cfg.delete, mx, opts)


def load_window(src, wh: Warehouse, table: str, last: int, clean: int, mx: int, opts: SyncOptions, extra: dict | None = None) -> tuple[int, int]:
    """W-05 / W-06 for one planned window: derived rows are written once, and become part of the table together with
    the watermark. An empty window still clears what its range held, unless the table's policy leaves the watermark
    behind it."""
    spec, base = TABLES[table], wh.state(table)
    if spec.slot_mode == "replace":
        rows = extract_replace(src, table, clean, mx, opts)
        drop, carried = _replaced(wh, table, base, clean)
    else:
        rows = extract_append(src, table, last, mx, opts).withColumn("_batch", F.lit(mx).cast("bigint"))
        drop, carried = _appended(base, last), None
    load = _load(wh, table, rows, opts, carried=carried, columns=wh.columns(base), window=True)
    try:
        new = next_watermark(spec.slot_empty, load.rows, mx, last, opts.stall_safe)
    except EmptyBatchError:
        wh.discard(table, load)
        raise
    if load.rows or new != last:
        wh.publish(table, base, load, drop, new, extra=extra)
    else:
        wh.discard(table, load)
    return load.rows, new


def slot_sync_job(src, wh: Warehouse, opts: SyncOptions | None = None, tables: list[str] | None = None
                  ) -> DataFrame:
    """W-08: every due table, up to ``rounds`` rounds, then the source-head row. The windows' id ranges come from the
    zone map, which is brought up to the planned windows first."""
    opts = opts or SyncOptions()
    spark = wh.spark
    tables = tables or SLOT_ORDER
    head_row = source_head(src["block"])
    head = head_row.first()
    marks = {r["tablename"]: r["last_slot_no"] for r in wh.last_index().collect()}  # one row per table
    planned: dict[str, list] = {}
    due = wh.last_index().where(F.col("tablename").isin(tables) & F.col("last_slot_no").isNotNull())
    for r in plan_slot_windows(due, head_row, opts.window).collect():  # tables x rounds
        planned.setdefault(r["tablename"], []).append(r)

    windows = [(r["clean_slot_no"], r["max_slot_no"]) for rs in planned.values() for r in rs]
    zones = ZoneMap(0)
    if opts.zone_slots and windows:
        zones = zones_for(src, wh, windows, head["head_slot_no"], opts.window, opts.zone_slots)

    def one_table(table: str) -> list[tuple]:
        last = marks.get(table)
        if last is None:
            return [(table, 0, None, None, 0, "no_watermark")]
        if head["head_slot_no"] < last:
            return [(table, 0, last, last, 0, "head_behind")]
        out = []
        for r in sorted(planned.get(table, []), key=lambda r: r["round"]):
            if r["last_slot_no"] != last:  # the round before did not move the watermark
                break
            try:
                source = zones.window(src, r["clean_slot_no"], r["max_slot_no"])
                rows, new = load_window(source, wh, table, last, r["clean_slot_no"], r["max_slot_no"], opts)
            except EmptyBatchError:  # W-07 "fail": this table stops, its watermark stays
                out.append((table, r["round"], last, last, 0, "failed_empty"))
                break
            except CommitConflict:  # another job loads this table; what it published stays
                out.append((table, r["round"], last, wh.watermark(table)[0], 0, "conflict"))
                break
            except SchemaViolation:  # S-02: nothing of the load became part of the table
                out.append((table, r["round"], last, last, 0, "refused"))
                break
            out.append((table, r["round"], last, new, rows, "loaded" if rows else "empty"))
            last = new
        return out

    with shared_broadcasts(wh.spark, min(opts.parallel_tables, len(tables))), ThreadPoolExecutor(max_workers=max(1, opts.parallel_tables)) as pool:
        report = [row for rows in pool.map(one_table, tables) for row in rows]
    wh.set_watermark("source", slot=head["head_slot_no"], epoch=head["head_epoch_no"])
    return spark.createDataFrame(report, "tablename STRING, round INT, from_slot_no BIGINT, "
                                         "last_slot_no BIGINT, rows BIGINT, status STRING")


def epochs_done(spec, epochs: list[int], loaded: set[int]) -> list[int]:
    """P-05: the epochs, in order, that the watermark may pass: loaded ones, and empty ones if the epoch is
    closed (it cannot change any more) or the table advances on empty. It stops at the first other."""
    done = []
    for e in sorted(epochs):
        if e not in loaded and spec.epoch_empty != "advance" and spec.epoch_mode != "closed":
            break
        done.append(e)
    return done


def epoch_sync_job(src, wh: Warehouse, opts: SyncOptions | None = None, tables: list[str] | None = None
                   ) -> DataFrame:
    """P-06: load the due epochs of the epoch tables (P-01 plan, P-03 / P-04 merges).

    All due epochs of one table are derived in one pass (``epoch_no IN (...)``)
    and swapped in as partitions. A closed-epoch reload of a slot-appended table
    only takes epochs whose last slot its slot watermark has passed (Q16), so
    later slot appends cannot repeat rows of a reloaded epoch.
    """
    opts = opts or SyncOptions()
    spark = wh.spark
    tables = tables or EPOCH_ORDER
    head = source_head(src["block"])
    li = wh.last_index().where(F.col("tablename").isin(tables))
    plan = plan_epochs(li, head, sorted(EPOCH_CLOSED), opts.catch_up).collect()  # tables x due epochs
    due: dict[str, list[int]] = {}
    for r in plan:
        due.setdefault(r["tablename"], []).append(r["epoch_no"])
    if opts.reload_open:  # Q17: the previously loaded epoch may have been open; replace it again
        for r in li.where(F.col("tablename").isin(list(opts.reload_open))).collect():  # one row per table
            if r["tablename"] in due and r["last_epoch_no"] is not None and r["last_epoch_no"] >= 0:
                due[r["tablename"]].append(r["last_epoch_no"])
    epoch_end = ({r[0]: r[1] for r in src["block"].groupBy("epoch_no").agg(F.max("slot_no")).collect()}
                 if any(TABLES[t].epoch_mode == "closed" for t in due) else {})  # one row per epoch
    def one_table(table: str) -> list[tuple]:
        report: list[tuple] = []
        epochs = sorted(due.get(table, []))
        if not epochs:
            return report
        spec = TABLES[table]
        if spec.epoch_mode == "closed":
            last_slot = wh.watermark(table)[0]
            ready = [e for e in epochs if last_slot is None or epoch_end.get(e, -1) <= last_slot]
            report += [(table, e, 0, "waiting_for_slot_sync") for e in epochs if e not in ready]
            epochs = ready
        if not epochs:
            return report
        base = wh.state(table)
        load = _load(wh, table, _with_batch(extract_epochs(src, table, epochs, opts), table), opts, columns=wh.columns(base))
        loaded = load.epochs()
        done = epochs_done(spec, epochs, loaded)
        try:  # a done epoch without rows loses what it held
            wh.publish(table, base, load, _of_epochs(base, loaded | set(done)), epoch=done[-1] if done else None)
        except CommitConflict:
            return report + [(table, e, None, "conflict") for e in epochs]
        report += [(table, e, None, "loaded" if e in loaded else "empty") for e in epochs]
        return report

    with shared_broadcasts(wh.spark, min(opts.parallel_tables, len(tables))), ThreadPoolExecutor(max_workers=max(1, opts.parallel_tables)) as pool:
        report = [row for rows in pool.map(one_table, tables) for row in rows]
    return spark.createDataFrame(report, "tablename STRING, epoch_no BIGINT, rows BIGINT, status STRING")


def _with_batch(df: DataFrame, table: str) -> DataFrame:
    if TABLES[table].slot_mode == "append" and "_batch" not in df.columns:
        return df.withColumn("_batch", F.lit(None).cast("bigint"))
    return df


def backfill_by_epoch(src, wh: Warehouse, table: str, start: int | None = None, opts: SyncOptions | None = None,
                      stop_at_gap: bool = False, ends: Mapping[int, int] | None = None) -> tuple[int, list[int]]:
    """B-01: all epochs of the table from ``start`` (None: the first); returns the rows and the epochs left out.

    Target epochs before ``start`` stay. ``stop_at_gap`` ends at the first epoch without rows, as the
    reference deployment does; target epochs beyond it stay too. With ``ends`` (last slot by epoch) the
    watermark comes with the rows.
    """
    spec, base = TABLES[table], wh.state(table)
    rows = _with_batch(derive(src, table, opts=opts), table)
    if start is not None:
        rows = rows.where(F.col(spec.part_col) >= start)
    load = _load(wh, table, rows, opts)
    if start is None and not stop_at_gap:
        _publish_backfill(wh, table, base, load, base.leaves, ends)
        return load.rows, []
    present = sorted(load.epochs())
    epochs = present
    if stop_at_gap:
        first = start if start is not None else min(present, default=0)
        epochs = [e for i, e in enumerate(present) if e == first + i]
    left = [leaf for leaf in load.leaves if leaf.part not in {str(e) for e in epochs}]
    load.leaves -= frozenset(left)
    gone = set(epochs) if stop_at_gap else {e for e in base.epochs() if start is None or e >= start}
    loaded = max(epochs, default=None)
    _publish_backfill(wh, table, base, load, _of_epochs(base, gone), ends, loaded if stop_at_gap else None, frozenset((x.load, x.part) for x in left))
    for leaf in left:  # written, but never part of the table
        wh.delete(f"{wh.path(table)}/_v={leaf.load}/{spec.part_col}={leaf.part}")
    return load.rows, [e for e in present if e not in epochs]


def _publish_backfill(wh: Warehouse, table: str, base: TableState, load: Load, drop, ends: Mapping[int, int] | None,
                      last: int | None = None, cut: frozenset = frozenset()) -> None:
    """The watermark becomes the last epoch there (or ``last``) and the last slot of that epoch."""
    epochs = {int(x.part) for x in (base.leaves - frozenset(drop)) | load.leaves if x.part.lstrip("-").isdigit()}
    epoch = last if last is not None else max(epochs, default=None)
    if ends is None or epoch is None or not load.part_col:
        wh.publish(table, base, load, drop, cut=cut)
    else:
        wh.publish(table, base, load, drop, ends.get(epoch), epoch, cut=cut)


def backfill_full(src, wh: Warehouse, table: str, opts: SyncOptions | None = None, ends: Mapping[int, int] | None = None) -> int:
    """B-02: the whole table in one go."""
    base = wh.state(table)
    load = _load(wh, table, _with_batch(derive(src, table, opts=opts), table), opts)
    _publish_backfill(wh, table, base, load, base.leaves, ends)
    return load.rows


def backfill_in_groups(src, wh: Warehouse, table: str, size: int, ends: Mapping[int, int], opts: SyncOptions | None, run: str) -> int:
    """B-01 with one version per ``size`` epochs, in ascending order; an interrupted run goes on behind its last version.

    ``run`` names the backfill: the first group of a run replaces the whole table.
    """
    spec, epochs = TABLES[table], sorted(ends)
    groups = [epochs[k : k + size] for k in range(0, len(epochs), size)]
    for k, group in enumerate(groups):
        base = wh.state(table)
        done = base.extra.get("backfill", {}) if base.extra.get("backfill", {}).get("run") == run else {"groups": 0, "rows": 0}
        if k < done["groups"]:
            continue
        if table in OWN_EPOCH:  # rows of epochs that no block has go with the group around them
            low = F.lit(True) if k == 0 else F.col("epoch_no") >= group[0]
            high = F.lit(True) if k == len(groups) - 1 else F.col("epoch_no") < groups[k + 1][0]
            rows = derive(src, table, opts=opts).where(low & high)
        else:
            rows = derive(src, table, F.col("epoch_no").between(group[0], group[-1]), opts)
        load = _load(wh, table, _with_batch(rows, table), opts)
        mark = {"run": run, "groups": k + 1, "rows": done["rows"] + load.rows}
        loaded = max(load.epochs(), default=base.epoch if k else None)
        wh.publish(table, base, load, base.leaves if k == 0 else (), None if loaded is None else ends.get(loaded), loaded, {"backfill": mark})
    state = wh.state(table)
    return state.extra.get("backfill", {}).get("rows", 0)


class BoundedCatalog(Mapping):
    """A source as it was when its head was ``slot`` in ``epoch``: later blocks don't exist, nor what hangs on them."""

    def __init__(self, src, slot: int, epoch: int):
        self.src, self.slot, self.epoch = src, slot, epoch

    def __getitem__(self, name: str) -> DataFrame:
        df = self.src[name]
        if name == "block":
            return df.where(F.col("slot_no") <= self.slot)
        if name in EPOCH_RELATIONS:
            return df.where(F.coalesce(F.col(EPOCH_RELATIONS[name]) <= self.epoch, F.lit(True)))
        return df

    def __iter__(self):
        return iter(self.src)

    def __len__(self) -> int:
        return len(self.src)


#: Relations that hang on an epoch and on no block, with its column.
EPOCH_RELATIONS = {"epoch_param": "epoch_no", "param_proposal": "epoch_no", "ada_pots": "epoch_no", "epoch_stake": "epoch_no", "reward": "earned_epoch"}
LEDGER = "_backfill"


def backfill_job(src, wh: Warehouse, starts: dict[str, int] | None = None, opts: SyncOptions | None = None,
                 tables: list[str] | None = None, stop_at_gap: bool = False, epochs_per_load: int | None = None) -> DataFrame:
    """B-03: every table in full, or from the epoch that ``starts`` gives it (``registry.BACKFILL_START`` lists the
    reference deployment's resume points; they presuppose that earlier epochs are loaded). The report names the
    epochs that ``stop_at_gap`` left out.

    The head of the source is read once, before the first load, and bounds all of them: blocks that arrive
    meanwhile are the sync jobs' business. Watermarks, published with the rows, are the last loaded epoch and its
    last slot below that head, so that the sync jobs continue where the backfill stopped. A ledger
    holds the head and the finished tables; the same call after a failure takes the same head and
    skips them. With ``epochs_per_load`` tables that are loaded from their first epoch get a version per so many epochs, and a
    rerun skips those too.
    """
    starts = starts or {}
    tables = tables or (list(BACKFILL_START) + BACKFILL_FULL)
    opts = opts or SyncOptions()
    asked = {"tables": tables, "starts": starts, "stop_at_gap": stop_at_gap, "epochs_per_load": epochs_per_load}
    ledger = wh.state(LEDGER).extra.get("run")
    if ledger is None or ledger["finished"] or ledger["asked"] != asked:
        head = source_head(src["block"]).first()
        ledger = {"id": uuid.uuid4().hex, "asked": asked, "slot": head["head_slot_no"], "epoch": head["head_epoch_no"], "finished": False, "done": {}}
        wh.annotate(LEDGER, lambda s: replace(s, extra={"run": ledger}))
    if ledger["slot"] is None:
        raise ValueError("the source has no blocks")
    bounded = BoundedCatalog(src, ledger["slot"], ledger["epoch"])
    ends = {r[0]: r[1] for r in bounded["block"].groupBy("epoch_no").agg(F.max("slot_no")).collect()}  # one row per epoch

    def one_table(table: str) -> tuple[str, int, list[int]]:
        if table in ledger["done"]:
            return table, *ledger["done"][table]
        part, skipped = TABLES[table].part_col, []
        if table in starts or (stop_at_gap and part and table in BACKFILL_START):
            rows, skipped = backfill_by_epoch(bounded, wh, table, starts.get(table), opts, stop_at_gap, ends)
        elif epochs_per_load and part:
            rows = backfill_in_groups(bounded, wh, table, epochs_per_load, ends, opts, ledger["id"])
        else:
            rows = backfill_full(bounded, wh, table, opts, ends)
        wh.annotate(LEDGER, lambda s: replace(s, extra={"run": s.extra["run"] | {"done": s.extra["run"]["done"] | {table: [rows, skipped]}}}))
        return table, rows, skipped

    with shared_broadcasts(wh.spark, min(opts.parallel_tables, len(tables))), ThreadPoolExecutor(max_workers=max(1, opts.parallel_tables)) as pool:
        report = list(pool.map(one_table, tables))
    wh.annotate(LEDGER, lambda s: replace(s, extra={"run": s.extra["run"] | {"finished": True}}))
    return wh.spark.createDataFrame(report, "tablename STRING, rows BIGINT, skipped_epochs ARRAY<BIGINT>")


def freshness(source: Warehouse | Callable[[str], DataFrame], head: DataFrame, tables: list[str]) -> DataFrame:
    """V-11: per table ``max(slot_no)``, ``max(epoch_no)`` and the lag behind the source head.

    Of target tables (``source`` is a warehouse) the newest epoch is a folder name, and the last slot is looked up in the
    highest slot bucket alone. ``tx_consumed_output``, whose ``epoch_no`` isn't its folder's, is read in that column.
    """
    parts = []
    for t in tables:
        slot = "consumed_in_slot_no" if t == "tx_consumed_output" else "slot_no"
        if isinstance(source, Warehouse):
            state = source.state(t)
            columns, by_folder = state.schema.names, state.part_col == "epoch_no"
            top = max((leaf.bucket for leaf in state.leaves), default=None)
            df = source.read_leaves(t, state, [leaf for leaf in state.leaves if TABLES[t].slot_col is None or leaf.bucket == top])
            epoch = F.lit(max(state.epochs(), default=None)) if by_folder else F.max("epoch_no") if "epoch_no" in columns else F.lit(None)
            if not by_folder and "epoch_no" in columns:
                whole = source.read(t).agg(F.max("epoch_no").cast("bigint").alias("max_epoch_no"))
                slots = df.agg(F.max(slot).cast("bigint").alias("max_slot_no"))
                parts.append(slots.crossJoin(whole).select(F.lit(t).alias("tablename"), "max_slot_no", "max_epoch_no"))  # one row each
                continue
            if slot not in columns:
                parts.append(source.spark.range(1).select(F.lit(t).alias("tablename"), F.lit(None).cast("bigint").alias("max_slot_no"), epoch.cast("bigint").alias("max_epoch_no")))
                continue
            parts.append(df.agg(F.max(slot).cast("bigint").alias("max_slot_no")).select(F.lit(t).alias("tablename"), "max_slot_no", epoch.cast("bigint").alias("max_epoch_no")))
            continue
        df = source(t)
        parts.append(df.agg(
            F.lit(t).alias("tablename"),
            (F.max(slot) if slot in df.columns else F.lit(None)).cast("bigint").alias("max_slot_no"),
            (F.max("epoch_no") if "epoch_no" in df.columns else F.lit(None)).cast("bigint").alias("max_epoch_no")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.crossJoin(F.broadcast(head))  # head: one row
            .withColumn("slot_lag", F.col("head_slot_no") - F.col("max_slot_no"))
            .withColumn("epoch_lag", F.col("head_epoch_no") - F.col("max_epoch_no")))
