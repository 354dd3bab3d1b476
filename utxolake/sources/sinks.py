"""Target tables on shared storage: versions, loads, staging, watermarks.

A table is a folder of *loads* (``_v=<id>``), each written once and never changed, with the rows
of a load in one *leaf* folder per epoch and bucket. A bucket is a range of ``bucket_slots`` slots
in tables with a slot, the end of the loading window in append tables. A *version* is a small JSON
file that names the leaves that make up the table, its schema and its watermark (S-08). Writers put
rows into a new load, then publish the next version with one create-if-absent, so rows out, rows in
and watermark change at once, or not at all; whoever finds the version taken lost a race
(``CommitConflict``). Readers take the newest version; the folders of the last
``VERSIONS_KEPT`` versions stay, so a running query isn't cut off.

S-04 row counts come from ``Observation`` metrics of the write itself (no second pass). S-05
staging is a plain overwrite of a private folder. A bucket's rows come
from one task, whole epochs are rebalanced, so that a task writes few files; the row limit of an upload (S-07) belongs to CSV exports and stages.

Only names of folders come to the driver: one per epoch and bucket.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.registry import TABLES
from ..session import shuffles_dropped
from .loader import CODEC
from .schemas import observed

HIDDEN = ("_batch", "consumed_in_epoch_no", "_bucket")
PART_COLS = ("epoch_no", "consumed_in_epoch_no")
#: Bucket of rows without a slot.
NO_SLOT = -(10**12)
LAST_INDEX_SCHEMA = T.StructType([
    T.StructField("tablename", T.StringType(), False),
    T.StructField("last_slot_no", T.LongType(), True),
    T.StructField("last_epoch_no", T.LongType(), True),
])


class CommitConflict(RuntimeError):
    """Another job published a version of the table in the meantime."""


@dataclass(frozen=True, order=True)
class Leaf:
    load: str
    part: str  # as in the folder's name
    bucket: int


@dataclass
class TableState:
    """One version of a table."""
    version: int = -1
    schema: T.StructType | None = None
    part_col: str | None = None
    slot: int | None = None
    epoch: int | None = None
    leaves: frozenset[Leaf] = frozenset()
    #: Folders that a load wrote and a later version dropped: (load, part) and load, to read the rest as whole folders.
    cut: frozenset[tuple[str, str]] = frozenset()
    extra: dict = field(default_factory=dict)

    def epochs(self) -> set[int]:
        return {int(leaf.part) for leaf in self.leaves if leaf.part.lstrip("-").isdigit()}

    def to_json(self) -> str:
        loads: dict[str, dict[str, list[int]]] = {}
        for leaf in sorted(self.leaves):
            loads.setdefault(leaf.load, {}).setdefault(leaf.part, []).append(leaf.bucket)
        return json.dumps({
            "version": self.version, "schema": self.schema and self.schema.jsonValue(), "part_col": self.part_col, "slot": self.slot,
            "epoch": self.epoch, "loads": loads, "cut": sorted(self.cut), "extra": self.extra,
        })

    @staticmethod
    def from_json(text: str) -> TableState:
        d = json.loads(text)
        leaves = frozenset(Leaf(v, p, b) for v, parts in d["loads"].items() for p, buckets in parts.items() for b in buckets)
        schema = T.StructType.fromJson(d["schema"]) if d["schema"] else None
        return TableState(d["version"], schema, d["part_col"], d["slot"], d["epoch"], leaves, frozenset(map(tuple, d["cut"])), d["extra"])


@dataclass
class Load:
    """Rows written but not part of the table yet. ``rows`` counts the new ones, not those carried over."""
    name: str
    rows: int
    leaves: frozenset[Leaf]
    schema: T.StructType
    part_col: str | None

    def epochs(self) -> set[int]:
        return {int(leaf.part) for leaf in self.leaves if leaf.part.lstrip("-").isdigit()}


def watermark_upsert(current: DataFrame, updates: DataFrame) -> DataFrame:
    """S-08 as a relation: rows of ``updates`` replace same-named rows of ``current``.

    A NULL in an update keeps the current value of that column.
    """
    u = updates.select("tablename", F.col("last_slot_no").alias("_s"), F.col("last_epoch_no").alias("_e"))
    return (current.join(u, "tablename", "full_outer")
            .select("tablename", F.coalesce("_s", "last_slot_no").alias("last_slot_no"),
                    F.coalesce("_e", "last_epoch_no").alias("last_epoch_no")))


class Warehouse:
    """Versioned Parquet tables under ``root``."""

    VERSIONS_KEPT = 10
    RETRIES = 20

    def __init__(self, spark: SparkSession, root: str, chunk_rows: int = 50_000, bucket_slots: int = 10_000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.chunk_rows = chunk_rows
        self.bucket_slots = bucket_slots
        #: Called with the name of each step of a commit; tests raise in it.
        self.on_step: Callable[[str], None] = lambda step: None
        self._staged: dict[str, T.StructType] = {}
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- files ---------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def staging(self, table: str, kind: str) -> str:
        return f"{self.root}/_staging/{table}/{kind}"

    def _fs(self, p: str):
        path = self._Path(p)
        return path.getFileSystem(self._conf), path

    def exists(self, p: str) -> bool:
        fs, path = self._fs(p)
        return fs.exists(path)

    def delete(self, p: str) -> None:
        fs, path = self._fs(p)
        if fs.exists(path):
            fs.delete(path, True)

    def _names(self, p: str) -> list[str]:
        fs, path = self._fs(p)
        return [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []

    def _read_text(self, p: str) -> str:
        fs, path = self._fs(p)
        reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    def _create_once(self, p: str, text: str) -> bool:
        """Create ``p`` with ``text``, whole; False if it is there already. The check and the creation are one step:
        a hard link on a local folder, elsewhere the file system's rename that doesn't replace."""
        fs, path = self._fs(p)
        fs.mkdirs(path.getParent())
        draft = self._Path(f"{path.getParent().toString()}/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getScheme() == "file":
                try:
                    os.link(draft.toUri().getPath(), path.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            if fs.exists(path):
                return False
            try:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self._conf)
                none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(draft, path, none)
            except Py4JJavaError as e:
                if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                    return False
                raise
            return True
        finally:
            fs.delete(draft, False)

    def has_data(self, p: str) -> bool:
        """Any data file below ``p`` (listing; names starting with ``_`` or ``.`` are not data)."""
        fs, path = self._fs(p)
        if not fs.exists(path):
            return False
        it = fs.listFiles(path, True)
        while it.hasNext():
            name = it.next().getPath().getName()
            if not name.startswith(("_", ".")):
                return True
        return False

    # -- versions ------------------------------------------------------------
    def _versions(self, table: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path(table)}/_versions") if n.endswith(".json") and n[:-5].isdigit())

    def _version_file(self, table: str, version: int) -> str:
        return f"{self.path(table)}/_versions/{version:012d}.json"

    def state(self, table: str) -> TableState:
        versions = self._versions(table)
        return TableState.from_json(self._read_text(self._version_file(table, versions[-1]))) if versions else TableState()

    def _leaf_path(self, table: str, state: TableState | Load, leaf: Leaf) -> str:
        base = f"{self.path(table)}/_v={leaf.load}"
        return f"{base}/{state.part_col}={leaf.part}/_bucket={leaf.bucket}" if state.part_col else base

    def write_load(self, table: str, rows: DataFrame, part_col: str | None, carried: DataFrame | None = None, columns: list[str] | None = None, window: bool = False) -> Load:
        """Write ``rows``, and ``carried`` ones of the table itself, as a new load that no version names yet.

        Leaves whose size is bounded, by the slots of a bucket or as a ``window``, are written by one task each;
        others are rebalanced, which splits large epochs again.
        """
        obs = Observation(f"{table}-{uuid.uuid4().hex[:8]}")
        if columns:
            rows = rows.select(*columns)
        rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"))
        if carried is not None:
            rows = rows.unionByName(carried.select(*rows.columns))
        if part_col:
            rows = rows.withColumn("_bucket", self.bucket(table, rows))
        schema, name = rows.schema, uuid.uuid4().hex
        path = f"{self.path(table)}/_v={name}"
        if part_col:  # else every task opens a file for each epoch it holds
            slot = [c for c in [self.slot_col(table)] if c in rows.columns]
            tasks = max(self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            rows = rows.repartition(tasks, part_col, "_bucket") if slot or window else rows.hint("rebalance", part_col, "_bucket")
            rows = rows.sortWithinPartitions(part_col, "_bucket", *slot)
        writer = rows.write.partitionBy(part_col, "_bucket") if part_col else rows.write
        with shuffles_dropped(rows.sparkSession):
            writer.mode("errorifexists").parquet(path, compression=CODEC)
        self.on_step("written")
        leaves = {Leaf(name, "", 0)}
        if part_col:
            parts = [n for n in self._names(path) if n.startswith(f"{part_col}=")]
            leaves = {Leaf(name, p[len(part_col) + 1 :], int(b[8:])) for p in parts for b in self._names(f"{path}/{p}") if b.startswith("_bucket=")}
        return Load(name, int(observed(obs).get("rows", 0)), frozenset(leaves), schema, part_col)

    def discard(self, table: str, load: Load) -> None:
        self.delete(f"{self.path(table)}/_v={load.name}")

    def publish(self, table: str, base: TableState, load: Load | None = None, drop: Iterable[Leaf] = (), slot: int | None = None,
                epoch: int | None = None, extra: dict | None = None, cut: Iterable[tuple[str, str]] = ()) -> TableState:
        """The version after ``base``: without the leaves ``drop``, with those of ``load``; None keeps a watermark.
        ``cut`` names (load, part) folders of the load that hold more than its leaves.

        Raises ``CommitConflict``, and discards the load, if ``base`` is no longer the newest version.
        """
        drop, new = frozenset(drop), frozenset() if load is None else load.leaves
        leaves = (base.leaves - drop) | new
        live = {leaf.load for leaf in leaves}
        state = TableState(
            base.version + 1, base.schema if load is None else load.schema, base.part_col if load is None else load.part_col,
            base.slot if slot is None else slot, base.epoch if epoch is None else epoch, leaves,
            frozenset(c for c in base.cut | frozenset(cut) | {(x.load, x.part) for x in drop} if c[0] in live), base.extra | (extra or {}),
        )
        self.on_step("publish")
        if not self._create_once(self._version_file(table, state.version), state.to_json()):
            if load is not None:
                self.discard(table, load)
            raise CommitConflict(f"{table}: version {state.version} is there already")
        self.on_step("published")
        self._expire(table, state.version)
        return state

    def _expire(self, table: str, newest: int) -> None:
        """Versions beyond the last ones go, with the leaves that the version after them dropped. Other jobs may do so at
        the same time; whoever deleted a version's file had deleted its leaves before."""
        for old in [v for v in self._versions(table) if v <= newest - self.VERSIONS_KEPT]:
            try:
                state, after = (TableState.from_json(self._read_text(self._version_file(table, v))) for v in (old, old + 1))
            except Py4JJavaError as e:
                if "FileNotFound" not in str(e.java_exception.getClass().getName()):
                    raise
                continue
            for leaf in state.leaves - after.leaves:
                self.delete(self._leaf_path(table, state, leaf))
            for load in {x.load for x in state.leaves} - {x.load for x in after.leaves}:
                self.delete(f"{self.path(table)}/_v={load}")
            self.delete(self._version_file(table, old))

    def remove_strays(self, table: str) -> list[str]:
        """Delete loads that no kept version names: what failed jobs left. Not while a job writes the table."""
        named = {leaf.load for v in self._versions(table) for leaf in TableState.from_json(self._read_text(self._version_file(table, v))).leaves}
        strays = [n[3:] for n in self._names(self.path(table)) if n.startswith("_v=") and n[3:] not in named]
        for load in strays:
            self.delete(f"{self.path(table)}/_v={load}")
        return strays

    def tables(self) -> list[str]:
        return [n for n in self._names(self.root) if not n.startswith(("_", ".")) and self.exists(f"{self.root}/{n}/_versions")]

    def has(self, table: str) -> bool:
        return self.state(table).schema is not None

    # -- buckets -------------------------------------------------------------
    @staticmethod
    def slot_col(table: str) -> str | None:
        return TABLES[table].slot_col if table in TABLES else "slot_no"

    def bucket(self, table: str, rows: DataFrame) -> Column:
        """The storage bucket of a row: its slot's range, or the window end it was appended with."""
        slot = self.slot_col(table)
        if slot in rows.columns:
            return F.coalesce(F.floor(F.col(slot) / self.bucket_slots), F.lit(NO_SLOT)).cast("bigint")
        if "_batch" in rows.columns:
            return F.coalesce(F.col("_batch"), F.lit(NO_SLOT)).cast("bigint")
        return F.lit(NO_SLOT).cast("bigint")

    # -- reads ---------------------------------------------------------------
    def read(self, table: str, hidden: bool = False, state: TableState | None = None) -> DataFrame:
        state = self.state(table) if state is None else state
        return self.read_leaves(table, state, state.leaves, hidden)

    def read_leaves(self, table: str, state: TableState, leaves: Iterable[Leaf], hidden: bool = True) -> DataFrame:
        """The rows of some leaves of a version. Folders of which all is read are named as a whole."""
        if state.schema is None:
            raise ValueError(f"no table {table} below {self.root}")
        leaves, paths = frozenset(leaves), set()
        partial = {(x.load, x.part) for x in state.leaves - leaves} | state.cut
        loads = {c[0] for c in partial}
        for leaf in leaves:
            base = f"{self.path(table)}/_v={leaf.load}"
            if leaf.load not in loads or not state.part_col:
                paths.add(base)
            elif (leaf.load, leaf.part) not in partial:
                paths.add(f"{base}/{state.part_col}={leaf.part}")
            else:
                paths.add(self._leaf_path(table, state, leaf))
        if paths:
            df = self.spark.read.schema(state.schema).option("basePath", self.path(table)).parquet(*sorted(paths))
        else:
            df = self.spark.createDataFrame([], state.schema)
        return df.select(*[c for c in state.schema.names if hidden or c not in HIDDEN])

    # -- staging -------------------------------------------------------------
    def write_stage(self, df: DataFrame, table: str, kind: str = "stage", part_col: str | None = None) -> int:
        """S-05 + S-04: replace the staging folder; return the rows written."""
        obs = Observation(f"{table}-{kind}-{uuid.uuid4().hex[:8]}")
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        self._staged[self.staging(table, kind)] = df.schema
        w = counted.write.option("maxRecordsPerFile", self.chunk_rows)  # S-07
        w = w.partitionBy(part_col) if part_col else w
        with shuffles_dropped(df.sparkSession):
            w.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.staging(table, kind), compression=CODEC)
        return int(observed(obs).get("rows", 0))

    def read_stage(self, table: str, kind: str = "stage") -> DataFrame:
        path = self.staging(table, kind)
        # an empty stage has no partition folder to infer the partition column from
        df = self.spark.read.parquet(path) if self.has_data(path) else self.spark.createDataFrame([], self._staged[path])
        for c in PART_COLS:
            if c in df.columns:
                df = df.withColumn(c, F.col(c).cast("bigint"))
        return df

    # -- whole-table writes ----------------------------------------------------
    def append(self, table: str, df: DataFrame, part_col: str | None) -> int:
        """S-06, by name."""
        base = self.state(table)
        load = self.write_load(table, df, part_col, columns=self.columns(base))
        self.publish(table, base, load)
        return load.rows

    def overwrite(self, table: str, df: DataFrame, part_col: str | None, slot: int | None = None, epoch: int | None = None) -> int:
        base = self.state(table)
        load = self.write_load(table, df, part_col)
        self.publish(table, base, load, base.leaves, slot, epoch)
        return load.rows

    @staticmethod
    def columns(state: TableState) -> list[str] | None:
        """The columns that rows for the table must have (None: it doesn't exist yet)."""
        return None if state.schema is None else [c for c in state.schema.names if c != "_bucket"]

    # -- watermarks (S-08) ----------------------------------------------------
    def last_index(self) -> DataFrame:
        """One row per table that has a watermark."""
        states = [(t, self.state(t)) for t in self.tables()]
        rows = [(t, s.slot, s.epoch) for t, s in states if s.slot is not None or s.epoch is not None]
        return self.spark.createDataFrame(rows, LAST_INDEX_SCHEMA)

    def annotate(self, table: str, change: Callable[[TableState], TableState]) -> TableState:
        """Publish ``change`` of the newest version without new rows; a lost race is tried again."""
        for _ in range(self.RETRIES):
            base = self.state(table)
            new = change(base)
            try:
                return self.publish(table, replace(base, extra=new.extra), slot=new.slot, epoch=new.epoch)
            except CommitConflict:
                continue
        raise CommitConflict(f"{table}: {self.RETRIES} races lost")

    def set_watermarks(self, updates: DataFrame) -> None:
        for r in updates.collect():  # one row per table
            self.set_watermark(r["tablename"], r["last_slot_no"], r["last_epoch_no"])

    def set_watermark(self, table: str, slot: int | None = None, epoch: int | None = None) -> None:
        """None keeps the current value."""
        self.annotate(table, lambda s: replace(s, slot=s.slot if slot is None else slot, epoch=s.epoch if epoch is None else epoch))

    def watermark(self, table: str) -> tuple[int | None, int | None]:
        s = self.state(table)
        return s.slot, s.epoch

    def partitions(self, path: str, part_col: str) -> set[int]:
        """Partition values present under ``path`` (of a stage), from the folder listing (no Spark job)."""
        values = [n[len(part_col) + 1 :] for n in self._names(path) if n.startswith(f"{part_col}=")]
        return {int(v) if v.lstrip("-").isdigit() else v for v in values}
