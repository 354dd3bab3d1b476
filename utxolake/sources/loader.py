"""S-01: the source relations as DataFrames.

``load_source`` returns a lazy catalog: relations are read when first asked for,
only the columns a derivation selects reach the scan (column pruning), and
block-window filters push down to the Parquet reader. A JDBC source is read in
parallel ranges of ``id`` (``partitionColumn``) so that no single task pulls a
whole relation.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import shuffles_dropped

#: Of the Parquet files that jobs write: less disk than Spark's default.
CODEC = "zstd"

# The source relations the derivations read.
SOURCE_RELATIONS = [
    "block", "tx", "tx_in", "tx_out", "collateral_tx_in", "stake_address", "pool_hash", "slot_leader",
    "delegation", "multi_asset", "ma_tx_out", "ma_tx_mint", "tx_metadata", "reward", "datum", "script",
    "redeemer_data", "redeemer", "stake_registration", "stake_deregistration", "withdrawal", "epoch_stake",
    "pool_metadata_ref", "pool_update", "pool_retire", "pool_owner", "pool_offline_data", "cost_model",
    "epoch_param", "param_proposal", "ada_pots", "meta", "schema_version",
]


class SourceCatalog(Mapping):
    def __init__(self, spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                 jdbc_url: str | None = None, jdbc_props: dict | None = None,
                 id_bounds: Mapping[str, tuple[int, int]] | None = None, jdbc_partitions: int = 64):
        self.spark, self.path, self.fmt = spark, (path or "").rstrip("/"), fmt
        self.jdbc_url, self.jdbc_props = jdbc_url, jdbc_props or {}
        self.id_bounds = dict(id_bounds or {})
        self.jdbc_partitions = jdbc_partitions
        self._cache: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if self.fmt == "jdbc":
            lo, hi = self.id_bounds.get(name, (None, None))
            if lo is not None:
                return self.spark.read.jdbc(self.jdbc_url, name, column="id", lowerBound=lo, upperBound=hi,
                                            numPartitions=self.jdbc_partitions, properties=self.jdbc_props)
            return self.spark.read.jdbc(self.jdbc_url, name, properties=self.jdbc_props)
        return self.spark.read.format(self.fmt).load(f"{self.path}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._read(name)
        return self._cache[name]

    def __iter__(self):
        return iter(SOURCE_RELATIONS)

    def __len__(self) -> int:
        return len(SOURCE_RELATIONS)


def load_source(spark: SparkSession, path: str | None = None, **kw) -> SourceCatalog:
    return SourceCatalog(spark, path, **kw)


def export_source(src: Mapping[str, DataFrame], path: str, names: list[str], part_col: dict | None = None) -> None:
    """Write relations of a catalog as Parquet folders (how the stand-ins become a source on disk)."""
    for n in names:
        w = src[n].write.mode("overwrite").option("partitionOverwriteMode", "static")
        col = (part_col or {}).get(n)
        (w.partitionBy(col) if col else w).parquet(f"{path.rstrip('/')}/{n}")


class MaterializedCatalog(Mapping):
    """The relations of ``src``, each written once below ``root`` and read back.

    Cuts the lineage of computed sources (a job that derives many windows reads
    Parquet instead of recomputing the relation each time) and survives the
    loss of executors: the files live on shared storage. ``block`` is written
    sorted by slot so that slot windows skip row groups. A source that can (``StandIn.over``) computes
    relations from those written here: what many hang on is computed once. ``columns`` names, per relation, the only
    ones that are asked for, if not all are; every row is written.
    """

    SORT = {"block": ["slot_no"], "tx": ["block_id"]}

    def __init__(self, src: Mapping[str, DataFrame], root: str, columns: Mapping[str, list[str]] | None = None):
        self.columns = dict(columns or {})
        self.src, self.root = src.over(self) if hasattr(src, "over") else src, root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._lock = threading.RLock()  # parallel table jobs ask for the same relations

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            return self._get(name)

    def _get(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.src[name]
            if name in self.columns:
                df = df.select(*self.columns[name])
            if name in self.SORT:
                df = df.sortWithinPartitions(*self.SORT[name])
            path = f"{self.root}/{name}"
            with shuffles_dropped(df.sparkSession):
                df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, compression=CODEC)
            self._cache[name] = df.sparkSession.read.parquet(path)
        return self._cache[name]

    def __iter__(self):
        return iter(SOURCE_RELATIONS)

    def __len__(self) -> int:
        return len(SOURCE_RELATIONS)
