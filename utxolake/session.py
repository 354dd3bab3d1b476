"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back: jobs take the
session they are given. ``local_session`` is a convenience for tests, the
bench and the examples; on a cluster the operator passes its own session.
"""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on. All are plain session confs, so they
# can be applied to a session someone else built (``apply_defaults``).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts are decided by AQE from runtime sizes; this is the size check.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SQL_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep the owner's value
            pass
    return spark


_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_held: dict[tuple, list] = {}  # by session and purpose: users, and the settings to put back
_held_lock = threading.Lock()


@contextmanager
def _meanwhile(spark: SparkSession, purpose: str, settings: Callable[[], dict[str, str]]) -> Iterator[None]:
    """Settings that hold while any user of ``purpose`` is inside: the first sets them, the last puts the old ones back."""
    key = (spark._jsparkSession.hashCode(), purpose)
    with _held_lock:
        if key not in _held:
            new = settings()
            _held[key] = [0, {k: spark.conf.get(k) for k in new}]
            for k, v in new.items():
                spark.conf.set(k, v)
        _held[key][0] += 1
    try:
        yield
    finally:
        with _held_lock:
            _held[key][0] -= 1
            if not _held[key][0]:
                for k, v in _held.pop(key)[1].items():
                    spark.conf.set(k, v)


def shared_broadcasts(spark: SparkSession, jobs: int) -> AbstractContextManager[None]:
    """While ``jobs`` Spark jobs run at once, each may broadcast its share of the session's limit.

    The driver builds every relation that is broadcast, so side by side they would take it ``jobs`` times the memory of
    one. Larger sides are shuffled. Jobs that come in meanwhile find the share set and leave it.
    """
    def shares() -> dict[str, str]:
        out = {}
        for k in _BROADCAST:
            v = spark.conf.get(k, None)
            if v is not None and not v.startswith("-"):
                limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(v)
                if limit > 0:
                    out[k] = str(max(1, limit // max(1, jobs)))
        return out

    return _meanwhile(spark, "broadcasts", shares)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Meanwhile a query's shuffle files go with its end, not when the driver next collects garbage.

    So a job of many queries takes the disk of those that run at once, not of all it has run. Rows that are
    read again must have been written: a plan that runs a second time shuffles again.
    """
    return _meanwhile(spark, "shuffles", lambda: {_CLEANUP: "true"})


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "utxolake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.ansi.enabled", "false")
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session with a local master may lack one; it gets a fresh scratch folder. Executors on
    other machines would not see that, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="utxolake-ckpt-")
    sc.setCheckpointDir(path)
    return path
