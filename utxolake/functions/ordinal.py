"""Global row ordinal without a single-partition window.

``row_number() over (order by k)`` with no PARTITION BY moves every row into one
task. Here the rows are range-partitioned on the (unique) order key, numbered
inside each partition by ``monotonically_increasing_id`` after a local sort, and
shifted by the row count of all lower partitions. The only global step works on
one row per partition, so its size is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def global_ordinal(df: DataFrame, order_cols: list[str], name: str = "g",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the order of ``order_cols``.

    ``order_cols`` must be a unique key, otherwise ties are numbered arbitrarily.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ordinals(with_position(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)), name)


def with_position(df: DataFrame) -> DataFrame:
    """Rows in partitions that follow each other, with their partition (``_pid``) and place in it (``_local``)."""
    return (
        df.withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_mid")
    )


def ordinals(ranged: DataFrame, name: str = "g") -> DataFrame:
    """``name`` = 1-based position of each row, from ``with_position``. Read twice: cut off computed ranges before."""
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded, broadcast-safe table
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_local") + F.lit(1))
        .drop("_pid", "_local", "_off")
    )
