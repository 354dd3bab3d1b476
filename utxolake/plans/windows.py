"""Planning as relations: source head, slot windows, due epochs, backfill prefix.

W-01, W-02, P-01 and the contiguous-prefix test of B-01 are column arithmetic
over tiny relations (one row per target table, one row per epoch); the jobs
read the resulting plan, which has a proven size bound (tables x rounds).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import SLOT_APPEND


@dataclass(frozen=True)
class SlotWindowConfig:
    """Fixed values of the reference deployment: cap 10,000 slots, hold-back 60,
    re-derivation 200, at most 3 rounds per run."""
    cap: int = 10_000
    grace: int = 60
    delete: int = 200
    rounds: int = 3


def source_head(blocks: DataFrame) -> DataFrame:
    """W-01: ``head_slot_no, head_epoch_no`` (one row)."""
    return blocks.agg(F.max("slot_no").alias("head_slot_no"), F.max("epoch_no").alias("head_epoch_no"))


def plan_slot_windows(last_index: DataFrame, head: DataFrame, cfg: SlotWindowConfig = SlotWindowConfig()
                      ) -> DataFrame:
    """W-02: one row per table and round while the table is due.

    round k starts at ``last_k`` (the previous round's ``max``):
    ``curr = min(head, last_k + cap)``, ``max = curr - grace``,
    ``clean = last_k - delete`` (append tables re-derive nothing: ``clean = last_k``).
    Due while ``last_k < head - grace``; ``error`` when the head is behind the watermark.
    """
    step = F.lit(cfg.cap - cfg.grace)
    rounds = (last_index.crossJoin(F.broadcast(head))  # head is one row
              .withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(cfg.rounds)))))
    last_k = F.col("last_slot_no") + (F.col("round") - 1) * step
    curr = F.least(F.col("head_slot_no"), last_k + cfg.cap)
    append = F.col("tablename").isin(sorted(SLOT_APPEND))
    plan = rounds.select(
        "tablename", "round", last_k.alias("last_slot_no"), "head_slot_no",
        F.when(append, last_k).otherwise(last_k - cfg.delete).alias("clean_slot_no"),
        (curr - cfg.grace).alias("max_slot_no"),
        (F.col("head_slot_no") < F.col("last_slot_no")).alias("error"),
    )
    # round k is due only if every earlier round was capped (did not reach the head)
    return plan.where(F.col("last_slot_no") < F.col("head_slot_no") - cfg.grace)


def plan_epochs(last_index: DataFrame, head: DataFrame, closed: list[str], catch_up: bool = True) -> DataFrame:
    """P-01: ``tablename, epoch_no, next_last_epoch_no`` for every epoch to load.

    *next* tables load ``last + 1``; *closed* tables the newest complete epoch
    ``head - 1`` or, with ``catch_up`` (mode closed_all), every epoch from
    ``last + 1`` to ``head - 1``. Due only when ``head > last``.
    """
    li = last_index.crossJoin(F.broadcast(head)).where(F.col("head_epoch_no") > F.col("last_epoch_no"))
    is_closed = F.col("tablename").isin(sorted(closed))
    lo = F.when(is_closed & F.lit(not catch_up), F.col("head_epoch_no") - 1).when(
        is_closed, F.col("last_epoch_no") + 1).otherwise(F.col("last_epoch_no") + 1)
    hi = F.when(is_closed, F.col("head_epoch_no") - 1).otherwise(F.col("last_epoch_no") + 1)
    return li.select(
        "tablename", F.explode(F.sequence(lo, F.greatest(lo, hi))).alias("epoch_no"),
        hi.alias("next_last_epoch_no"), lo.alias("_lo"), hi.alias("_hi"),
    ).where(F.col("_lo") <= F.col("_hi")).drop("_lo", "_hi")


def contiguous_epochs(df: DataFrame, start: int, epoch_col: str = "epoch_no") -> DataFrame:
    """B-01: epochs ``start, start+1, ...`` present in ``df`` up to the first gap.

    Gaps-and-islands over the distinct epochs (one row per epoch, so the global
    window works on a bounded relation).
    """
    epochs = df.where(F.col(epoch_col) >= start).select(F.col(epoch_col).alias("epoch_no")).distinct()
    w = Window.orderBy("epoch_no")
    return (epochs.withColumn("_island", F.col("epoch_no") - F.row_number().over(w))
            .where(F.col("_island") == start - 1).select("epoch_no"))
