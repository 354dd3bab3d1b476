"""Ordered list aggregation and list splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_list(sort_keys: list[Column], value: Column) -> Column:
    """``array_agg(value ORDER BY sort_keys)`` as an aggregate expression.

    The sort keys travel inside the collected struct (``k0, k1, ...``), the array
    is sorted by them and then reduced to the values. Empty group -> NULL is the
    caller's business (a group always has one row).
    """
    keyed = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys)], value.alias("v"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["v"])


def sorted_structs(by: list[str], fields: list[str] | None = None) -> Column:
    """``array_agg(struct(fields) ORDER BY by)`` where the sort keys ``by`` are all the fields, in another order or not.

    Unlike in ``ordered_list`` no column is collected twice.
    """
    arr = F.array_sort(F.collect_list(F.struct(*by)))
    if fields is None or fields == by:
        return arr
    return F.transform(arr, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def split_long_list(df: DataFrame, col: str, max_len: int = 1000, pos_col: str = "part") -> DataFrame:
    """S-09: a row whose list holds more than ``max_len`` items becomes
    ceil(n / max_len) rows with consecutive slices; other rows (also empty and
    NULL lists) stay one row. A scalar string counts as a one-item list.
    ``pos_col`` numbers the slices from 0.
    """
    field = df.schema[col].dataType.typeName()
    arr = F.array(F.col(col)) if field == "string" else F.col(col)
    n = F.size(arr)
    starts = F.sequence(F.lit(0), F.floor((n - 1) / F.lit(max_len)).cast("int"))
    slices = F.when(arr.isNull() | (n <= max_len), F.array(arr)).otherwise(
        F.transform(starts, lambda i: F.slice(arr, i * max_len + 1, max_len))
    )
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(slices).alias(pos_col, col)).select(*df.columns, pos_col)
