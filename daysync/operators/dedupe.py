"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daysync.functions.columns import col, orderable

_RANK = "__rank"


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``order_by``; NULL keys form one key.

    The remaining columns break ties, so the same rows always give the same survivor, also
    when a lost task runs again. Spark limits every map task to one row per key before the
    shuffle, so a key holding most of the rows does not reach one task whole.
    """
    missing = [c for c in (*keys, *order_by) if c not in df.columns]
    if missing or not keys:
        raise ValueError(f"cannot dedupe by {list(keys)}, {list(order_by)}: no column {missing}")
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in order_by and orderable(f.dataType)
    ]
    newest_first = [col(c).desc_nulls_last() for c in (*order_by, *rest)] or [F.lit(0)]
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
