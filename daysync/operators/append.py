"""Rows of one frame after those of another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from daysync.operators.schema import conform


def append_by_name(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` appended to ``table``; columns they lack are NULL, unknown ones an error."""
    unknown = [c for c in rows.columns if c not in table.columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the table")
    return table.unionByName(conform(rows, table))


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns by name."""
    return reduce(DataFrame.unionByName, frames)
