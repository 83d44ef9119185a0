"""Whole rows as one value: their text, digest, and the checksum of many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.columns import col

# Nothing of a value is lost in its text.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_EXACT = {"ignoreNullFields": "false", "timestampFormat": f"{_MICROS}XXX", "timestampNTZFormat": _MICROS}


def row_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns' values as text, equal for equal rows and for them alone."""
    parts = [_canonical(col(c), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(columns)]
    return F.to_json(F.struct(*parts), _EXACT)


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """The SHA-256 of ``row_json``."""
    return F.unhex(F.sha2(row_json(df, columns), 256))


def checksum(df: DataFrame, columns: Sequence[str]) -> Column:
    """An aggregate over rows whose order does not matter, and which every task begins by itself.

    Number of rows, sum and exclusive or of their hashes, by columns in the order of their names.
    """
    names = sorted(columns)
    h = F.xxhash64(F.lit("|".join(names)), row_json(df, names))
    total = F.sum(h.cast("decimal(20,0)"))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), total.cast("string"), F.bit_xor(h).cast("string"))


def _canonical(value: Column, kind: T.DataType) -> Column:
    """A value such that equal ones have one text: maps as sorted entries, no negative zero."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value + F.lit(0.0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _canonical(x, kind.elementType))
    if isinstance(kind, T.StructType):
        inner = [_canonical(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(_canonical(e["key"], kind.keyType).alias("k"), _canonical(e["value"], kind.valueType).alias("v")),
        )
        # Ordered by their text, as values of some types have no order.
        return F.array_sort(F.transform(entries, lambda e: F.to_json(F.struct(e.alias("e")), _EXACT)))
    return value
