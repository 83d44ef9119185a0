"""Equi-joins, and the form of key comparison the merge operators share."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.functions.columns import all_of, col

KEY_HASH = "__key_hash"
_KEY = "__key_{}"
_VALUE = "__value_{}"


def keyed(df: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """One side of a ``key_match``: keys and values under names no table has.

    ``KEY_HASH`` is never NULL, so after an outer join it tells the matched rows.
    """
    return df.select(
        *[col(k).alias(_KEY.format(i)) for i, k in enumerate(keys)],
        _key_hash(keys).alias(KEY_HASH),
        *[col(v).alias(_VALUE.format(i)) for i, v in enumerate(values)],
    )


def value(values: Sequence[str], name: str) -> Column:
    """The column of a ``keyed`` frame that holds ``name``."""
    return F.col(_VALUE.format(list(values).index(name)))


def unkeyed(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The frame ``keyed`` was made from."""
    return df.select(
        *[F.col(_KEY.format(i)).alias(k) for i, k in enumerate(keys)],
        *[F.col(_VALUE.format(i)).alias(v) for i, v in enumerate(values)],
    )


def key_match(keys: Sequence[str], null_safe: Collection[str] = ()) -> Column:
    """Join condition between a table and a ``keyed`` frame; in ``null_safe`` NULL equals NULL.

    The hash of the keys is one more join column. Aggregated or deduplicated inputs are
    already partitioned by the keys alone, and Spark would join them in place; with the
    hash they pass an exchange of their own, and adaptive execution can split the part of
    one hot key, which it only does directly above an exchange. It comes first, as rows
    are sorted faster by a number that differs than by keys that begin alike.
    """
    pairs = [(k, F.col(_KEY.format(i))) for i, k in enumerate(keys)]
    same = [col(k).eqNullSafe(other) if k in null_safe else col(k) == other for k, other in pairs]
    return all_of([_key_hash(keys) == F.col(KEY_HASH), *same])


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def merge_on(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    *,
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: bool = False,
) -> DataFrame:
    """Inner join showing each key once; other clashing names get a suffix per side.

    A NULL key matches nothing, as in SQL. With ``null_safe`` it matches every NULL key, which
    gives a row for each pair of them.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    pairs = [(col(k, "l"), col(k, "r")) for k in keys]
    joined = left.alias("l").join(
        right.alias("r"), all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    )

    def rest(df: DataFrame, side: str, suffix: str) -> list[Column]:
        return [
            col(c, side).alias(c + suffix if c in clash else c) for c in df.columns if c not in keys
        ]

    return joined.select(
        *[col(k, "l").alias(k) for k in keys],
        *rest(left, "l", suffixes[0]),
        *rest(right, "r", suffixes[1]),
    )
