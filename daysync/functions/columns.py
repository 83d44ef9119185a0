"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01 00:00:00"

# event_type_id 0 to 3 in order, then the label of every other id.
EVENT_LABELS = ("login", "logout", "purchase", "click")
OTHER_EVENT_LABEL = "view"


def col(name: str, side: str | None = None) -> Column:
    """The column called exactly ``name``, dots included, optionally of an aliased side."""
    quoted = f"`{name.replace('`', '``')}`"
    return F.col(f"{side}.{quoted}" if side else quoted)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def shard_of(moment: Column) -> Column:
    """``yyyyMMdd`` of a date or timestamp.

    Goes through DATE, so a TIMESTAMP_NTZ never meets the session time zone.
    """
    return F.translate(F.to_date(moment).cast("string"), "-", "")


def shard_name(prefix: str, moment: Column) -> Column:
    """The name a day's own table would have, such as ``events_20240130``."""
    return F.concat(F.lit(f"{prefix}_"), shard_of(moment))


def shift_days(moment: Column, days: int) -> Column:
    return moment + F.make_dt_interval(days=F.lit(days))


def shift_minutes(moment: Column, minutes: Column) -> Column:
    return moment + F.make_dt_interval(mins=minutes.cast("int"))


def row_text(columns: Iterable[str]) -> Column:
    """All columns as one string, NULL written as ``NULL``, nothing in between.

    Different rows can share this text (``'a','bc'`` and ``'ab','c'``), so it is for
    display. ``merge.insert_new_rows`` compares the columns themselves.
    """
    return F.concat(*[F.coalesce(col(c).cast("string"), F.lit("NULL")) for c in columns])


def event_label(type_id: Column) -> Column:
    label = F
    for i, name in enumerate(EVENT_LABELS):
        label = label.when(type_id == i, name)
    return label.otherwise(OTHER_EVENT_LABEL)


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort by the type."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))
