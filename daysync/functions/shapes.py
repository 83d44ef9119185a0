"""Types of columns, whole and by path: what fits, what differs, and values brought into another shape."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_WIDER = {
    T.ByteType: (*_INTEGERS[1:], T.FloatType, T.DoubleType),
    T.ShortType: (*_INTEGERS[2:], T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}

# Digits that the whole numbers of a type may have.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

_PLAIN = re.compile(r"\w+")

Change = tuple[str, str | None, str | None, str]


def widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every ``source`` value has an exact ``target`` value."""
    if isinstance(target, T.DecimalType):
        if isinstance(source, T.DecimalType):
            scale, digits = source.scale, source.precision - source.scale
        else:
            scale, digits = 0, _DIGITS.get(type(source), 99)
        return target.scale >= scale and target.precision - target.scale >= digits
    return source == target or type(target) in _WIDER.get(type(source), ())


def parts(kind: T.DataType) -> dict[str, T.DataType] | None:
    """The types within a type, by name: fields, ``element``, or ``key`` and ``value``; None if it has none."""
    if isinstance(kind, T.StructType):
        return {f.name: f.dataType for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return {"element": kind.elementType}
    if isinstance(kind, T.MapType):
        return {"key": kind.keyType, "value": kind.valueType}
    return None


def _both(a: T.DataType, b: T.DataType) -> tuple[dict[str, T.DataType], dict[str, T.DataType]] | None:
    """The parts of two types of one kind; None where there are none to compare."""
    return (parts(a), parts(b)) if type(a) is type(b) and parts(a) is not None else None


def alike(a: T.DataType, b: T.DataType) -> bool:
    """Whether two types are the same, order of fields included, but for what may be NULL."""
    both = _both(a, b)
    if both is None:
        return a == b
    return list(both[0]) == list(both[1]) and all(alike(x, y) for x, y in zip(*map(dict.values, both), strict=True))


def fits(source: T.DataType, target: T.DataType) -> bool:
    """Whether every ``source`` value has a place in ``target``: no field too many, no value that loses."""
    both = _both(source, target)
    if both is None:
        return widens(source, target)
    return all(name in both[1] and fits(kind, both[1][name]) for name, kind in both[0].items())


def united(have: T.DataType, more: T.DataType, *, widen: bool = False) -> T.DataType:
    """``have`` plus, at any depth, the fields only ``more`` has.

    Values keep the type of ``have``, whether or not those of ``more`` fit; with ``widen`` the wider
    of both types is taken and it is an error if there is none. Fields whose names differ in case
    only are an error.
    """
    both = _both(have, more)
    if both is None:
        if not widen or widens(more, have):
            return have
        if widens(have, more):
            return more
        raise ValueError(f"{have.simpleString()} and {more.simpleString()} do not fit")
    mine, theirs = both
    merged = {name: united(kind, theirs[name], widen=widen) if name in theirs else kind for name, kind in mine.items()}
    if isinstance(have, T.ArrayType):
        return T.ArrayType(merged["element"])
    if isinstance(have, T.MapType):
        return T.MapType(merged["key"], merged["value"])
    folded = {name.lower(): name for name in mine}
    for name, kind in theirs.items():
        if folded.get(name.lower(), name) != name:
            raise ValueError(f"fields {folded[name.lower()]} and {name} differ in case only")
        merged.setdefault(name, kind)
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])


def reshaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type ``have`` as ``want``, a type it ``fits``: fields it lacks are NULL, a NULL stays NULL."""
    if alike(have, want):
        return value
    both = _both(have, want)
    if both is None:
        return value.cast(want)
    mine, wanted = both
    if isinstance(want, T.StructType):
        fields = [
            (reshaped(value.getField(n), mine[n], kind) if n in mine else F.lit(None).cast(kind)).alias(n)
            for n, kind in wanted.items()
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda v: reshaped(v, mine["element"], wanted["element"]))
    if alike(mine["key"], wanted["key"]):
        return F.transform_values(value, lambda _, v: reshaped(v, mine["value"], wanted["value"]))
    entries = F.transform(
        F.map_entries(value),
        lambda e: F.struct(*[reshaped(e[n], mine[n], wanted[n]).alias(n) for n in ("key", "value")]),
    )
    return F.map_from_entries(entries)


def changes(source: T.DataType, target: T.DataType, path: str = "") -> list[Change]:
    """``(path, source type, target type, change)`` of what differs, outermost places only.

    A field that one side lacks is one change, whatever is in it, and so is a place with a value of
    another kind. The order of fields is no difference.
    """
    both = _both(source, target)
    if both is None:
        return [] if source == target else [(path, source.simpleString(), target.simpleString(), "type_changed")]
    mine, theirs = both
    found: list[Change] = []
    for name in dict.fromkeys([*mine, *theirs]):
        shown = name if _PLAIN.fullmatch(name) else f"`{name.replace('`', '``')}`"
        inner = f"{path}.{shown}" if path else shown
        if name not in theirs:
            found.append((inner, mine[name].simpleString(), None, "added"))
        elif name not in mine:
            found.append((inner, None, theirs[name].simpleString(), "removed"))
        else:
            found += changes(mine[name], theirs[name], inner)
    return found
