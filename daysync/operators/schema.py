"""Schemas as rows, the drift between two sides, and additive evolution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.columns import col
from daysync.functions.shapes import alike, changes, fits, reshaped, united, widens  # noqa: F401  widens had its place here
from daysync.sources.shards import SHARD, per_day

Schemas = Mapping[str, T.StructType]

_CHANGE = ("path", "source_type", "target_type", "change")


def _listed(schema: T.StructType) -> Column:
    fields = [f for f in schema.fields if f.name != SHARD]
    return F.array(*[
        F.struct(
            F.lit(i).alias("pos"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")
        )
        for i, f in enumerate(fields, start=1)
    ])


def schema_rows(df: DataFrame, side: str, schemas: Schemas | None = None) -> DataFrame:
    """One row ``(side, shard, pos, name, type)`` per column that a day of ``df`` declares.

    Declared are the columns ``schemas`` has for the day (see ``tables.shard_schemas``), else
    those of ``df``. Of the rows only the shard is read, to know the days.
    """
    listed = per_day({day: _listed(schema) for day, schema in (schemas or {}).items()}, _listed(df.schema))
    days = df.select(SHARD).distinct().select(SHARD, F.explode(listed).alias("f"))
    return days.select(F.lit(side).alias("side"), SHARD, "f.pos", "f.name", "f.type")


def drift(
    source: DataFrame, target: DataFrame, source_schemas: Schemas | None = None, target_schemas: Schemas | None = None
) -> DataFrame:
    """How the target's columns differ from the source's, per shard both sides have.

    ``added`` is in the source only, ``removed`` in the target only, ``type_changed`` in
    both with different types. Same columns give no row. Columns are those each day
    declares, as for ``schema_rows``; what is joined is one row per day and column.
    """
    sides = [
        schema_rows(df, name, schemas).select(SHARD, "name", F.col("type").alias(f"{name}_type"))
        for df, name, schemas in ((source, "source", source_schemas), (target, "target", target_schemas))
    ]
    both = source.select(SHARD).distinct().join(target.select(SHARD).distinct(), SHARD)
    change = (
        F.when(F.col("target_type").isNull(), "added")
        .when(F.col("source_type").isNull(), "removed")
        .otherwise("type_changed")
    )
    return (
        sides[0].join(sides[1], [SHARD, "name"], "full_outer")
        .where(~F.col("source_type").eqNullSafe(F.col("target_type")))
        .join(both, SHARD, "left_semi")
        .withColumn("change", change)
    )


def nested_drift(
    source: DataFrame, target: DataFrame, source_schemas: Schemas | None = None, target_schemas: Schemas | None = None
) -> DataFrame:
    """``drift`` by path: ``(shard, path, source_type, target_type, change)``, fields of fields too.

    A path goes through ``element`` of arrays, ``key`` and ``value`` of maps. Of a field that one
    side lacks, or has as another kind, what lies in it is not listed. What differs follows from
    the declared columns; of the rows only the shards are read, to know the days of both sides.
    """
    mine, theirs = source_schemas or {}, target_schemas or {}

    def listed(day: str | None) -> Column:
        sides = [
            T.StructType([f for f in schemas.get(day, df.schema).fields if f.name != SHARD])
            for schemas, df in ((mine, source), (theirs, target))
        ]
        rows = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(_CHANGE, c, strict=True)]) for c in changes(*sides)]
        kind = "array<struct<" + ",".join(f"{n}:string" for n in _CHANGE) + ">>"
        return F.array(*rows).cast(kind)

    both = source.select(SHARD).distinct().join(target.select(SHARD).distinct(), SHARD, "left_semi")
    found = per_day({day: listed(day) for day in dict.fromkeys([*mine, *theirs])}, listed(None))
    return both.select(SHARD, F.explode(found).alias("c")).select(SHARD, "c.*")


def empty_clone(df: DataFrame) -> DataFrame:
    """The columns without the rows; nothing is scanned."""
    return df.limit(0)


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` plus the columns, and fields within columns, only ``source`` has, NULL in existing rows."""
    have = {c.lower(): c for c in target.columns}
    kept = {f.name: col(f.name) for f in target.schema.fields}
    added = []
    for f in source.schema.fields:
        name = have.get(f.name.lower())
        if name is None:
            added.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif name != f.name:
            raise ValueError(f"columns {name} and {f.name} differ in case only")
        else:
            mine = target.schema[name].dataType
            wide = united(mine, f.dataType)
            if not alike(mine, wide):
                kept[name] = reshaped(col(name), mine, wide).alias(name)
    return target.select(*kept.values(), *added)


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the columns, order and types of ``target``.

    Columns, and fields within columns, the source lacks are NULL. A source type that does not fit the target's
    without loss is refused: a merge never changes the type of a target column.
    """
    types = {f.name: f.dataType for f in source.schema.fields}
    out = []
    for f in target.schema.fields:
        if f.name not in types:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif alike(types[f.name], f.dataType):
            out.append(col(f.name))
        elif fits(types[f.name], f.dataType):
            out.append(reshaped(col(f.name), types[f.name], f.dataType).alias(f.name))
        else:
            raise ValueError(
                f"column {f.name}: source {types[f.name].simpleString()} does not fit "
                f"target {f.dataType.simpleString()}"
            )
    return source.select(*out)
