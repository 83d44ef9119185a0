"""Updates of a whole table or of chosen rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.functions.columns import col
from daysync.operators.joins import KEY_HASH, key_match, keyed
from daysync.operators.merge import kept

_FILE = "__file"
_ROW = "__row"


def update_all(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Set the columns in every row."""
    return df.withColumns(dict(values))


def update_matching(df: DataFrame, key: str, chosen: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Set the columns in the rows whose ``key`` is in the first column of ``chosen``."""
    wanted = chosen.select(col(chosen.columns[0]).cast(df.schema[key].dataType).alias(key)).distinct()
    marked = df.join(keyed(wanted, [key]), key_match([key]), "left")
    hit = F.col(KEY_HASH).isNotNull()
    changed = marked.withColumns({c: F.when(hit, v).otherwise(col(c)) for c, v in values.items()})
    return changed.select(*[col(c) for c in df.columns])


def update_first(
    df: DataFrame, key: str, count: int, values: Mapping[str, Column], then_by: Sequence[str] = ()
) -> DataFrame:
    """Set the columns in the first ``count`` rows by ``key``, then by ``then_by``; NULL keys are none of them.

    Exactly so many rows change, or all with a key if there are fewer. Of rows that tie, those
    that come first in their files do: a row is known by its file and its place in it. A frame
    that does not come from files alone is written to the shared folder once for that.
    """
    try:
        placed = df.select(*[col(c) for c in df.columns], *_place())
    except AnalysisException:
        stored = kept(df)
        placed = stored.select(*[col(c) for c in stored.columns], *_place())
    first = placed.where(col(key).isNotNull()).orderBy(col(key), *[col(c) for c in then_by], _FILE, _ROW).limit(count)
    wanted = keyed(first.select(_FILE, _ROW), [_FILE, _ROW])
    marked = placed.join(wanted, key_match([_FILE, _ROW]), "left")
    hit = F.col(KEY_HASH).isNotNull()
    changed = marked.withColumns({c: F.when(hit, v).otherwise(col(c)) for c, v in values.items()})
    return changed.select(*[col(c) for c in df.columns])


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW)]
