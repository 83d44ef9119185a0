"""Made-up event rows, a number of them for every row of a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.functions.columns import col, event_label, shift_minutes


def uuid_text(hex32: Column) -> Column:
    """32 hex digits in the 8-4-4-4-12 form."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hex32, start, size) for start, size in cuts])


def generate_events(
    base: DataFrame, per_row: int, *, key: str, start: str, random: bool = True
) -> DataFrame:
    """``per_row`` events for each ``base`` row, numbered 1 to ``per_row``.

    ``key`` identifies the base row and ``start`` is the time its events count from.
    With ``random`` the ids and types are drawn anew on every run; without, both follow
    from the key and the number, so a re-run task makes the same rows again.
    """
    n = F.col("seq")
    rows = base.select(
        col(key).alias("base_key"),
        col(start).alias("base_time"),
        F.explode(F.sequence(F.lit(1), F.lit(per_row))).alias("seq"),
    )
    if random:
        event_id = F.uuid()
        type_id = F.floor(F.rand() * 5).cast("bigint")
        minute = F.floor(F.rand() * 10)
    else:
        event_id = uuid_text(F.md5(F.concat_ws(":", F.col("base_key").cast("string"), n.cast("string"))))
        type_id = F.pmod(F.col("base_key") + n, F.lit(5)).cast("bigint")
        minute = F.pmod(n, F.lit(10))
    drawn = rows.select(
        "base_key", "seq", "base_time", event_id.alias("id"), type_id.alias("event_type_id"),
        minute.alias("minute"),
    )
    return drawn.select(
        "id",
        "event_type_id",
        event_label(F.col("event_type_id")).alias("event_type"),
        F.concat(F.lit("Event "), n.cast("string")).alias("description"),
        shift_minutes(F.col("base_time"), F.col("minute")).alias("last_modified"),
    )
