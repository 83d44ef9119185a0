"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node that is not the smallest of its component.

    ``component`` is the smallest node that links lead to. Links with a null end or to the
    node itself count for nothing; an empty table gives none.

    Each round hangs every node on its smallest neighbour, follows these pointers to their
    roots, and replaces the ends of all links by roots. Every node with a smaller neighbour
    is gone after a round, so few rounds are needed. Only tables of links are moved; a node
    with very many links is split by adaptive joins, and minima are taken before shuffling.
    """
    links = stored(
        links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where("lo < hi").distinct()
    )
    found: DataFrame | None = None
    while not links.isEmpty():
        roots = _roots(stored(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))))
        if found is None:
            found = roots
        else:
            newer = roots.select(F.col("node").alias("root"), F.col("root").alias("newer"))
            found = found.join(newer, "root", "left").select("node", F.coalesce("newer", "root").alias("root"))
            found = stored(found.unionByName(roots.join(found, "node", "left_anti")))
        low = roots.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        high = roots.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
        ends = links.join(low, "lo", "left").join(high, "hi", "left")
        ends = ends.select(F.coalesce("lo_root", "lo").alias("x"), F.coalesce("hi_root", "hi").alias("y"))
        links = stored(
            ends.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
            .where("lo < hi").distinct()
        )
    if found is None:
        return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return found.select("node", F.col("root").alias("component"))


def _roots(parents: DataFrame) -> DataFrame:
    """Follows pointers until each names a root; every step halves the way that is left."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        if parents.join(above, "root", "left_semi").isEmpty():
            return parents
        parents = stored(
            parents.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        )
