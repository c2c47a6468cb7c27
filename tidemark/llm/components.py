"""Connected components of a link table, by alternating stars.

Each round every vertex hands the smallest vertex it sees to its larger neighbours, then to the
smaller ones, until links only join a component's vertices to its smallest one. Rounds are
logarithmic in the number of links; every round is written to the shared folder, so a lost
executor costs one round. Smallest neighbours are aggregated before the shuffle and the join
back can be split by Spark, so a vertex with very many links does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written


def _star(links: DataFrame) -> DataFrame:
    """Every (u, v) becomes (v, m) with m the smallest of u and its neighbours; plus (u, m)."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(least, "u")


def _is_stars(links: DataFrame) -> bool:
    """Each vertex has one link, and it leads to a vertex that has none."""
    if links.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        return False
    return not links.join(links.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(id, component) for each vertex of `links` (a, b); component is the smallest id reachable."""
    current = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), name
    )
    while not _is_stars(current):
        both = current.union(current.select("v", "u"))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        starred = _star(large)
        small = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            starred.select("u", F.col("m").alias("v"))
        )
        current = written(small.filter("u != v").distinct(), name)
    result = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return result.union(current.select("v", "v").distinct())
