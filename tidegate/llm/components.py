"""Connected components, by turning edges into stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import written


def _mark(pairs: DataFrame) -> tuple:
    """What tells two sets of pairs apart."""
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for each node with an edge to another: root is the smallest it can reach.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones;
    the rounds grow with the logarithm of the longest path. Pairs of each round are a table in
    the shared folder, never on the driver. A node with very many edges costs rows, not a task:
    minima are reduced before the shuffle and the joins may be split. Null ends and loops are
    left out; repeated edges do no harm; no edges give no rows.
    """
    u, v = F.col("u"), F.col("v")
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(
        u.isNotNull() & v.isNotNull() & (u != v)
    )
    pairs = pairs.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    pairs = written(pairs.distinct(), "edges")
    mark = _mark(pairs)
    while True:
        both = pairs.union(pairs.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(v != F.col("m"))
        small = small.select(v.alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        pairs = written(small.distinct(), "small-star")
        now = _mark(pairs)
        if now == mark:
            return pairs.select(u.alias("node"), v.alias("root"))
        mark = now
