"""Connected components of a link table, as alternating large-star and small-star joins.

Nothing is collected but one row of totals per round.  Every round's edges are
written to the shared checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut


def connected_components(links: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its smallest node.

    Node columns may have any orderable type.  Rows with a null end and links of a node
    to itself are left out; repeated links count once.  An empty table gives no rows.

    Each round sends a node's neighbours to its smallest neighbour (first the larger ones,
    then the smaller ones), so stars form in a logarithmic number of rounds.  The minimum
    is aggregated before the shuffle and the join on a hub is an inner equi-join that
    adaptive execution may split, so a node with very many links is no bottleneck.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = cut(edges.distinct())
    seen = _total(edges)
    for _ in range(max_rounds):
        if seen["n"] == 0 or seen["n"] == seen["children"] and not seen["chained"]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = cut(
            small.where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        seen = _total(edges)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _total(edges: DataFrame):
    """Row count, nodes that have a smaller neighbour, and whether any of these is a smaller neighbour itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(
        F.coalesce(F.sum("up"), F.lit(0)).alias("n"),
        F.count(F.when(F.col("up") > 0, 1)).alias("children"),
        F.coalesce(F.max(F.when((F.col("up") > 0) & (F.col("down") > 0), True)), F.lit(False)).alias("chained"),
    ).first()
