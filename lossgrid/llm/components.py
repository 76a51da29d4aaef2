"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.session import materialise


def _hang(edges: DataFrame, *, larger: bool) -> DataFrame:
    """Replace the edges at each node by edges to its smallest neighbour.

    With ``larger`` the node's larger neighbours are hung below the smallest, else the node and its smaller ones.
    The smallest neighbour is a map-side combined minimum, so a node with very many edges is no hot task; the join
    back is one that Spark splits when skewed.
    """
    if larger:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("m", "_u"))
    joined = near.join(least, F.col("u") == F.col("_u"))
    if larger:
        hung = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return hung.filter("u <> v").distinct()


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every node of the (a, b) edges; the component is its smallest node.

    Alternates hanging larger and smaller neighbours below the smallest until every node hangs below the smallest
    of its component. Each round is written to the shared folder, so lineage stays short and a lost executor costs
    tasks of one round only. Self-loops and NULL ends are left out; no edges give no rows.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialise(now, purpose)
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"), F.sum(F.xxhash64("v", "u") % 1000003).alias("s")).first()
        if row["n"] == 0 or state == tuple(row):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(row)
        now = materialise(_hang(_hang(now, larger=True), larger=False), purpose)
