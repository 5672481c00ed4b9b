"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum over them; equal states mean that a round changed nothing."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges (u greater than v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small_least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(small_least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """Rows (node, component) for every end of a link; the component is its smallest node.

    ``links`` has columns ``a`` and ``b`` of one orderable type. Neighbours are never gathered: each
    round takes minima, which combine before the shuffle, and joins them back to the links. Each
    round is written to the shared folder. Rows with a null end are ignored; a link of a node to
    itself makes a component of one; no links give no rows.
    """
    usable = stored(links.select("a", "b").where("a is not null and b is not null").distinct(), purpose)
    edges = usable.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before, state = None, None
    while before is None or state != before:
        before = state
        edges = stored(_round(edges), purpose)
        state = _state(edges)
        if not state[0]:
            break
    nodes = usable.select(F.col("a").alias("node")).unionByName(usable.select(F.col("b").alias("node"))).distinct()
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
