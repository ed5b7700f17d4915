"""Connected components by contraction (DataFrame joins, staged each round)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.common import staged

JUMPS = 2       # pointer jumps per round


def _mapped(edges: DataFrame, parent: DataFrame) -> DataFrame:
    """Edges between the parents of their ends, larger end first, without loops and repeats."""
    u = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
    v = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
    both = edges.join(u, "u").join(v, "v")
    return both.select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the links; nodes of one component share one of its nodes as name.

    Each round gives every node its least neighbour as parent, if that is less
    than the node, follows parents a few times, and goes on with the links
    between different parents, of which there are ever fewer. The minimum is a
    map-side combined aggregate, so a node with very many links is never
    gathered into one task. The driver only learns whether links are left.
    Links of a node with itself and NULL ends are ignored; an empty table gives
    no rows, and other columns are not read.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} != {b}").distinct()
    edges = staged(edges, "links")
    names = None
    while names is None or not edges.isEmpty():
        low = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent"))
        top = edges.select(F.col("v").alias("node")).distinct()
        parent = low.unionByName(top.join(low, "node", "left_anti").withColumn("parent", F.col("node")))
        for _ in range(JUMPS):
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parent = parent.join(up, "parent").select("node", F.col("above").alias("parent"))
        parent = staged(parent, "parents")
        if names is None:
            names = parent.withColumnRenamed("parent", "component")
        else:
            step = parent.select(F.col("node").alias("component"), "parent")
            names = staged(names.join(step, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")), "names")
        edges = staged(_mapped(edges, parent), "links")
    return names
