"""Connected components by contraction, as joins on the edges alone."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swaplens.plans.scale import stored

LAST_EDGES = 200_000  # so many edges one task can finish in some tens of MB


def _rank(node: str, salt: int) -> Column:
    return F.struct(F.xxhash64(F.lit(salt), node).alias("rank"), F.col(node).alias("node"))


def _finish(edges: DataFrame) -> DataFrame:
    """node and to, the least node reached, of at most ``LAST_EDGES`` edges."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(part: pd.DataFrame) -> pd.DataFrame:
        up: dict = {}

        def top(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for a, b in zip(part["a"].tolist(), part["b"].tolist()):
            up.setdefault(a, a), up.setdefault(b, b)
            a, b = top(a), top(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        return pd.DataFrame({"node": list(up), "to": [top(x) for x in up]})

    return edges.groupBy().applyInPandas(run, f"node {kind}, to {kind}")


def components(edges: DataFrame, last_edges: int = LAST_EDGES) -> DataFrame:
    """node and component (the least node that can be reached) of every node of ``edges`` (a, b), loops included.

    Every round ranks the nodes by a new hash, maps each to the first of itself and its neighbours, and contracts the edges along. A
    constant share of the nodes is expected to go each time, on chains as on stars, so rounds grow with the logarithm. Once the edges that are left are counted and at
    most ``last_edges``, one task joins them. Then the maps are composed, last to first. Edges and maps are written to the shared folder, never collected.
    """
    left = stored(edges.select("a", "b").distinct(), "edges")
    maps: list[DataFrame] = []
    while left.count() > last_edges:
        salt = len(maps)
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(_rank("b", salt)).alias("best"))
        step = stored(first.select(F.col("a").alias("node"), F.least("best", _rank("a", salt))["node"].alias("to")), "step")
        maps.append(step)
        left = stored(
            left.join(step.withColumnRenamed("to", "x"), F.col("a") == F.col("node"))
            .select("x", "b")
            .join(step.withColumnRenamed("to", "y"), F.col("b") == F.col("node"))
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    found = _finish(left)
    if not maps:
        return stored(found.select("node", F.col("to").alias("component")), "components")
    for step in reversed(maps):
        after = found.select(F.col("node").alias("n"), F.col("to").alias("end"))
        found = step.join(after, F.col("to") == F.col("n"), "left").select("node", F.coalesce("end", "to").alias("to"))
    found = stored(found, "reached")
    least = found.groupBy(F.col("to").alias("end")).agg(F.min("node").alias("component"))
    return stored(found.join(least, F.col("to") == F.col("end")).select("node", "component"), "components")
