"""Connected components of a table of links, by alternating stars.

A large star hangs every larger neighbour of a node on its smallest neighbour, a small
star the smaller ones and the node itself. Both keep components as they are; when nothing
changes, every node hangs on the smallest node of its component. Only the smallest
neighbour of a node is ever aggregated, never the list of them, and each round is written
to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` has each link once as (low, high)."""
    near = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    if large:
        near = near.unionByName(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
    least = near.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    # Written, so that the join has an exchange of its own on both sides and a node with
    # very many links can be split.
    least = written(least, "components-least")
    hung = near.join(least, "node")
    if large:
        out = hung.filter("other > node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        # The node itself hangs on its smallest neighbour through that neighbour's star.
    else:
        out = hung.select(F.col("other").alias("high"), F.col("least").alias("low")).unionByName(
            least.select(F.col("node").alias("high"), F.col("least").alias("low"))
        )
    return out.filter("low < high").select("low", "high").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(low, high))").alias("mark")
    ).first()
    return row.n, row.mark


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``low`` and ``high``, integers):
    ``root`` is the smallest node of its component."""
    edges = links.select(
        F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")
    )
    edges = written(edges.filter("low < high").distinct(), "components")
    state = _state(edges)
    while True:
        edges = written(_star(_star(edges, True), False), "components")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
