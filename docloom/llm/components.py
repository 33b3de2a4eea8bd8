"""Connected components of a table of links, by contraction.

Each round gives every node the smallest node next to it, follows these choices to the
top by pointer jumping, and replaces the links by those between tops. A round at least
halves the nodes that still have links, so there are few rounds; each writes its narrow
tables to the shared folder. Minima are pre-aggregated, so a node with very many links
is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import stage


def _tops(links: DataFrame) -> DataFrame:
    """(node, top): each linked node's end of the chain of smallest neighbours."""
    both = links.select("a", "b").union(links.select("b", "a"))
    chosen = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("next"))
        .select("node", F.least("node", "next").alias("top")),
        "component_choice",
    )
    while True:
        above = chosen.select(F.col("node").alias("top"), F.col("top").alias("above"))
        # a chain ends at a node that chose itself
        jumped = stage(
            chosen.join(above, "top").select("node", F.col("above").alias("top")),
            "component_jump",
        )
        moved = jumped.join(above, "top").where(F.col("above") != F.col("top")).limit(1).count()
        chosen = jumped
        if not moved:
            return chosen


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node in ``links`` (a, b), its component's smallest node."""
    links = stage(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "component_links",
    )
    known: DataFrame | None = None
    while not links.isEmpty():
        tops = _tops(links)
        ends = tops.select(F.col("node").alias("component"), "top")
        if known is None:
            known = tops.select("node", F.col("top").alias("component"))
        else:
            known = stage(
                known.join(ends, "component", "left").select(
                    "node", F.coalesce("top", "component").alias("component")
                ),
                "component_known",
            )
        left = tops.select(F.col("node").alias("a"), F.col("top").alias("a_top"))
        right = tops.select(F.col("node").alias("b"), F.col("top").alias("b_top"))
        links = stage(
            links.join(left, "a")
            .join(right, "b")
            .select(F.least("a_top", "b_top").alias("a"), F.greatest("a_top", "b_top").alias("b"))
            .where("a <> b")
            .distinct(),
            "component_links",
        )
    if known is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return known
