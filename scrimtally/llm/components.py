"""Connected components of a table of links, by joins and written rounds.

Every node hooks to its smallest neighbour, pointers are followed until they rest
on roots, and links are carried over to the roots; links within a root go. A
round at least halves the nodes of each unfinished component. Hot nodes cost
nothing in the minimum (it is taken before the shuffle) and are split in the
joins, which are plain inner joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import stored


def _rooted(parents: DataFrame) -> DataFrame:
    """Follow the pointers (node, root) until every root points to itself."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        parents = stored(
            parents.join(above, "root", "left").select(
                "node", F.coalesce("higher", "root").alias("root"), (F.col("higher") != F.col("root")).alias("moved")
            ),
            "roots",
        )
        if not parents.filter("moved").limit(1).count():
            return parents.drop("moved")
        parents = parents.drop("moved")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the component's smallest node."""
    links = stored(links.select("a", "b").filter("a <> b"), "links")
    known = None
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        smallest = both.groupBy("node").agg(F.min("other").alias("other"))
        parents = _rooted(stored(smallest.select("node", F.least("node", "other").alias("root")), "parents"))
        if known is None:
            known = parents
        else:
            higher = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            known = stored(
                known.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "known"
            )
        of_a = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        of_b = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        carried = links.join(of_a, "a").join(of_b, "b").filter("ra <> rb")
        links = stored(carried.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        if not links.limit(1).count():
            return known
