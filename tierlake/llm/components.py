"""Connected components by contraction, without collecting links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.runtime import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the component's smallest.

    In each round every node points to its smallest neighbour, or to itself if that is smaller.
    Pointers are followed twice, links are moved to where they point, and links within a node go.
    At least half of the nodes that still have links go with each round, so a logarithmic number
    of rounds suffices. Each round is written to shared scratch. Links may repeat.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = ends.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("to")
        )
        for _ in range(2):
            point = _follow(stored(point, "pointers"), "node", "to")
        point = stored(point, "pointers")
        links = stored(
            _moved(_moved(links, point, "a"), point, "b").where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        roots = point if roots is None else stored(_renamed(roots, point), "roots")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.select("node", F.col("to").alias("root"))


def _follow(point: DataFrame, node: str, to: str) -> DataFrame:
    """Pointers of pointers; every target is itself a node."""
    further = point.select(F.col(node).alias("via"), F.col(to).alias("end"))
    return point.join(further, point[to] == further["via"], "left").select(
        node, F.coalesce("end", to).alias(to)
    )


def _moved(links: DataFrame, point: DataFrame, column: str) -> DataFrame:
    other = "b" if column == "a" else "a"
    return links.join(point, links[column] == point["node"]).select(
        other, F.col("to").alias(column)
    )


def _renamed(roots: DataFrame, point: DataFrame) -> DataFrame:
    """Earlier roots taken further; those that have no link left stay."""
    further = point.select(F.col("node").alias("via"), F.col("to").alias("end"))
    return roots.join(further, roots["to"] == further["via"], "left").select(
        "node", F.coalesce("end", "to").alias("to")
    )
