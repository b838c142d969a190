"""Connected components of a graph given by its links."""

from pyspark.sql import DataFrame, functions as F

from chronolex.sources.scratch import materialize


def _smallest(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each `a`."""
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).withColumn("low", F.least("a", "low"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Links point from larger to smaller."""
    low = _smallest(links)
    moved = links.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    `links` has two orderable columns `a` and `b`, in any direction, repeats allowed; self links and
    links with NULL say nothing and are left out. Large-star and small-star rounds take turns until
    the links no longer change; each round is written to the shared folder, so lineage stays short
    and a lost executor costs one round. Per-node minima are combined before they are shuffled, so a
    node with many links is not gathered anywhere. Runs actions.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = links.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct()
    links = materialize(links, "links")
    state = _state(links)
    while True:
        links = materialize(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return nodes.unionByName(roots)
