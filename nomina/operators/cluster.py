"""Clusters of duplicate names: connected components of the duplicate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.operators.pairs import distinct_names
from nomina.session import materialize


def neighbours(pairs: DataFrame, frontier: DataFrame) -> DataFrame:
    """Pairs whose first name is in the frontier ``(name_1)``."""
    return pairs.join(frontier.select("name_1").distinct(), "name_1", "left_semi")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest name around the node."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(lowest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges run from larger to smaller name."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("m").alias("b")))


def _is_star_forest(edges: DataFrame) -> bool:
    """True when every name has one parent and no parent has a parent itself."""
    roles = edges.select(F.col("a").alias("name"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1))
    )
    seen = roles.groupBy("name").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame, names: DataFrame | None = None, max_rounds: int = 100) -> DataFrame:
    """``(name, cluster_id)`` for all ``names(name)``, by default those in ``edges(name_1, name_2)``.

    The id is the smallest name of the component; names without an edge are their own.

    Alternates large-star and small-star passes (Kiveris et al., 2014). A pass is an
    aggregation with partial minima and an equi-join against one row per name, so a
    name that carries a large part of the edges is split like any skewed join. Every
    round is written to the scratch folder, which keeps the lineage short.
    """
    a, b = F.greatest("name_1", "name_2"), F.least("name_1", "name_2")
    links = edges.filter(F.col("name_1") != F.col("name_2")).select(a.alias("a"), b.alias("b")).distinct()
    links = materialize(links, "components")
    for _ in range(max_rounds):
        links = materialize(_small_star(_large_star(links)).distinct(), "components")
        if _is_star_forest(links):
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    members = links.select(F.col("a").alias("name"), F.col("b").alias("cluster_id"))
    names = distinct_names(edges) if names is None else names
    return names.join(members, "name", "left").select("name", F.coalesce("cluster_id", "name").alias("cluster_id"))


def name_clusters(pairs: DataFrame) -> DataFrame:
    """Cluster of every name of a labelled pair table; names without duplicates are clusters of one."""
    duplicates = pairs.filter(F.col("is_duplicate") == 1).select("name_1", "name_2")
    return components(duplicates, distinct_names(pairs))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_id").agg(F.count("*").alias("size"))


def large_clusters(clusters: DataFrame, larger_than: int = 4, examples: int | None = 3) -> DataFrame:
    """Clusters above a size with their size; ``examples`` limits how many are shown.

    Members are not gathered into one array: join back on ``cluster_id`` to list them.
    """
    big = cluster_sizes(clusters).filter(F.col("size") > larger_than)
    return big if examples is None else big.orderBy("cluster_id").limit(examples)


def uniqueness(clusters: DataFrame) -> DataFrame:
    """Members over all clusters against distinct members: equal when no name is in two clusters."""
    per_name = clusters.groupBy("name").agg(F.count("*").alias("n"))
    return per_name.agg(F.sum("n").alias("members"), F.count("*").alias("distinct_members"))
