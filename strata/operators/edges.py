"""Edge-table operators: sets, adjacency, profiles, root edges.

Everything is keyed by (group keys, node) so that no operator gathers a whole
group in one task. The map-shaped views of the reference (one map per
dimension or hierarchy) are rows here; the JSON report builds maps of bounded
parts (``sinks.export``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import salt as S


def edge_set(edges: DataFrame, keys: list[str], child: str = "child",
             parent: str = "parent") -> DataFrame:
    """S5 ``addEdge``: drop null and repeated edges."""
    return (edges.select(*keys, child, parent)
            .filter(F.col(child).isNotNull() & F.col(parent).isNotNull()).distinct())


def node_set(edges: DataFrame, keys: list[str], child: str = "child",
             parent: str = "parent") -> DataFrame:
    """S5 ``addNode``: every node of every group, once."""
    return (edges.select(*keys, F.col(child).alias("node"))
            .union(edges.select(*keys, F.col(parent).alias("node"))).distinct())


def node_degrees(edges: DataFrame, keys: list[str], child: str = "child",
                 parent: str = "parent") -> DataFrame:
    """``keys, node, out_degree, in_degree`` in one shuffle (edges must be distinct)."""
    roles = edges.select(*keys, F.array(
        F.struct(F.col(child).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col(parent).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    ).alias("r")).select(*keys, F.inline("r"))
    return roles.groupBy(*keys, "node").agg(
        F.sum("o").cast("bigint").alias("out_degree"), F.sum("i").cast("bigint").alias("in_degree"))


def profile(edges: DataFrame, keys: list[str], child: str = "child",
            parent: str = "parent") -> DataFrame:
    """A4: per group, edges, nodes, roots (never a child) and leaves (never a parent)."""
    d = node_degrees(edges.select(*keys, child, parent).distinct(), keys, child, parent)
    return d.groupBy(*keys).agg(
        F.sum("out_degree").cast("bigint").alias("n_edges"),
        F.count(F.lit(1)).alias("n_nodes"),
        F.count(F.when(F.col("out_degree") == 0, 1)).alias("n_roots"),
        F.count(F.when(F.col("in_degree") == 0, 1)).alias("n_leaves"),
    )


def adjacency(edges: DataFrame, keys: list[str], child: str = "child",
              parent: str = "parent") -> DataFrame:
    """A1 in row form: one row per (group, level) with its sorted parents.

    Repeated (dimension, level) rows are united, not overwritten."""
    return edges.groupBy(*keys, child).agg(F.array_sort(F.collect_set(parent)).alias("parents"))


def root_edges(edges: DataFrame, keys: list[str], child: str = "child",
               parent: str = "parent") -> DataFrame:
    """Edges whose parent is no child in its group (anti join on the node)."""
    children = edges.select(*keys, F.col(child).alias(parent)).distinct()
    return S.anti_join(edges, children, [*keys, parent], [child])


def edges_minus_roots(edges: DataFrame, keys: list[str], child: str = "child",
                      parent: str = "parent") -> DataFrame:
    """``edges MINUS root_edges`` = distinct edges whose parent is a child."""
    children = edges.select(*keys, F.col(child).alias(parent)).distinct()
    return S.semi_join(edges, children, [*keys, parent], [child]).distinct()


def path_start_end(path_edges: DataFrame, keys: list[str], child: str = "from_level",
                   parent: str = "to_level") -> DataFrame:
    """Per group, levels that are no target (``start``) and no source (``end``)."""
    d = node_degrees(path_edges, keys, child, parent)
    return d.filter((F.col("in_degree") == 0) | (F.col("out_degree") == 0)).select(
        *keys, F.col("node").alias("level"),
        F.when(F.col("in_degree") == 0, "start").otherwise("end").alias("role"))
