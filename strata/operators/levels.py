"""Node levels of acyclic dimensions (T1-T4), the data behind the page's drawing.

T1: the round in which the peel removes a node's last outgoing edge, which is
the length of the longest path from the node up to a root (roots are 0).
T2: push down - a node with children moves to one above its highest child,
``min(T2(child)) - 1``; leaves keep T1. Computed from the leaves up; a node
is settled once its children are.
T3: skip-level edges, child level minus parent level >= 2.
T4: nodes per level and the slot of each node in its level.

Cyclic groups have no levels and are left out. Every step is keyed by
(group, node); the slots use the range-partitioned row number, so a level
holding most nodes of a huge dimension is not one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import edges as E
from strata.operators import flow as W
from strata.operators import peel as P
from strata.operators import salt as S
from strata.operators.sequence import row_number_by
from strata.session import cut


def node_levels(edges: DataFrame, keys: list[str], child: str = "child",
                parent: str = "parent") -> tuple[DataFrame, DataFrame]:
    """``keys, node, level`` for acyclic groups; also returns their edges."""
    res = P.peel(edges, keys, child, parent, track_nodes=True)
    bad = cut(res.residue.select(*keys).distinct())
    good_edges = cut(S.anti_join(res.source, bad, keys, [child, parent]))
    nodes = E.node_set(good_edges, keys, child, parent)
    levels = cut(nodes.join(res.node_rounds, [*keys, "node"], "left").select(
        *keys, "node", F.coalesce("round", F.lit(0)).cast("int").alias("level")))
    res.release()
    return levels, good_edges


def pushed_levels(edges: DataFrame, keys: list[str], child: str = "child",
                  parent: str = "parent") -> DataFrame:
    """``keys, node, level`` after pushing nodes down towards their children.

    The leaves keep their T1 and start; a node is settled in the layer in which
    the last of its children is, and leaves the loop there (``flow``)."""
    t1, good = node_levels(edges, keys, child, parent)
    done = W.propagate(good, keys, src=child, dst=parent, weight=-1, best="min",
                       starts=t1.withColumnRenamed("level", "value"))
    return done.values.select(*keys, "node", F.col("value").cast("int").alias("level"))


def skip_level_edges(edges: DataFrame, levels: DataFrame, keys: list[str], child: str = "child",
                     parent: str = "parent") -> DataFrame:
    """Edges spanning two or more levels, with both levels."""
    lc = levels.select(*keys, F.col("node").alias(child), F.col("level").alias("child_level"))
    lp = levels.select(*keys, F.col("node").alias(parent), F.col("level").alias("parent_level"))
    edges = edges.select(*keys, child, parent).distinct()  # tenants may share an edge
    return (edges.join(lc, [*keys, child]).join(lp, [*keys, parent])
            .filter(F.col("child_level") - F.col("parent_level") >= 2)
            .select(*keys, child, parent, "child_level", "parent_level"))


def level_profile(levels: DataFrame, keys: list[str]) -> DataFrame:
    """T4: nodes per level, with the number of levels of the group."""
    per = levels.groupBy(*keys, "level").agg(F.count(F.lit(1)).alias("n_nodes"))
    n_levels = levels.groupBy(*keys).agg(F.count_distinct("level").alias("n_levels"))
    return per.join(n_levels, keys)


def level_slots(levels: DataFrame, keys: list[str]) -> DataFrame:
    """T4: slot of each node in its level (0-based, by node name)."""
    ranked = row_number_by(levels, [*keys, "level"], ["node"], out="_rn")
    return ranked.select(*keys, "node", "level", (F.col("_rn") - 1).alias("slot"))
