"""Pointer jumping over functional graphs: every node has at most one parent.

Hierarchy paths that reach the cycle test have out-degree <= 1 (a level with
two parents is rejected first), and valid paths are chains. On such graphs
the peel needs one round per level of the longest path; pointer jumping
needs one round per *doubling* of it. Each node carries a pointer and the
distance to it. A round replaces the pointer by the pointer's pointer and adds
the distances (list ranking). A node is ``done`` once its pointer is a root.

Stop rule: the number of unfinished nodes. If a round finishes none, every
unfinished node is on a cycle or leads into one: a node at distance d >= 2^k
from its root has, on its way up, a node at a distance in [2^k, 2^(k+1)),
which that round finishes. So ``rounds <= log2(longest path) + 2`` and a
group is cyclic iff it keeps an unfinished node.

Plan per round: one left join of the state with itself, the streamed side
keyed by the pointer, the build side by the node (unique per node). A hot
pointer (many levels below one node) is on the streamed side of a left outer
join, which AQE splits. Every round is written once to a table in the
session's reliable checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import Store


@dataclass
class JumpResult:
    state: DataFrame  # keys, node, root, dist, done: one row per node with a parent
    rounds: int

    def cyclic_groups(self, keys: list[str]) -> DataFrame:
        """Groups holding a node that never reaches a root."""
        return self.state.filter(~F.col("done")).select(*keys).distinct()

    def depths(self, keys: list[str]) -> DataFrame:
        """``keys, node, depth``: edges from the node up to its root (acyclic part)."""
        return self.state.filter("done").select(*keys, "node", F.col("dist").alias("depth"))


def jump(edges: DataFrame, keys: list[str], child: str = "child", parent: str = "parent",
         max_rounds: int | None = None, weight: str | None = None) -> JumpResult:
    """Pointer jumping on ``edges``; each ``(keys, child)`` must have at most one parent.

    ``weight`` names the column that distances add up, else each edge counts 1.
    Nodes that are done leave the loop: their rows are written once, in the
    round that finishes them, and only looked up afterwards."""
    length = F.lit(1) if weight is None else F.col(weight)
    state = edges.filter(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(
        *keys, F.col(child).alias("node"), F.col(parent).alias("root"),
        length.cast("bigint").alias("dist"), F.lit(False).alias("done")).distinct()
    store, result = Store(edges.sparkSession), Store(edges.sparkSession)
    going = store.put(state)
    n = going.count()
    rounds = 0
    while n > 0:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"pointer jumping did not settle after {max_rounds} rounds")
        known = going if rounds == 0 else going.unionByName(store.all("rounds").filter("done"))
        look = known.select(*keys, F.col("node").alias("root"), F.col("root").alias("_root"),
                            F.col("dist").alias("_dist"), F.col("done").alias("_done"))
        hit = F.col("_root").isNotNull()
        going = store.add(going.join(look, [*keys, "root"], "left").select(
            *keys, "node",
            F.when(hit, F.col("_root")).otherwise(F.col("root")).alias("root"),
            F.when(hit, F.col("dist") + F.col("_dist")).otherwise(F.col("dist")).alias("dist"),
            (~hit | F.col("_done")).alias("done")), "rounds").filter(~F.col("done"))
        m = going.count()
        rounds += 1
        if m == n:
            break
        n = m
    out = going if rounds == 0 else going.unionByName(store.all("rounds").filter("done"))
    out = result.put(out)
    store.clear()
    return JumpResult(state=out, rounds=rounds)
