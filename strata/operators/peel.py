"""The peel: cycle check of every group of an edge table at once.

A group (a dimension, a hierarchy path, ...) is a set of edges child -> parent.
Each round removes the edges whose parent has no live outgoing edge in its
group, i.e. whose parent is a root of what is left. On distinct edges a group
empties iff it is acyclic; the edges that stay are exactly those whose parent
is on a cycle or leads up to one.

Plan per round: the edges are semi-joined on (keys, parent) against the
distinct (keys, child) set, aggregated map-side first. Both sides are keyed by
a *node*, not by the group, so one hot group spreads over all partitions, and
the edges of a hot parent are split by salts (``salt``: measured once, the
live row of a hot parent is repeated per salt). For the levels, the live set of
each round is kept and aggregated once at the end (``track_nodes``).

Level graphs are shallow, and two such rounds in one job are the cheapest way
through them. What still falls after ``deep_after`` rounds is handed to
``flow.propagate``, which uses every edge once and contracts chains, so that a
chain of n levels needs about log2(n) rounds more and not n.

Rounds are persisted (memory and disk) and every ``checkpoint_every`` jobs
written to the session's reliable checkpoint folder, which cuts the lineage.
One count per job decides the stop: the peel only removes, so when the total
did not fall, no group changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import flow as W
from strata.operators import salt as S
from strata.session import Rounds, cut

#: Raised when ``max_rounds`` is hit while edges are still being removed: such
#: groups are deep, not cyclic, and must never be reported as cyclic.
PeelDidNotConverge = W.DidNotConverge


@dataclass
class PeelResult:
    residue: DataFrame          # edges left: parent on or above a cycle
    node_rounds: DataFrame | None  # ``keys, node, round``: last round a node had an outgoing edge
    rounds: int                 # layers applied (>= the longest path of an acyclic group)
    source: DataFrame           # the materialised input edges (nulls dropped)
    held: list                  # persisted frames; release once the caller has cut its result

    def release(self) -> None:
        for df in self.held:
            df.unpersist(blocking=False)
        self.held = []


def peel(edges: DataFrame, keys: list[str], child: str = "child", parent: str = "parent",
         max_rounds: int | None = None, checkpoint_every: int = 2, layers_per_job: int = 2,
         track_nodes: bool = False, deep_after: int = 12, min_rows: int = S.MIN_ROWS) -> PeelResult:
    """Peel every group of ``edges`` at once.

    ``layers_per_job`` layers are chained lazily and run as one Spark job with
    one count, which divides the per-job overhead; the result is the same
    because the peel only removes (a job that removed nothing is stable).
    ``rounds`` counts the layers applied, an upper bound of the longest path.

    ``track_nodes`` keeps, per node, the last round in which it still had an
    outgoing edge: the live sets of the rounds shrink,
    so that round is the number of live sets holding the node, which is the
    longest path up to a root (T1). It costs no extra join: the live set of
    each round is built for the semi join anyway and only kept.
    """
    cols = [*keys, child, parent]
    rounds_state = Rounds(checkpoint_every)
    # Several tenants may share a group: its edges count once.
    source = (edges.select(*cols).filter(F.col(child).isNotNull() & F.col(parent).isNotNull()).distinct()
              .persist(StorageLevel.MEMORY_AND_DISK))
    n = source.count()
    salting = S.measure(source, [*keys, parent], n, min_rows)
    cur = salting.streamed(source, [child])
    deep: W.Flow | None = None
    live_sets: list[DataFrame] = []
    rounds = 0
    while n > 0:
        if max_rounds is not None and rounds >= max_rounds:
            raise PeelDidNotConverge(f"{n} edges still falling after {max_rounds} rounds")
        if rounds >= deep_after:
            deep = W.propagate(cut(cur.select(*cols)), keys, src=parent, dst=child, weight=1, best="max", contract_first=True,
                               max_rounds=None if max_rounds is None else max_rounds - rounds, min_rows=min_rows)
            cur = S.anti_join(cur.select(*cols), deep.values.select(*keys, F.col("node").alias(parent)), [*keys, parent], [child], min_rows)
            break
        layer = cur
        lives = []
        for i in range(max(1, layers_per_job)):
            # Nodes that still have an outgoing edge. The distinct is partial
            # (map-side) first: a node with a huge out-degree collapses before
            # the shuffle, so the probe side of the semi join is never skewed
            # (AQE can split only the streamed side of a semi join).
            live = layer.select(*keys, F.col(child).alias(parent)).distinct()
            if track_nodes:
                live = live.persist(StorageLevel.MEMORY_AND_DISK)
                lives.append((live, rounds + i + 1))
            layer = layer.join(salting.probe(live), salting.on, "left_semi")
        nxt = rounds_state.materialise(layer)
        m = nxt.count()
        if m == n:
            cur = nxt  # the same edges; the round before may have been released
            for live, _ in lives:
                live.unpersist(blocking=False)
            break
        live_sets.extend(lives)
        cur, n = nxt, m
        rounds += max(1, layers_per_job)
    node_rounds = None
    if track_nodes and deep is not None:
        # Roots of what was left lost their last edge in the last round.
        live_sets.append((deep.values.select(*keys, F.col("node").alias(parent), F.col("value")), rounds))
    if track_nodes:
        tagged = source.limit(0).select(*keys, F.col(child).alias("node"), F.lit(0).alias("round"))
        for live, r in live_sets:
            own = F.lit(r) + F.col("value").cast("int") if "value" in live.columns and "value" not in cols else F.lit(r)
            tagged = tagged.unionByName(live.select(*keys, F.col(parent).alias("node"), own.alias("round")))
        node_rounds = cut(tagged.groupBy(*keys, "node").agg(F.max("round").alias("round")))
        for live, _ in live_sets:
            live.unpersist(blocking=False)
    rounds += deep.rounds if deep is not None else 0
    return PeelResult(residue=cur.select(*cols), node_rounds=node_rounds, rounds=rounds, source=source,
                      held=[source, *rounds_state.held])


def validity(edges: DataFrame, keys: list[str], groups: DataFrame | None = None,
             child: str = "child", parent: str = "parent",
             empty_is_valid: bool = False) -> DataFrame:
    """One row per group: ``keys, n_edges, n_residue, valid, reason``.

    ``groups`` lists the groups to report (for instance every declared
    dimension); groups without edges are ``EMPTY`` - invalid as in the v2
    check, valid with ``empty_is_valid`` as in the v1 edge-table check.
    Otherwise a group with edges left after the peel is ``CYCLE``.
    """
    result = peel(edges, keys, child, parent)
    counts = result.source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_edges"))
    left = result.residue.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_residue"))
    base = counts if groups is None else groups.select(*keys).distinct().join(counts, keys, "left")
    out = base.join(left, keys, "left").select(
        *keys,
        F.coalesce("n_edges", F.lit(0)).cast("bigint").alias("n_edges"),
        F.coalesce("n_residue", F.lit(0)).cast("bigint").alias("n_residue"),
    )
    reason = (F.when(F.col("n_edges") == 0, F.lit(None if empty_is_valid else "EMPTY"))
              .when(F.col("n_residue") > 0, F.lit("CYCLE")))
    out = cut(out.withColumn("reason", reason.cast("string")).withColumn("valid", F.col("reason").isNull()))
    result.release()
    return out


def valid_groups(edges: DataFrame, keys: list[str], child: str = "child",
                 parent: str = "parent") -> DataFrame:
    """Edges (all columns) of the groups that pass the check (D3)."""
    result = peel(edges, keys, child, parent)
    bad = cut(result.residue.select(*keys).distinct())
    result.release()
    return S.anti_join(edges, bad, keys, [child, parent])


def cycle_residue(edges: DataFrame, keys: list[str], child: str = "child",
                  parent: str = "parent") -> DataFrame:
    """The edges the peel cannot remove."""
    result = peel(edges, keys, child, parent)
    out = cut(result.residue)
    result.release()
    return out
