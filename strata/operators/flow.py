"""Values that flow along the edges of all groups at once.

A node is **final** once every edge into it has been used; its value is the
greatest (or least) of ``value(src) + weight`` over them. Nodes without an edge
into them start. What never becomes final lies on a cycle or behind one. With
``src = parent``, weight 1 and ``max`` this is the peel and the longest path to
a root; with ``src = child``, weight -1 and ``min`` it is the push-down.

Work per layer follows the **frontier**, the nodes that became final in the
layer before: each node is in one frontier and each edge is used once, so the
rows shuffled fall with what is still open, and settled groups cost nothing.
A layer is a join of the edges with the frontier - the edges are dealt out by
(keys, src) once and kept, only the frontier moves - and one aggregation of the
edges it used with the nodes still waiting, by (keys, node), partial before its
shuffle. Edges carry the number of edges into their target, so no other table
is read. A node that is the source of very many edges is split (``salt``).

**Chains.** One layer per level would make an element chain of length n cost n
jobs. After every ``contract_every`` layers, nodes with one edge in and one
edge out that are left are taken out by pointer jumping, log2(length) rounds,
and their edges become one edge of the summed weight. Their values follow from
the end of their chain when all is done. Chains that never reach an end are
cycles.

Every layer is written once, to a table in the session's reliable checkpoint
folder, and read from there: plans stay one scan deep, a lost executor costs
the tasks it ran, and the result is a scan of that table, not a union.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import jump as J
from strata.operators import salt as S
from strata.session import Store


LAYERS_PER_JOB = 2


class DidNotConverge(RuntimeError):
    """``max_rounds`` is hit while nodes still become final. What is left is
    deep, not cyclic, and must never be reported as a cycle."""


@dataclass
class Flow:
    values: DataFrame  # keys, node, value: every final node, starts included
    rounds: int        # layers and jumps


def degrees(edges: DataFrame, keys: list[str], src: str, dst: str) -> DataFrame:
    """``keys, node, n_in, n_out`` in one shuffle, counting rows."""
    ends = edges.select(*keys, F.explode(F.array(
        F.struct(F.col(src).alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col(dst).alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    return ends.groupBy(*keys, "e.node").agg(F.sum("e.i").alias("n_in"), F.sum("e.o").alias("n_out"))


def _dealt(edges: DataFrame, keys: list[str], min_rows: int, n: int | None = None) -> tuple[DataFrame, S.Salting]:
    """The edges dealt out by source and kept, and the salting of hot sources."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salting = S.measure(edges, [*keys, "src"], n, min_rows)
    dealt = salting.streamed(edges, ["dst", "weight"]).repartition(parts, *salting.on)
    return dealt.persist(StorageLevel.MEMORY_AND_DISK), salting


def propagate(edges: DataFrame, keys: list[str], src: str, dst: str, weight: int, best: str,
              starts: DataFrame | None = None, contract_every: int = 12, contract_first: bool = False,
              max_rounds: int | None = None, min_rows: int = S.MIN_ROWS) -> Flow:
    """Values of all nodes of distinct, non-null ``edges``. ``starts`` gives the
    values (``keys, node, value``) of nodes without an edge into them, default 0.
    ``contract_first`` takes chains out before the first layer too."""
    store = Store(edges.sparkSession)
    pick = {"max": F.max, "min": F.min}[best]
    final = F.col("got") == F.col("need")
    rows = edges.select(*keys, F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(weight).cast("bigint").alias("weight"))
    counted = degrees(rows, keys, "src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    into = counted.filter("n_in > 0").select(*keys, F.col("node").alias("dst"), F.col("n_in").alias("need"))
    left = store.put(S.left_join(rows, into, [*keys, "dst"], ["src"], min_rows))
    live, salting = _dealt(left, keys, min_rows)
    first = counted.filter("n_in = 0").select(*keys, "node")
    if starts is None:
        first = first.withColumn("value", F.lit(0).cast("bigint"))
    else:
        first = first.join(starts.select(*keys, "node", F.col("value").cast("bigint").alias("value")), [*keys, "node"])
    zero, columns = F.lit(0).cast("bigint"), [*keys, "node", "value", "got", "need", "layer"]
    # One round of the table a layer: nodes touched so far and not final before; final where got = need.
    layer = store.add(first.withColumns({"got": zero, "need": zero, "layer": F.lit(0)}).select(*columns), "layers")
    counted.unpersist()
    inner: list[DataFrame] = []
    layers = jumps = 0
    while not layer.filter(final).isEmpty():
        if max_rounds is not None and layers + jumps >= max_rounds:
            raise DidNotConverge(f"nodes still become final after {layers + jumps} rounds")
        if (layers or contract_first) and layers % contract_every == 0:
            # The frontier of the last layer is still to be used.
            passed = store.all("layers").filter(final & (F.col("layer") < layers)).select(*keys, F.col("node").alias("src"))
            left = store.put(S.anti_join(live.drop(S.SALT), passed, [*keys, "src"], ["dst"], min_rows))
            live.unpersist()
            left, chains, took = _contract(left, layer.filter(~final), keys, store)
            if chains is not None:
                inner.append(chains)
                jumps += took
            live, salting = _dealt(left, keys, min_rows)
        # Two layers a job: the first one's shuffle is read for its frontier and for its waiting nodes.
        parts, at = [], layer
        for _ in range(LAYERS_PER_JOB):
            layers += 1
            frontier = salting.probe(at.filter(final).select(*keys, F.col("node").alias("src"), "value"))
            used = live.join(frontier, salting.on).select(
                *keys, F.col("dst").alias("node"), (F.col("value") + F.col("weight")).alias("value"), F.lit(1).cast("bigint").alias("got"), "need")
            waiting = at.filter(~final).select(*keys, "node", "value", "got", "need")
            at = used.unionByName(waiting).groupBy(*keys, "node").agg(
                pick("value").alias("value"), F.sum("got").alias("got"), F.max("need").alias("need")).withColumn("layer", F.lit(layers)).select(*columns)
            parts.append(at)
        written = at
        for part in parts[:-1]:
            written = written.unionByName(part.filter(final))
        layer = store.add(written, "layers").filter(F.col("layer") == layers)
    live.unpersist()
    result = Store(edges.sparkSession)
    found = result.add(store.all("layers").filter(final).select(*keys, "node", "value"), "values")
    for chains in reversed(inner):
        # The values of a chain's nodes, from the node before it. Many chains may begin at one node.
        ends = result.all("values").select(*keys, F.col("node").alias("root"), "value")
        own = S.left_join(chains, ends, [*keys, "root"], ["node"], min_rows).filter(F.col("value").isNotNull())
        found = result.add(own.select(*keys, "node", (F.col("value") + F.col("dist")).alias("value")), "values")
    store.clear()
    return Flow(values=result.all("values"), rounds=layers + jumps)


def _contract(edges: DataFrame, waiting: DataFrame, keys: list[str], store: Store) -> tuple[DataFrame, DataFrame | None, int]:
    """Edges without the nodes that have one edge in, one out and none used yet;
    those nodes with the node before their chain and the weight from it; jumps."""
    single = degrees(edges, keys, "src", "dst").filter("n_in = 1 AND n_out = 1").select(*keys, "node")
    single = store.put(single.join(waiting.select(*keys, "node"), [*keys, "node"], "left_anti").withColumn("single", F.lit(True)))
    if single.isEmpty():
        return edges, None, 0
    # A single node has one edge in, so it is no hot key of either join.
    marked = store.put(edges.join(single.withColumnRenamed("node", "dst"), [*keys, "dst"], "left"))
    jumped = J.jump(marked.filter("single"), keys, "dst", "src", weight="weight")
    chains = jumped.state.filter("done").select(*keys, "node", "root", "dist")
    rest = marked.filter(F.col("single").isNull()).drop("single")
    out = store.put(rest.join(chains.withColumnRenamed("node", "src"), [*keys, "src"], "left").select(
        *keys, F.coalesce("root", "src").alias("src"), "dst", (F.col("weight") + F.coalesce("dist", F.lit(0))).alias("weight"), "need"))
    return out, chains, jumped.rounds
