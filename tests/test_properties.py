"""Properties on random graphs, all groups checked in one Spark job each,
"""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import levels as LV
from strata.operators import peel as P
from strata.operators.sequence import row_number_by

SCHEMA = "dimension_id string, child string, parent string"


def random_graphs(n_graphs=300, max_nodes=7, seed=1):
    rnd = random.Random(seed)
    graphs = {}
    for g in range(n_graphs):
        k = rnd.randint(1, max_nodes)
        edges = set()
        for _ in range(rnd.randint(1, 2 * k)):
            edges.add((f"n{rnd.randrange(k)}", f"n{rnd.randrange(k)}"))
        graphs[f"g{g}"] = sorted(edges)
    return graphs


def acyclic(edges):
    adj = {}
    for c, p in edges:
        adj.setdefault(c, []).append(p)
    state = {}

    def visit(v):
        state[v] = 1
        for w in adj.get(v, []):
            if state.get(w) == 1 or (w not in state and not visit(w)):
                return False
        state[v] = 2
        return True

    return all(state.get(v) == 2 or visit(v) for v in list(adj))


def longest_to_root(edges):
    adj = {}
    nodes = set()
    for c, p in edges:
        adj.setdefault(c, []).append(p)
        nodes |= {c, p}
    memo = {}

    def depth(v):
        if v not in memo:
            memo[v] = max((1 + depth(w) for w in adj.get(v, [])), default=0)
        return memo[v]

    return {v: depth(v) for v in nodes}


def pushed(edges, t1):
    children = {}
    for c, p in edges:
        children.setdefault(p, []).append(c)
    memo = {}

    def lv(v):
        if v not in memo:
            memo[v] = t1[v] if v not in children else min(lv(c) for c in children[v]) - 1
        return memo[v]

    return {v: lv(v) for v in t1}


def _df(spark, graphs):
    return spark.createDataFrame([(g, c, p) for g, es in graphs.items() for c, p in es], SCHEMA)


def test_validity_equals_acyclic(spark):
    graphs = random_graphs()
    got = {r.dimension_id: r.valid for r in P.validity(_df(spark, graphs), ["dimension_id"]).collect()}
    assert got == {g: acyclic(es) for g, es in graphs.items()}


def test_back_edge_breaks_a_valid_graph(spark):
    graphs = {g: es for g, es in random_graphs(seed=2).items() if acyclic(es)}
    broken = {g: es + [(es[-1][1], es[-1][0])] for g, es in graphs.items()}
    got = P.validity(_df(spark, broken), ["dimension_id"]).filter("valid").count()
    assert got == 0


def test_partitioning_does_not_change_results(spark):
    df = _df(spark, random_graphs(seed=3))
    a = sorted(P.validity(df, ["dimension_id"]).collect())
    b = sorted(P.validity(df.repartition(7, "child"), ["dimension_id"]).collect())
    assert a == b


def test_levels_match_the_page_rules(spark):
    graphs = {g: es for g, es in random_graphs(seed=4).items() if acyclic(es)}
    df = _df(spark, graphs)
    t1 = {(r.dimension_id, r.node): r.level for r in LV.node_levels(df, ["dimension_id"])[0].collect()}
    t2 = {(r.dimension_id, r.node): r.level for r in LV.pushed_levels(df, ["dimension_id"]).collect()}
    for g, es in graphs.items():
        exp1 = longest_to_root(es)
        exp2 = pushed(es, exp1)
        assert {v: t1[(g, v)] for v in exp1} == exp1, g
        assert {v: t2[(g, v)] for v in exp2} == exp2, g


def test_row_number_with_a_hot_group(spark):
    rows = [("hot", f"k{i:05d}") for i in range(3000)] + [(f"g{i % 50}", f"k{i:05d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k string")
    got = row_number_by(df, ["g"], ["k"], partitions=6)
    exp = df.withColumn("row_number", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert sorted(got.collect()) == sorted(r for r in exp.select("g", "k", F.col("row_number").cast("bigint")).collect())


def test_hot_group_and_hot_parent(spark):
    """One dimension with most of the edges, one parent with thousands of children."""
    hot = [("hot", f"c{i}", "root") for i in range(4000)] + [("hot", "root", "top")]
    chain = [("hot", f"x{i}", f"x{i + 1}") for i in range(30)]
    cyc = [("hot2", f"c{i}", "r") for i in range(2000)] + [("hot2", "r", "s"), ("hot2", "s", "r")]
    small = [(f"g{i}", "a", "b") for i in range(100)]
    df = spark.createDataFrame(hot + chain + cyc + small, SCHEMA).repartition(8)
    got = {r.dimension_id: (r.valid, r.n_residue) for r in P.validity(df, ["dimension_id"]).collect()}
    assert got["hot"] == (True, 0)
    assert got["hot2"] == (False, 2002)
    assert all(got[f"g{i}"] == (True, 0) for i in range(100))


def test_long_chain_is_not_called_a_cycle(spark):
    import pytest
    chain = spark.createDataFrame([("g", f"n{i}", f"n{i + 1}") for i in range(12)], SCHEMA)
    with pytest.raises(P.PeelDidNotConverge):
        P.peel(chain, ["dimension_id"], max_rounds=4)
    assert P.peel(chain, ["dimension_id"]).residue.count() == 0


def random_functional_graphs(n_graphs=300, max_nodes=9, seed=5):
    """Every node has at most one parent; some graphs hold cycles or tails into them."""
    rnd = random.Random(seed)
    graphs = {}
    for g in range(n_graphs):
        k = rnd.randint(1, max_nodes)
        edges = []
        for v in range(k):
            if rnd.random() < 0.8:
                edges.append((f"n{v}", f"n{rnd.randrange(k)}" if rnd.random() < 0.15 else f"n{v + 1}"))
        if edges:
            graphs[f"f{g}"] = sorted(set(edges))
    return graphs


def test_pointer_jumping_matches_brute_force(spark):
    from strata.operators import jump as J
    graphs = random_functional_graphs()
    graphs["long"] = [(f"x{i}", f"x{i + 1}") for i in range(300)]
    res = J.jump(_df(spark, graphs), ["dimension_id"])
    cyclic = {r.dimension_id for r in res.cyclic_groups(["dimension_id"]).collect()}
    assert cyclic == {g for g, es in graphs.items() if not acyclic(es)}
    depth = {(r.dimension_id, r.node): r.depth for r in res.depths(["dimension_id"]).collect()}
    for g, es in graphs.items():
        if acyclic(es):
            exp = {v: d for v, d in longest_to_root(es).items() if d > 0}
            assert {v: depth[(g, v)] for v in exp} == exp, g
    assert res.rounds <= 11  # log2(300) + 2, where the peel needs 300


def test_pointer_jumping_with_a_hot_pointer(spark):
    """Thousands of levels under one node, above it a chain; one group also has a cycle."""
    from strata.operators import jump as J
    hot = [("hot", f"c{i}", "x0") for i in range(4000)] + [("hot", f"x{i}", f"x{i + 1}") for i in range(20)]
    cyc = [("cyc", f"c{i}", "r") for i in range(1000)] + [("cyc", "r", "s"), ("cyc", "s", "r")]
    df = spark.createDataFrame(hot + cyc, SCHEMA).repartition(8)
    res = J.jump(df, ["dimension_id"])
    assert [r.dimension_id for r in res.cyclic_groups(["dimension_id"]).collect()] == ["cyc"]
    depth = {r.node: r.depth for r in res.depths(["dimension_id"]).collect()}
    assert all(depth[f"c{i}"] == 21 for i in range(4000))
    assert depth["x19"] == 1 and depth["x0"] == 20
