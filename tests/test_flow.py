"""Layers, chains and hot nodes of ``flow`` and ``salt`` against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import edges as E
from strata.operators import flow as W
from strata.operators import levels as LV
from strata.operators import peel as P
from strata.operators import salt as S

SCHEMA = "g string, child string, parent string"


def frame(spark, edges):
    return spark.createDataFrame(edges, SCHEMA)


def layers(edges):
    """Longest path to a root of every node from which no cycle is reached, by relaxation."""
    up, value = {}, {}
    for g, c, p in edges:
        up.setdefault((g, c), set()).add((g, p))
    nodes = set(up) | {p for ps in up.values() for p in ps}
    changed = True
    while changed:
        changed = False
        for n in nodes:
            if n not in value and all(p in value for p in up.get(n, ())):
                value[n] = max((value[p] + 1 for p in up.get(n, ())), default=0)
                changed = True
    return value


def long_chain(g, n):
    return [(g, f"{i}", f"{i - 1}") for i in range(1, n + 1)]


def test_chain_of_ten_thousand_levels_beside_shallow_groups(spark):
    shallow = [(f"s{i}", "a", "b") for i in range(50)] + [(f"c{i}", x, y) for i in range(20) for x, y in (("a", "b"), ("b", "a"))]
    got = P.peel(frame(spark, [*long_chain("deep", 10_000), *shallow]), ["g"], track_nodes=True)
    assert got.rounds < 30
    assert got.residue.select("g").distinct().count() == 20 and got.residue.count() == 40
    deep = {r["node"]: r["round"] for r in got.node_rounds.filter("g = 'deep'").collect()}
    assert {**deep, "0": 0} == {str(i): i for i in range(10_001)}


def test_long_cycle_with_long_tails(spark):
    ring = [("r", f"{i}", f"{(i + 1) % 700}") for i in range(700)]
    below = [("r", "t0", "5")] + [("r", f"t{i}", f"t{i - 1}") for i in range(1, 300)]
    above = [("r", "5", "u0")] + [("r", f"u{i}", f"u{i + 1}") for i in range(300)]
    got = P.peel(frame(spark, ring + below + above), ["g"])
    assert got.rounds < 60
    assert got.residue.count() == 700 + 300 and got.residue.filter("parent LIKE 'u%'").count() == 0


@pytest.mark.parametrize("every,seed", [(2, 1), (2, 2), (4, 3), (2, 4)])
def test_random_graphs_with_chains(spark, every, seed):
    rng, edges = random.Random(seed), set()
    for g in range(12):
        size = rng.randint(2, 9)
        for _ in range(rng.randint(1, 14)):
            a, b = rng.randrange(size), rng.randrange(size)
            if g % 3 or a > b:  # every third group is acyclic
                at = f"n{a}"
                for i in range(rng.choice((0, 0, 1, 6))):
                    edges.add((f"g{g}", at, f"x{a}-{b}-{i}"))
                    at = f"x{a}-{b}-{i}"
                edges.add((f"g{g}", at, f"n{b}"))
    got = W.propagate(frame(spark, sorted(edges)), ["g"], "parent", "child", 1, "max", contract_every=every)
    assert {(r["g"], r["node"]): r["value"] for r in got.values.collect()} == layers(edges)


def test_push_down_of_a_long_chain(spark):
    edges = [*long_chain("d", 60), ("d", "x", "40"), ("d", "60", "y")]
    got = {r["node"]: r["level"] for r in LV.pushed_levels(frame(spark, edges), ["g"]).collect()}
    assert got == {**{str(i): i for i in range(61)}, "x": 41, "y": 59}


def hot_edges():
    return [("g", f"c{i}", "hub" if i % 5 else f"p{i % 7}") for i in range(20_000)] + [("g", "hub", "top"), ("g", "p1", "c3")]


def test_rows_of_a_hot_parent_spread(spark):
    e = frame(spark, hot_edges())  # four fifths of the edges on one parent
    salting = S.measure(e, ["g", "parent"], min_rows=500)
    assert [(r["parent"], r["_salts"]) for r in salting.hot.filter("parent = 'hub'").collect()] == [("hub", 32)]
    dealt = salting.streamed(e, ["child"]).repartition(8, *salting.on)
    sizes = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    plain = sorted(r["count"] for r in e.repartition(8, "g", "parent").groupBy(F.spark_partition_id()).count().collect())
    assert plain[-1] >= 16_000


def test_salted_joins_give_the_same(spark):
    e = frame(spark, hot_edges())
    children = e.select("g", F.col("child").alias("parent")).distinct()
    on = ["g", "parent"]
    for salted, how in ((S.semi_join, "left_semi"), (S.anti_join, "left_anti")):
        want, got = e.join(children, on, how), salted(e, children, on, ["child"], min_rows=500)
        assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count()
    named = children.withColumn("seen", F.lit(1))
    assert S.left_join(e, named, on, ["child"], min_rows=500).groupBy("seen").count().collect().__len__() == 2
    assert E.root_edges(e, ["g"]).count() + E.edges_minus_roots(e, ["g"]).count() == e.count()


def test_peel_of_a_hot_parent_with_a_cycle(spark):
    edges = [*hot_edges(), ("h", "a", "hub"), ("h", "hub", "a")]
    plain, split = (P.peel(frame(spark, edges), ["g"], track_nodes=True, min_rows=n) for n in (S.MIN_ROWS, 500))
    assert sorted(split.residue.collect()) == sorted(plain.residue.collect()) and plain.residue.count() == 2
    assert sorted(split.node_rounds.collect()) == sorted(plain.node_rounds.collect())


def test_a_measure_is_bounded(spark):
    assert S.measure(frame(spark, hot_edges()), ["g", "parent"]).hot is None  # fewer rows than a key must have
    assert S.measure(frame(spark, hot_edges()), ["g", "child"], min_rows=10).hot is None
