"""Paths in segments, and reruns that replace their own partitions only."""

import os

from pyspark.sql import functions as F

from strata.operators import hierarchy as H
from strata.sinks import export as SK

KEYS = "tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string"


def test_segments_in_order_are_the_whole_text(spark):
    rows = [("0", "d", h, "n", f"a{i:02d}", f"b{i:02d}") for h, n in (("long", 25), ("short", 3)) for i in range(n)]
    pe = spark.createDataFrame(rows, f"{KEYS}, from_level string, to_level string")
    got = {}
    for r in sorted(H.path_segments(pe, segment_edges=10).collect(), key=lambda r: (r["hierarchy_id"], r["segment"])):
        got.setdefault(r["hierarchy_id"], []).append((r["segment"], r["n_edges"], r["path"]))
    assert [(s, n) for s, n, _ in got["long"]] == [(0, 10), (1, 10), (2, 5)] and [(s, n) for s, n, _ in got["short"]] == [(0, 3)]
    for h, parts in got.items():
        assert ";".join(p for _, _, p in parts) == ";".join(f"{a}>{b}" for _, _, x, _, a, b in rows if x == h)


def test_segments_in_the_order_of_the_chain(spark):
    chain = ["z", "a", "m", "b", "top"]
    pe = spark.createDataFrame([("0", "d", "h", "n", a, b) for a, b in zip(chain, chain[1:])], f"{KEYS}, from_level string, to_level string")
    steps = H.invert_path(pe).select(*H.HIER_KEYS, F.col("child_level").alias("from_level"), F.col("parent_level").alias("to_level"), "step")
    got = sorted((r["segment"], r["path"]) for r in H.path_segments(steps, order=["step"], segment_edges=3).collect())
    assert got == [(0, "b>top;m>b;a>m"), (1, "z>a")]


def test_a_path_of_a_million_edges(spark):
    pe = spark.range(1_000_000).select(
        *[F.lit(k).alias(k) for k in H.HIER_KEYS], F.concat(F.lit("l"), F.lpad("id", 7, "0")).alias("from_level"),
        F.concat(F.lit("l"), F.lpad(F.col("id") + 1, 7, "0")).alias("to_level"))
    s = H.path_segments(pe)
    r = s.agg(F.count("*").alias("n"), F.sum("n_edges").alias("edges"), F.max("n_edges").alias("most"), F.max(F.length("path")).alias("longest")).first()
    assert (r["n"], r["edges"], r["most"]) == (100, 1_000_000, 10_000) and r["longest"] == 10_000 * 17 + 9_999


def test_a_rerun_replaces_only_its_own_partitions(spark, scratch):
    schema = "tenant_id string, child string, parent string"
    first = spark.createDataFrame([("1", "a", "b"), ("1", "b", "c"), ("2", "x", "y"), (None, "n", "m")], schema)
    for fmt, options in (("parquet", {}), ("csv", {"header": "true"}), ("json", {})):
        path = os.path.join(scratch, fmt)
        SK.write_table(first, path, fmt, partition_by=["tenant_id"], **options)
        SK.replace_partitions(spark.createDataFrame([("1", "new", "b"), ("3", "p", "q")], schema), path, fmt, **options)
        SK.replace_partitions(first.limit(0), path, fmt, **options)
        back = spark.read.schema(schema).options(**options).format(fmt).load(path).select("tenant_id", "child", "parent")
        assert {tuple(r) for r in back.collect()} == {("1", "new", "b"), ("2", "x", "y"), ("3", "p", "q"), (None, "n", "m")}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    with open(next(os.path.join(d, f) for d, _, fs in os.walk(os.path.join(scratch, "csv")) for f in fs if f.endswith(".csv"))) as f:
        assert f.readline().strip() == "child,parent"
