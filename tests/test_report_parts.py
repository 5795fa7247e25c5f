"""The report in parts, and expansion into trees."""

import json

from pyspark.sql import functions as F

from strata.operators import expand as X
from strata.operators.hierarchy import HIER_KEYS
from strata.sinks import export as SK


def test_a_dimension_above_the_part_size_comes_in_parts(spark):
    edges = spark.createDataFrame([("d", f"l{i:03d}", p) for i in range(50) for p in ("x", "y", "z")] + [("e", "a", "b")], "dimension_id string, child string, parent string")
    report = spark.createDataFrame([("d", True), ("e", False), ("none", False)], "dimension_id string, valid boolean")
    tenants = spark.createDataFrame([("d", 2), ("d", 1), ("e", 3)], "dimension_id string, tenant_id int")
    rows = SK.dimension_report_json(report, edges, tenants, part_edges=40).collect()
    bodies = sorted((r["dimension_id"], r["part"], json.loads(r["json"])) for r in rows if r["dimension_id"] == "d")
    assert [p for _, p, _ in bodies] == [0, 1, 2, 3] and all(b["tenant_id"] == [1, 2] and b["validity"] for _, _, b in bodies)
    assert max(sum(map(len, b["mymap"].values())) for _, _, b in bodies) == 40
    back = sorted((c, p) for _, _, b in bodies for c, ps in b["mymap"].items() for p in ps)
    assert back == sorted((r["child"], r["parent"]) for r in edges.filter("dimension_id = 'd'").collect())
    assert [json.loads(r["json"])["mymap"] for r in rows if r["dimension_id"] == "none"] == [{}]


def test_a_dimension_of_more_than_a_hundred_thousand_edges(spark):
    edges = spark.range(100_001).select(F.lit("d").alias("dimension_id"), F.concat(F.lit("l"), "id").alias("child"), F.lit("top").alias("parent"))
    report = spark.createDataFrame([("d", True)], "dimension_id string, valid boolean")
    rows = SK.dimension_report_json(report, edges, spark.createDataFrame([("d", 1)], "dimension_id string, tenant_id int")).collect()
    assert sum(len(json.loads(r["json"])["mymap"]) for r in rows) == 100_001 and len(rows) == 11


def test_path_unique_ids_make_a_tree(spark):
    path = spark.createDataFrame([("0", "d", "h", "n", "A", "B"), ("0", "d", "h", "n", "B", "C")],
                                 ", ".join(f"{k} string" for k in [*HIER_KEYS, "from_level", "to_level"]))
    tree = X.expand(path, fanout=3, path_unique_ids=True).edges
    assert tree.count() == 3 + 9 and tree.groupBy("child_element_id").count().filter("count > 1").isEmpty()
    layered = X.expand(path, fanout=3).edges
    assert layered.select("child_level", "child_element_id").distinct().count() == 6
    assert X.expand(path.limit(0)).edges.count() == 0
