"""No path is lost where hierarchies share id and tenant, and no hierarchy is too large."""

import json
import os
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators.expand import ELEMENT_EDGE_COLUMNS
from strata.operators.hierarchy import HIER_KEYS
from strata.sinks import export as SK

from conftest import SF001

PATHS = "tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string, from_level string, to_level string"


def test_paths_of_two_dimensions_and_a_large_hierarchy(spark):
    paths = spark.createDataFrame([("1", d, "h", "H", "a", p) for d, p in (("d1", "b"), ("d2", "c"))], PATHS)
    n = 100_001
    fixed = {"tenant_id": "1", "hierarchy_id": "h", "hierarchy_name": "H", "child_level": "a"}
    edges = spark.range(n + 1).select(F.when(F.col("id") < n, "d1").otherwise("d2").alias("dimension_id"),
                                      *[F.col("id").cast("string").alias(c) if c not in fixed else F.lit(fixed[c]).alias(c)
                                        for c in ELEMENT_EDGE_COLUMNS if c != "dimension_id"])
    out = SK.hierarchy_payloads(edges.select(*ELEMENT_EDGE_COLUMNS), paths)
    found = {tuple(r): r["count"] for r in out.groupBy("dimension_id", "kind").count().collect()}
    assert sorted(found) == [("d1", "element", n), ("d1", "path", 1), ("d2", "element", 1), ("d2", "path", 1)]
    got = {r.dimension_id: json.loads(r.payload) for r in out.filter("kind = 'path'").collect()}
    assert (got["d1"]["to_level"], got["d2"]["to_level"]) == ("b", "c")


def test_payloads_of_every_valid_hierarchy(spark):
    rows = entry.queries()["element_payloads"](spark, SF001).collect()
    got = Counter((r.kind, r.dimension_id == "time") for r in rows)
    # the generic hierarchies share a few tenants and years, their paths must all be there
    paths = entry.queries()["valid_hierarchies"](spark, SF001).select(*HIER_KEYS, "from_level", "to_level").distinct().count()
    elements = entry.queries()["element_edges"](spark, SF001).count()
    assert got["path", False] == paths > 0 and got["element", False] == elements > 0
    assert got["element", True] == entry.queries()["hier_elements"](spark, SF001).count()
    assert all(json.loads(r.payload)["dimension_id"] == r.dimension_id for r in rows)


def test_one_hierarchy_is_written_by_several_tasks(spark, scratch):
    edges = spark.range(400).repartition(4).select(*[F.lit("1").alias(c) if c in HIER_KEYS else F.col("id").cast("string").alias(c) for c in ELEMENT_EDGE_COLUMNS])
    path = os.path.join(scratch, "parts")
    SK.write_partitioned(edges, path)
    folder = os.path.join(path, "tenant_id=1", "hierarchy_id=1")
    assert len([f for f in os.listdir(folder) if f.startswith("part-")]) == 4
    assert spark.read.json(path).count() == 400
