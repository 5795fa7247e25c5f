
import os

from pyspark.sql import functions as F

from strata.sinks import export as SK
from strata.sources import config as C
from strata.sources import fixtures as FX

from conftest import SF001


def test_config_lines_round_trip(spark):
    edges = FX.dim_edges(spark, SF001)
    back = C.config_edges(C.parse_dimension_lines(FX.dim_config_lines(spark, SF001)))
    assert sorted(back.collect()) == sorted(edges.collect())


def test_json_bodies_round_trip(spark):
    edges = FX.dim_edges(spark, SF001).select("dimension_id", "child", "parent")
    back = C.parse_dimension_json(FX.dim_json(spark, SF001))
    assert sorted(back.collect()) == sorted(edges.collect())


def test_config_file_reader_by_position(spark, scratch):
    path = os.path.join(scratch, "dims")
    os.makedirs(path)
    with open(os.path.join(path, "dimension_configuration.csv"), "w") as f:
        f.write("whatever|names|the|header\n1,2|time|Day|Ad Week, Fiscal Week\n1|time|Ad Week|\n")
    cfg = C.read_dimension_config(spark, path)
    rows = sorted(cfg.collect())
    assert rows[0].tenant_id == [1] and rows[0].parents_level is None
    assert rows[1].tenant_id == [1, 2] and rows[1].parents_level == ["Ad Week", "Fiscal Week"]
    hpath = os.path.join(scratch, "hier")
    os.makedirs(hpath)
    with open(os.path.join(hpath, "h.csv"), "w") as f:
        f.write("a|b|c|d|e|f\n1,2|time|h1|Day|Ad calendar|Ad Week\n")
    h = C.read_hierarchy_config(spark, hpath, tenant_as_array=True).first()
    assert (h.tenant_id, h.from_level, h.hierarchy_name, h.to_level) == ([1, 2], "Day", "Ad calendar", "Ad Week")


def test_written_csv_and_json_read_back(spark, scratch):
    edges = FX.dim_edges(spark, SF001).withColumn("tenant_id", F.col("tenant_id").cast("string"))
    SK.write_table(edges, os.path.join(scratch, "csv"), "csv", header="true", sep="|")
    SK.write_table(edges, os.path.join(scratch, "json"), "json", compression="gzip")
    csv = spark.read.option("header", "true").option("sep", "|").csv(os.path.join(scratch, "csv"))
    js = spark.read.schema(edges.schema).json(os.path.join(scratch, "json"))
    assert sorted(csv.collect()) == sorted(edges.collect())
    assert sorted(js.select(*edges.columns).collect()) == sorted(edges.collect())


def test_partitioned_element_edges(spark, scratch):
    rows = [("1,2", "h", "H", "d", "c", "p", "p1", "c1", "c1", "p1")]
    from strata.operators.expand import ELEMENT_EDGE_COLUMNS
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ELEMENT_EDGE_COLUMNS))
    SK.write_partitioned(df, os.path.join(scratch, "parts"))
    back = spark.read.json(os.path.join(scratch, "parts"))
    assert back.first().tenant_id == "1,2"
    line = SK.csv_lines(df).first().line
    assert line.startswith('"1,2",h,')
