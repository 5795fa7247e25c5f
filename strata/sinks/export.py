"""Sinks (X1-X4): reports and element edges as JSON, CSV or Parquet datasets.

The reference collects every result to the driver and joins strings there.
Here each sink is a distributed writer; the text forms (``to_json``,
``to_csv``) are column expressions, so a caller can also keep them as a
DataFrame. Payloads are rows (one JSON object per edge, keyed by the
hierarchy); ``write_partitioned`` writes them as one folder per tenant and
hierarchy. The report's map of a dimension comes in parts of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import edges as E
from strata.operators.expand import ELEMENT_EDGE_COLUMNS
from strata.operators.hierarchy import FROM, HIER_KEYS, TO
from strata.operators.sequence import row_number_by


#: Edges of a dimension that one JSON object of the report holds at most.
PART_EDGES = 10_000


def dimension_report_json(report: DataFrame, edges: DataFrame, tenants: DataFrame,
                          part_edges: int = PART_EDGES) -> DataFrame:
    """``dimension_id, part, json`` with objects ``{dimension_id, tenant_id, part, mymap, validity}``.

    ``report`` has ``dimension_id, valid``; ``tenants`` has ``dimension_id,
    tenant_id`` rows. The edges of a dimension are numbered by (level, parent)
    without gathering them, and each run of ``part_edges`` is one object, so a
    dimension has no bound and no object is longer than its part; a level that
    lies on a border continues in the next part. A dimension without edges has
    part 0 with an empty map."""
    numbered = row_number_by(E.edge_set(edges, ["dimension_id"]), ["dimension_id"], ["child", "parent"], out="_n")
    parts = numbered.withColumn("part", F.floor((F.col("_n") - 1) / F.lit(part_edges)).cast("bigint"))
    levels = parts.groupBy("dimension_id", "part", "child").agg(F.array_sort(F.collect_list("parent")).alias("parents"))
    maps = levels.groupBy("dimension_id", "part").agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("child", "parents")))).alias("mymap"))
    t = tenants.groupBy("dimension_id").agg(F.array_sort(F.collect_set("tenant_id")).alias("tenant_id"))
    body = report.join(t, "dimension_id", "left").join(maps, "dimension_id", "left").select(
        "dimension_id", "tenant_id", F.coalesce("part", F.lit(0)).cast("bigint").alias("part"),
        F.coalesce("mymap", F.create_map().cast("map<string,array<string>>")).alias("mymap"), F.col("valid").alias("validity"))
    return body.select("dimension_id", "part", F.to_json(F.struct("dimension_id", "tenant_id", "part", "mymap", "validity")).alias("json"))


def csv_lines(df: DataFrame, columns: list[str] = ELEMENT_EDGE_COLUMNS) -> DataFrame:
    """X2 text form: one CSV line per row (quoted where a value needs it)."""
    return df.select(F.to_csv(F.struct(*columns)).alias("line"))


def hierarchy_payloads(element_edges: DataFrame, path_edges: DataFrame) -> DataFrame:
    """The four hierarchy keys, ``kind`` and ``payload``: one JSON object per
    path edge (``path``) and per element edge (``element``) of every hierarchy.

    Hierarchies that share id and tenant across dimensions stay apart, and no
    hierarchy is gathered in one row, so its size has no bound."""
    paths = E.edge_set(path_edges, HIER_KEYS, FROM, TO).select(
        *HIER_KEYS, F.lit("path").alias("kind"), F.to_json(F.struct(*HIER_KEYS, FROM, TO)).alias("payload"))
    elements = element_edges.select(
        *HIER_KEYS, F.lit("element").alias("kind"), F.to_json(F.struct(*ELEMENT_EDGE_COLUMNS)).alias("payload"))
    return paths.unionByName(elements)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: list[str] | None = None, **options: str) -> None:
    """Write a dataset (``sep``, ``header``, ``compression``, ... as options).

    No ``coalesce(1)``: every task writes its own part file."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def replace_partitions(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] = ["tenant_id"],
                       **options: str) -> None:
    """X4, rerun: replace the partitions that ``df`` has rows of and leave all others as they are.

    Dynamic partition overwrite: every task writes beside the dataset and the
    folders are exchanged when the job commits, so a run that dies changes
    nothing. A null partition value has a folder of its own; an empty text is
    read back as null."""
    write_table(df, path, fmt, "overwrite", partition_by, partitionOverwriteMode="dynamic", **options)


def write_partitioned(element_edges: DataFrame, path: str, fmt: str = "json",
                      mode: str = "errorifexists") -> None:
    """X3, as files: element edges under ``tenant_id=/hierarchy_id=`` folders.

    Every task writes what it holds of a hierarchy; none has to take a whole one."""
    write_table(element_edges, path, fmt, mode, partition_by=["tenant_id", "hierarchy_id"])
