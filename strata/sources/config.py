"""Configuration readers (S1-S4) and the explodes that turn them into edges.

The configuration files are CSV with a header and ``|`` as delimiter, read by
column *position* (the header names are not trusted). Fields are parsed with
column expressions only, so Catalyst keeps them inside whole-stage codegen and
filters written later still reach the scan.

Spark 4 runs in ANSI mode, where ``cast`` of a bad string fails the job; the
parsers use ``try_cast`` so that one bad line cannot fail a whole load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIM_RAW = ("tenant_id string, dimension_id string, dimension_level string, "
           "parents_level string")
HIER_RAW = ("tenant_id string, dimension_id string, hierarchy_id string, from_level string, "
            "hierarchy_name string, to_level string")
CSV_OPTIONS = {"sep": "|", "header": "true", "enforceSchema": "true", "mode": "PERMISSIVE"}


def split_trim(c: Column, sep: str = ",") -> Column:
    """``"a, b"`` -> ``["a", "b"]``; null stays null, empty items are dropped."""
    items = F.transform(F.split(c, sep), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != F.lit(""))


def split_ints(c: Column, sep: str = ",") -> Column:
    """``"1,2"`` -> ``[1, 2]``; items that are no integer become null."""
    return F.transform(F.split(c, sep), lambda x: F.trim(x).try_cast("int"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def _from_lines(lines: DataFrame, schema: str, column: str) -> DataFrame:
    parsed = F.from_csv(F.col(column), schema, {"sep": "|"}).alias("r")
    return lines.select(parsed).select("r.*")


# -- dimensions -------------------------------------------------------------

def parse_dimension_rows(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """S1 on raw string columns: tenant list to ``array<int>``, parents to ``array<string>``.

    ``carry`` names extra columns kept as they are (for instance the upload file)."""
    return raw.select(
        *carry,
        split_ints(F.col("tenant_id")).alias("tenant_id"),
        F.trim("dimension_id").alias("dimension_id"),
        F.trim("dimension_level").alias("dimension_level"),
        split_trim(F.col("parents_level")).alias("parents_level"),
    )


def read_dimension_config(spark: SparkSession, path: str) -> DataFrame:
    """A dimension configuration file (or folder of files)."""
    return parse_dimension_rows(_read(spark, path, DIM_RAW))


def parse_dimension_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """S1 on a column of configuration lines (same parser as the file reader)."""
    return parse_dimension_rows(_from_lines(lines, DIM_RAW, column))


def explode_parents(config: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per (level, parent); a level without parents has no row."""
    return config.select(*carry, "tenant_id", "dimension_id", "dimension_level",
                         F.explode("parents_level").alias("parent_level"))


def explode_tenants(df: DataFrame) -> DataFrame:
    """One row per tenant of a tenant list; a row without tenants stays, with a null one."""
    return df.withColumn("tenant_id", F.explode_outer("tenant_id"))


def config_edges(config: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Dimension configuration -> distinct edges ``tenant_id, dimension_id, child, parent``."""
    e = explode_tenants(explode_parents(config, carry))
    return e.select(*carry, "tenant_id", "dimension_id", F.col("dimension_level").alias("child"),
                    F.col("parent_level").alias("parent")).distinct()


def declared_levels(config: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every (dimension, level) named in the configuration, as child or parent."""
    own = config.select(*carry, "dimension_id", F.col("dimension_level").alias("level"))
    parents = config.select(*carry, "dimension_id", F.explode("parents_level").alias("level"))
    return own.unionByName(parents).filter(F.col("level").isNotNull()).distinct()


def dimension_of_tenant(edges: DataFrame, dimension_id: str | None = None,
                        tenant_id: int | None = None) -> DataFrame:
    """P5: the edges of one dimension and/or one tenant (a pushed-down filter)."""
    cond = F.lit(True)
    if dimension_id is not None:
        cond = cond & (F.col("dimension_id") == dimension_id)
    if tenant_id is not None:
        cond = cond & (F.col("tenant_id") == tenant_id)
    return edges.filter(cond)


# -- hierarchies ------------------------------------------------------------

def parse_hierarchy_rows(raw: DataFrame, tenant_as_array: bool = False) -> DataFrame:
    """S2 (six strings) or S3 (tenant list as ``array<int>``)."""
    tenant = split_ints(F.col("tenant_id")) if tenant_as_array else F.trim("tenant_id")
    return raw.select(
        tenant.alias("tenant_id"),
        *[F.trim(c).alias(c) for c in
          ("dimension_id", "hierarchy_id", "from_level", "hierarchy_name", "to_level")],
    )


def read_hierarchy_config(spark: SparkSession, path: str, tenant_as_array: bool = False) -> DataFrame:
    return parse_hierarchy_rows(_read(spark, path, HIER_RAW), tenant_as_array)


def parse_hierarchy_lines(lines: DataFrame, column: str = "line",
                          tenant_as_array: bool = False) -> DataFrame:
    return parse_hierarchy_rows(_from_lines(lines, HIER_RAW, column), tenant_as_array)


# -- ad-hoc JSON dimensions -------------------------------------------------

def parse_dimension_json(bodies: DataFrame, body: str = "body",
                         keys: tuple[str, ...] = ("dimension_id",)) -> DataFrame:
    """``{"child": ["parent", ...]}`` bodies -> edges ``keys, child, parent``.

    Works on a table of bodies, one row per request, so many dimensions are
    checked in one job."""
    m = F.from_json(F.col(body), "map<string,array<string>>")
    entries = bodies.select(*keys, F.explode(m).alias("child", "parents"))
    return entries.select(*keys, F.trim("child").alias("child"),
                          F.explode("parents").alias("parent")).select(
        *keys, "child", F.trim("parent").alias("parent")).filter(F.col("parent") != "").distinct()
