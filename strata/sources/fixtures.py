"""Edge tables derived from the driver's parquet tables.

The reference reads small CSV configuration files that are not shipped, so the
tests and the bench derive configuration-shaped edge tables from the TPC-H-ish
tables instead (FIXTURES.md §3). Every fixture is a plain DataFrame plan over
the parquet scan: the work grows with the data, and the filters and column
selections reach the scan.

Column conventions used throughout the package:

* dimension edges: ``tenant_id int, dimension_id, child, parent``
* hierarchy edges: ``tenant_id string, dimension_id, hierarchy_id,
  hierarchy_name, from_level, to_level``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table

# The calendar hierarchies the generator has rules for, child
CALENDAR_CHAINS = {
    "ad_calendar": ["Day", "Ad Week", "Ad Period", "Ad Year"],
    "fiscal_calendar": ["Day", "Fiscal Week", "Fiscal Week Index", "Fiscal Period", "Fiscal Year"],
    "fiscal_quarter": ["Day", "Fiscal Week", "Fiscal Period", "Fiscal Quarter"],
}


def _s(c: Column) -> Column:
    return c.cast("string")


def _order_edge_columns(o: DataFrame) -> list[Column]:
    return [
        (F.col("o_custkey") % 4).cast("int").alias("tenant_id"),
        F.concat(F.lit("D"), _s(F.col("o_custkey"))).alias("dimension_id"),
        F.concat(F.lit("L"), _s(F.col("o_orderkey") % 16)).alias("child"),
        F.concat(F.lit("L"), _s(F.expr("(o_orderkey div 16) % 16"))).alias("parent"),
    ]


def dim_edges(spark: SparkSession, sf_dir: str, open_only: bool = False) -> DataFrame:
    """One level graph per customer: child and parent levels from the order key."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    if open_only:
        o = o.filter(F.col("o_orderstatus") != "P")
    return o.select(*_order_edge_columns(o)).distinct()


def declared_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (tenant, dimension) of every customer, with orders or without."""
    c = table(spark, sf_dir, "customer", "c_custkey")
    return c.select((F.col("c_custkey") % 4).cast("int").alias("tenant_id"),
                    F.concat(F.lit("D"), _s(F.col("c_custkey"))).alias("dimension_id")).distinct()


def hier_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hierarchy path per (customer, order year), levels as in ``dim_edges``."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    year = _s(F.year("o_orderdate"))
    return o.select(
        _s(F.col("o_custkey") % 4).alias("tenant_id"),
        F.concat(F.lit("D"), _s(F.col("o_custkey"))).alias("dimension_id"),
        F.concat(F.lit("H"), year).alias("hierarchy_id"),
        F.concat(F.lit("hierarchy "), year).alias("hierarchy_name"),
        F.concat(F.lit("L"), _s(F.col("o_orderkey") % 16)).alias("from_level"),
        F.concat(F.lit("L"), _s(F.expr("(o_orderkey div 16) % 16"))).alias("to_level"),
    ).distinct()


def geo_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> nation -> region, supplier -> nation and supplier -> region."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    customer = table(spark, sf_dir, "customer", "c_name", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier", "s_name", "s_nationkey")
    n_r = nation.join(region, nation.n_regionkey == region.r_regionkey)
    parts = [
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(F.col("c_name").alias("child"), F.col("n_name").alias("parent")),
        n_r.select(F.col("n_name").alias("child"), F.col("r_name").alias("parent")),
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(F.col("s_name").alias("child"), F.col("n_name").alias("parent")),
        supplier.join(n_r, supplier.s_nationkey == n_r.n_nationkey)
        .select(F.col("s_name").alias("child"), F.col("r_name").alias("parent")),
    ]
    edges = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return edges.select(
        F.lit(0).alias("tenant_id"), F.lit("geo").alias("dimension_id"), "child", "parent"
    ).distinct()


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> brand and type -> type (``p_name`` is not unique, the key is)."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    brand_type = F.concat_ws(" ", "p_brand", "p_type")
    leaf = p.select(F.concat(F.lit("P"), _s(F.col("p_partkey"))).alias("child"),
                    brand_type.alias("parent"))
    mid = p.select(brand_type.alias("child"), F.col("p_type").alias("parent"))
    return leaf.unionByName(mid).select(
        F.lit(0).alias("tenant_id"), F.lit("part").alias("dimension_id"), "child", "parent"
    ).distinct()


def level_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimension edge fixtures together: orders, geography and parts."""
    return (dim_edges(spark, sf_dir)
            .unionByName(geo_edges(spark, sf_dir))
            .unionByName(part_edges(spark, sf_dir)))


def calendar_hierarchies(spark: SparkSession) -> DataFrame:
    """The calendar hierarchy configuration as hierarchy edges (tenant '0')."""
    rows = []
    for hid, chain in CALENDAR_CHAINS.items():
        for child, parent in zip(chain, chain[1:]):
            rows.append(("0", "time", hid, hid.replace("_", " "), child, parent))
    return spark.createDataFrame(
        rows, "tenant_id string, dimension_id string, hierarchy_id string, "
              "hierarchy_name string, from_level string, to_level string")


def time_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root elements of the calendar hierarchies: the years (and year-quarters)
    in which orders were placed. Columns: hierarchy_id, level, element_id."""
    o = table(spark, sf_dir, "orders", "o_orderdate")
    year = _s(F.year("o_orderdate"))
    years = o.select(year.alias("element_id")).distinct()
    quarters = o.select(
        F.concat(year, F.lit("0"), _s(F.quarter("o_orderdate"))).alias("element_id")
    ).distinct()
    return (
        years.select(F.lit("ad_calendar").alias("hierarchy_id"), F.lit("Ad Year").alias("level"), "element_id")
        .unionByName(years.select(F.lit("fiscal_calendar").alias("hierarchy_id"),
                                  F.lit("Fiscal Year").alias("level"), "element_id"))
        .unionByName(quarters.select(F.lit("fiscal_quarter").alias("hierarchy_id"),
                                     F.lit("Fiscal Quarter").alias("level"), "element_id"))
    )


def dim_config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_edges`` written as configuration lines ``tenants|dimension|level|parents``.

    One line per (dimension, level); tenants joined by ',' and parents by ', ',
    both sorted so that the text is reproducible."""
    e = dim_edges(spark, sf_dir)
    g = e.groupBy("dimension_id", "child").agg(
        F.array_join(F.array_sort(F.collect_set(_s(F.col("tenant_id")))), ",").alias("tenants"),
        F.array_join(F.array_sort(F.collect_set("parent")), ", ").alias("parents"),
    )
    return g.select(F.concat_ws("|", "tenants", "dimension_id", "child", "parents").alias("line"))


def hier_config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hier_edges`` as lines ``tenant|dimension|hierarchy|from|name|to``."""
    h = hier_edges(spark, sf_dir)
    return h.select(F.concat_ws("|", "tenant_id", "dimension_id", "hierarchy_id", "from_level",
                                "hierarchy_name", "to_level").alias("line"))


def dim_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per dimension, ``{"child": ["parent", ...], ...}``: the
    ad-hoc dimension format. Bodies are whole dimensions by definition of the
    format (one request each), so this is built per dimension."""
    e = dim_edges(spark, sf_dir)
    adj = e.groupBy("dimension_id", "child").agg(F.array_sort(F.collect_set("parent")).alias("parents"))
    return adj.groupBy("dimension_id").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("child", "parents"))))).alias("body")
    )


def hier_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per hierarchy, ``{"from": ["to", ...], ...}``: the ad-hoc
    hierarchy format (a level may list several targets, which the check rejects)."""
    h = hier_edges(spark, sf_dir)
    keys = ["tenant_id", "dimension_id", "hierarchy_id", "hierarchy_name"]
    adj = h.groupBy(*keys, "from_level").agg(F.array_sort(F.collect_set("to_level")).alias("to"))
    return adj.groupBy(*keys).agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("from_level", "to"))))).alias("body"))


def _tenant_list(c: Column) -> Column:
    """One to three tenants, by the key: ``"3"``, ``"3, 0"`` or ``"3, 0, 1"``."""
    return F.array_join(F.transform(F.sequence(F.lit(0), (c % 3).cast("int")), lambda i: _s((c + i) % 4)), ", ")


def rough_config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension line per order, ``tenants|dimension|level|parents``, most with several
    tenants and, by the order key, with every kind of damage: no or bad tenants, no
    dimension, no level, no or empty parents, a field too few or too many."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    up = F.concat(F.lit("L"), _s(F.expr("(o_orderkey div 16) % 16")))
    tenants = (F.when(k % 13 == 0, "").when(k % 13 == 1, "x")
               .when(k % 13 == 2, F.concat(_s(c % 4), F.lit(",x"))).otherwise(_tenant_list(c)))
    dimension = F.when(k % 17 == 0, " ").otherwise(F.concat(F.lit("D"), _s(c)))
    level = F.when(k % 19 == 0, "").otherwise(F.concat(F.lit("L"), _s(k % 16)))
    parents = (F.when(k % 23 == 0, "").when(k % 23 == 1, F.concat(up, F.lit(",, Ltop"))).otherwise(up))
    return o.select(F.when(k % 29 == 0, F.concat_ws("|", tenants, dimension))
                    .when(k % 29 == 1, F.concat_ws("|", tenants, dimension, level, parents, F.lit("more")))
                    .otherwise(F.concat_ws("|", tenants, dimension, level, parents)).alias("line"))


def shared_hier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hier_edges`` as lines whose hierarchies belong to one to three tenants."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    year = _s(F.year("o_orderdate"))
    return o.select(F.concat_ws(
        "|", _tenant_list(F.col("o_custkey")), F.concat(F.lit("D"), _s(F.col("o_custkey"))), F.concat(F.lit("H"), year),
        F.concat(F.lit("L"), _s(F.col("o_orderkey") % 16)), F.concat(F.lit("hierarchy "), year),
        F.concat(F.lit("L"), _s(F.expr("(o_orderkey div 16) % 16")))).alias("line")).distinct()


# The levels that E1 draws a value for, and one that it does not.
TOP_LEVELS = ["Ad Year", "Fiscal Year", "Ad Week", "Fiscal Week", "Ad Period", "Fiscal Period", "Fiscal Quarter", "Season"]


def top_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path per order day of a customer, ``Day`` below one of ``TOP_LEVELS`` by the customer key."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    top = F.element_at(F.array(*[F.lit(t) for t in TOP_LEVELS]), (F.col("o_custkey") % len(TOP_LEVELS) + 1).cast("int"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select(_s(F.col("o_custkey") % 4).alias("tenant_id"), F.concat(F.lit("D"), _s(F.col("o_custkey"))).alias("dimension_id"),
                    F.concat(F.lit("H"), day).alias("hierarchy_id"), F.concat(F.lit("from "), day).alias("hierarchy_name"),
                    F.lit("Day").alias("from_level"), top.alias("to_level")).distinct()
