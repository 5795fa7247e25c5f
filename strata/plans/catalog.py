"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the fixtures) and runs one
the DuckDB restatement under the same name where SQL can express it. Arrays
and maps are returned as sorted text so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import edges as E
from strata.operators import hierarchy as H
from strata.operators import peel as P
from strata.sources import config as C
from strata.sources import fixtures as FX
from strata.sources.tables import table
from strata.session import cut

DIM = ["dimension_id"]
TD = ["tenant_id", "dimension_id"]
HK = H.HIER_KEYS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _join_sorted(c) -> F.Column:
    return F.array_join(F.array_sort(c), ",")


# -- dimensions: peel ---------------------------------------------------------

@query
def dim_validity(spark, sf_dir):
    """Every dimension of ``dim_edges``; EMPTY / CYCLE or valid."""
    return P.validity(FX.dim_edges(spark, sf_dir), DIM)


@query
def edge_table_validity(spark, sf_dir):
    """D2 (v1 rules, empty is valid): ``dim_edges_open`` per (tenant, dimension)
    of ``dim_edges``; three dimensions have no open order and are empty."""
    groups = FX.dim_edges(spark, sf_dir).select(*TD)
    return P.validity(FX.dim_edges(spark, sf_dir, open_only=True), TD, groups=groups,
                      empty_is_valid=True)


@query
def edge_table_validity_all(spark, sf_dir):
    """D2 over every row of ``dim_edges``: all (tenant, dimension) groups, with the
    dimensions that a customer declares and no order gives a parent as empty ones."""
    edges = FX.dim_edges(spark, sf_dir)
    groups = edges.select(*TD).unionByName(FX.declared_dimensions(spark, sf_dir))
    return P.validity(edges, TD, groups=groups, empty_is_valid=True)


@query
def valid_dimensions(spark, sf_dir):
    """D3: the edges of the valid dimensions."""
    return P.valid_groups(FX.dim_edges(spark, sf_dir), DIM).select("tenant_id", *DIM, "child", "parent")


@query
def cycle_residue(spark, sf_dir):
    """Edges whose parent is on a cycle or leads up to one."""
    e = FX.dim_edges(spark, sf_dir)
    return P.peel(e, DIM).residue.join(e, [*DIM, "child", "parent"]).select(
        "tenant_id", *DIM, "child", "parent")


# -- edge sets and profiles ---------------------------------------------------

@query
def edge_set(spark, sf_dir):
    """S5 addEdge: distinct edges from the raw (repeating) order rows."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    raw = o.select(*FX._order_edge_columns(o))
    return E.edge_set(raw, TD)


@query
def node_set(spark, sf_dir):
    """S5 addNode: every level of every dimension."""
    return E.node_set(FX.dim_edges(spark, sf_dir), DIM)


@query
def dim_profile(spark, sf_dir):
    """A4: edges, nodes, roots, leaves per dimension (orders, geography, parts)."""
    return E.profile(FX.level_edges(spark, sf_dir), DIM)


@query
def root_edges(spark, sf_dir):
    """Edges whose parent is no level of the dimension."""
    return E.root_edges(FX.dim_edges(spark, sf_dir), DIM).select("tenant_id", *DIM, "child", "parent")


@query
def edges_minus_roots(spark, sf_dir):
    """The table MINUS its root edges."""
    return E.edges_minus_roots(FX.dim_edges(spark, sf_dir), DIM).select(
        "tenant_id", *DIM, "child", "parent")


@query
def dim_graph(spark, sf_dir):
    """A1 (row form): one row per (dimension, level) with its sorted parents."""
    a = E.adjacency(FX.dim_edges(spark, sf_dir), DIM)
    return a.select(*DIM, F.col("child").alias("level"), F.array_join("parents", ",").alias("parents"),
                    F.size("parents").cast("bigint").alias("n_parents"))


# -- configuration readers ------------------------------------------------------

def _dim_config(spark, sf_dir):
    return C.parse_dimension_lines(FX.dim_config_lines(spark, sf_dir))


@query
def dim_config_parse(spark, sf_dir):
    """Configuration lines parsed by position; arrays shown as text."""
    c = _dim_config(spark, sf_dir)
    return c.select(_join_sorted(F.col("tenant_id")).alias("tenant_ids"), *DIM, "dimension_level",
                    _join_sorted(F.col("parents_level")).alias("parents"),
                    F.size("parents_level").cast("bigint").alias("n_parents"))


@query
def hier_config_parse(spark, sf_dir):
    """Hierarchy lines, six strings by position."""
    return C.parse_hierarchy_lines(FX.hier_config_lines(spark, sf_dir))


@query
def hier_config_tenant_array(spark, sf_dir):
    """S3: hierarchy lines with the tenant list as ``array<int>``."""
    h = C.parse_hierarchy_lines(FX.hier_config_lines(spark, sf_dir), tenant_as_array=True)
    return h.select(F.array_join("tenant_id", ",").alias("tenant_ids"),
                    F.size("tenant_id").cast("bigint").alias("n_tenants"),
                    "dimension_id", "hierarchy_id", "from_level", "hierarchy_name", "to_level")


@query
def dim_json_parse(spark, sf_dir):
    """JSON dimension bodies back to edges."""
    return C.parse_dimension_json(FX.dim_json(spark, sf_dir))


@query
def explode_parents(spark, sf_dir):
    """One row per (level, parent)."""
    e = C.explode_parents(_dim_config(spark, sf_dir))
    return e.select(F.array_join("tenant_id", ",").alias("tenant_ids"), *DIM, "dimension_level",
                    "parent_level")


@query
def explode_tenants(spark, sf_dir):
    """One row per (tenant, level, parent)."""
    return C.config_edges(_dim_config(spark, sf_dir))


@query
def dim_of_tenant(spark, sf_dir):
    """P5: the dimensions of one tenant (the filter of the v1 check)."""
    return C.dimension_of_tenant(C.config_edges(_dim_config(spark, sf_dir)), tenant_id=1)


@query
def dim_report(spark, sf_dir):
    """Per dimension of the configuration: tenants, levels, edges, validity."""
    # Read four times below (edges, levels, tenants, level counts): parse once.
    cfg = cut(_dim_config(spark, sf_dir))
    edges = C.config_edges(cfg)
    levels = C.declared_levels(cfg)
    v = P.validity(edges, DIM, groups=levels)
    tenants = C.explode_tenants(cfg).groupBy(*DIM).agg(
        _join_sorted(F.collect_set("tenant_id")).alias("tenant_ids"))
    n_levels = levels.groupBy(*DIM).agg(F.count(F.lit(1)).alias("n_levels"))
    return v.join(tenants, DIM, "left").join(n_levels, DIM, "left").select(
        *DIM, "tenant_ids", "n_levels", "n_edges", "n_residue", "reason", "valid")


@query
def dim_json_validity(spark, sf_dir):
    """Ad-hoc JSON dimensions, answered as the route does."""
    bodies = FX.dim_json(spark, sf_dir)
    v = P.validity(C.parse_dimension_json(bodies), DIM, groups=bodies.select(*DIM))
    return v.select(*DIM, "valid", F.concat(F.lit("The dimension is "),
                                            F.when(F.col("valid"), "valid.").otherwise("not valid."))
                    .alias("answer"))


# -- hierarchies -----------------------------------------------------------------

def _hier(spark, sf_dir):
    return FX.hier_edges(spark, sf_dir)


def _dims_open(spark, sf_dir):
    return FX.dim_edges(spark, sf_dir, open_only=True)


@query
def hier_path(spark, sf_dir):
    """A2: one path per hierarchy, entries ``from>to`` sorted; the text of one path is one row."""
    pe = H.path_edges(_hier(spark, sf_dir))
    return pe.groupBy(*HK).agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(">", "from_level", "to_level"))), ";")
        .alias("path"))


@query
def path_start_end(spark, sf_dir):
    """Start and end levels of every hierarchy path."""
    return E.path_start_end(H.path_edges(_hier(spark, sf_dir)), HK)


@query
def single_parent(spark, sf_dir):
    """H3: each level of the path has at most one parent."""
    return H.single_parent(_hier(spark, sf_dir))


@query
def hier_json_single_parent(spark, sf_dir):
    """H3 (JSON route): every level of an ad-hoc hierarchy body has one target."""
    return H.json_single_parent(FX.hier_json(spark, sf_dir))


@query
def path_edges_exist(spark, sf_dir):
    """H1: every path edge is an edge of the (unvalidated) dimension."""
    return H.path_edges_exist(_hier(spark, sf_dir), _dims_open(spark, sf_dir))


@query
def hier_validity(spark, sf_dir):
    """H2 with reasons, ``hier_edges`` against ``dim_edges_open``."""
    return H.validate(_hier(spark, sf_dir), _dims_open(spark, sf_dir))


@query
def valid_hierarchies(spark, sf_dir):
    """H5: path edges of the valid hierarchies."""
    return H.valid_hierarchies(_hier(spark, sf_dir), _dims_open(spark, sf_dir))


@query
def path_explode(spark, sf_dir):
    """Valid paths as named key/value columns, in row form: no map of a path is built."""
    pe = H.path_edges(H.valid_hierarchies(_hier(spark, sf_dir), _dims_open(spark, sf_dir)))
    return pe.select(*HK, F.col("from_level").alias("child_level"), F.col("to_level").alias("parent_level"))


@query
def path_inverted(spark, sf_dir):
    """H6: valid paths parent -> child, with the step from the top."""
    return H.invert_path(H.valid_hierarchies(_hier(spark, sf_dir), _dims_open(spark, sf_dir)))


# -- calendar rules (E3, E5-E10) -------------------------------------------------

from strata.functions import calendar as CAL  # noqa: E402
from strata.functions import rules as R  # noqa: E402
from strata.operators import expand as X  # noqa: E402
from strata.operators import levels as LV  # noqa: E402

SEED = 42


def _years(spark, sf_dir):
    r = FX.time_roots(spark, sf_dir)
    return r.filter(F.col("hierarchy_id") == "ad_calendar").select(F.col("element_id").alias("year"))


def _periods(spark, sf_dir):
    return _years(spark, sf_dir).select(F.explode(CAL.year_periods(F.col("year"))).alias("period"))


@query
def year_periods(spark, sf_dir):
    """E5: the 13 periods of every order year."""
    return _years(spark, sf_dir).select("year", F.explode(CAL.year_periods(F.col("year"))).alias("period"))


@query
def period_weeks(spark, sf_dir):
    """The 4 week starts of every period."""
    return _periods(spark, sf_dir).select("period", F.explode(CAL.period_weeks(F.col("period"))).alias("week_start"))


@query
def week_days(spark, sf_dir):
    """The 7 days of every week of every period."""
    weeks = _periods(spark, sf_dir).select(F.explode(CAL.period_weeks(F.col("period"))).alias("week_start"))
    return weeks.select("week_start", F.explode(CAL.week_days(F.col("week_start"))).alias("day"))


@query
def period_week_indices(spark, sf_dir):
    """The 4 week indices of every period."""
    return _periods(spark, sf_dir).select(
        "period", F.explode(CAL.period_week_indices(F.col("period"))).alias("week_index"))


@query
def index_week(spark, sf_dir):
    """The week start of every week index."""
    idx = _periods(spark, sf_dir).select(F.explode(CAL.period_week_indices(F.col("period"))).alias("week_index"))
    return idx.select("week_index", F.explode(CAL.index_week(F.col("week_index"))).alias("week_start"))


@query
def quarter_periods(spark, sf_dir):
    """The 4 periods of every (year, quarter) with orders."""
    q = FX.time_roots(spark, sf_dir).filter(F.col("hierarchy_id") == "fiscal_quarter")
    return q.select(F.col("element_id").alias("quarter"),
                    F.explode(CAL.quarter_periods(F.col("element_id"))).alias("period"))


@query
def random_week_starts(spark, sf_dir):
    """A seeded random week start for every order date used as anchor."""
    d = table(spark, sf_dir, "orders", "o_orderdate").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("anchor")).distinct()
    return d.select("anchor", CAL.random_week_start(F.to_date("anchor"), SEED, F.col("anchor"))
                    .alias("week_start"))


# -- generation (E1, E12-E17) --------------------------------------------------------

def _valid_generic(spark, sf_dir):
    return H.valid_hierarchies(_hier(spark, sf_dir), _dims_open(spark, sf_dir))


def _calendar_roots(spark, sf_dir):
    cal = FX.calendar_hierarchies(spark).select(*HK).distinct()
    r = FX.time_roots(spark, sf_dir)
    return cal.join(r, "hierarchy_id").select(*HK, "level", "element_id",
                                              F.col("element_id").alias("element_label"))


@query
def top_elements(spark, sf_dir):
    """The seeded top element of every valid hierarchy and calendar."""
    pe = _valid_generic(spark, sf_dir).unionByName(FX.calendar_hierarchies(spark))
    return X.top_elements(pe, seed=SEED)


@query
def generic_children(spark, sf_dir):
    """E11/E12 with a fixed fan-out of 3: children of each generic top element."""
    pe = _valid_generic(spark, sf_dir)
    tops = X.top_elements(pe, seed=SEED)
    inv = pe.select(*HK, F.col("to_level").alias("level"), F.col("from_level").alias("child_level"))
    j = tops.join(inv, [*HK, "level"])
    vals = R.child_values(F.col("child_level"), F.col("level"), F.col("element_label"), F.lit(3))
    k = j.select(*HK, F.col("level").alias("parent_level"), "child_level",
                 F.col("element_id").alias("parent_element_id"), F.posexplode(vals).alias("pos", "value"))
    return k.select(*HK, "parent_level", "child_level", "parent_element_id",
                    R.child_id(F.col("child_level"), F.col("value"), F.col("pos")).alias("child_element_id"),
                    R.child_label(F.col("child_level"), F.col("value"), F.col("pos")).alias("child_element_label"))


@query
def hier_elements(spark, sf_dir):
    """The calendars expanded from the order years (rule-driven, no draw)."""
    exp = X.expand(FX.calendar_hierarchies(spark), roots=_calendar_roots(spark, sf_dir), seed=SEED)
    return exp.edges


@query
def element_edges(spark, sf_dir):
    """Valid generic hierarchies from seeded tops, seeded 3-4 fan-out."""
    return X.expand(_valid_generic(spark, sf_dir), seed=SEED).edges


@query
def element_tree(spark, sf_dir):
    """E13 with ids that hold the path: every element of the valid generic hierarchies has one parent."""
    return X.expand(_valid_generic(spark, sf_dir), seed=SEED, fanout=3, path_unique_ids=True).edges


@query
def element_rejects(spark, sf_dir):
    """Parents that no rule can parse: every order date as a quarter label, beside the quarters themselves."""
    key = {"tenant_id": "0", "dimension_id": "time", "hierarchy_id": "fiscal_quarter", "hierarchy_name": "fiscal quarter"}
    dates = table(spark, sf_dir, "orders", "o_orderdate").select(
        F.concat(F.lit("Q"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("element_id")).distinct()
    dates = dates.select(*[F.lit(v).alias(k) for k, v in key.items()], F.lit("Fiscal Quarter").alias("level"), "element_id",
                         F.col("element_id").alias("element_label"))
    roots = dates.unionByName(_calendar_roots(spark, sf_dir).filter("hierarchy_id = 'fiscal_quarter'"))
    return X.expand(FX.calendar_hierarchies(spark), roots=roots, seed=SEED).rejected


@query
def sequential_years(spark, sf_dir):
    """One year per valid hierarchy, consecutive within each tenant."""
    g = H.hierarchy_groups(_valid_generic(spark, sf_dir))
    return X.sequential_years(g, ["tenant_id"], ["dimension_id", "hierarchy_id", "hierarchy_name"], SEED)


@query
def edgewise_elements(spark, sf_dir):
    """v1 generator, each path edge on its own (calendars and generic paths)."""
    pe = _valid_generic(spark, sf_dir).unionByName(FX.calendar_hierarchies(spark))
    return X.edgewise_elements(pe, seed=SEED)


@query
def edgewise_rejected(spark, sf_dir):
    """Path edges of ``edgewise_elements`` whose parent no rule can parse."""
    pe = _valid_generic(spark, sf_dir).unionByName(FX.calendar_hierarchies(spark))
    return X.edgewise(pe, seed=SEED).rejected


# -- levels (T1-T4) ---------------------------------------------------------------

def _levels(spark, sf_dir):
    return LV.pushed_levels(FX.level_edges(spark, sf_dir), DIM)


@query
def node_levels(spark, sf_dir):
    """Longest path to a root, for every node of the acyclic dimensions."""
    return LV.node_levels(FX.level_edges(spark, sf_dir), DIM)[0]


@query
def node_levels_pushed(spark, sf_dir):
    """Levels after pushing nodes down to their children."""
    return _levels(spark, sf_dir)


@query
def skip_level_edges(spark, sf_dir):
    """Edges that skip a level (pushed levels)."""
    e = FX.level_edges(spark, sf_dir).select(*DIM, "child", "parent")
    return LV.skip_level_edges(e, _levels(spark, sf_dir), DIM)


@query
def level_profile(spark, sf_dir):
    """T4: nodes per level and number of levels."""
    return LV.level_profile(_levels(spark, sf_dir), DIM)


@query
def level_slots(spark, sf_dir):
    """T4: slot of each node within its level."""
    return LV.level_slots(_levels(spark, sf_dir), DIM)


# -- sinks (X1-X3), rows-only checks -------------------------------------------------

from strata.sinks import export as SK  # noqa: E402


@query
def dim_report_json(spark, sf_dir):
    """The dimension report as JSON, in parts of at most ``SK.PART_EDGES`` edges of a dimension."""
    e = FX.dim_edges(spark, sf_dir)
    report = P.validity(e, DIM)
    return SK.dimension_report_json(report, e, e.select(*DIM, "tenant_id"))


@query
def element_edges_csv(spark, sf_dir):
    """Element edges of the calendars as CSV lines."""
    return SK.csv_lines(hier_elements(spark, sf_dir))


@query
def element_payloads(spark, sf_dir):
    """One JSON payload per path edge and element edge of the calendars and
    of the valid generic hierarchies."""
    generic = cut(_valid_generic(spark, sf_dir))
    calendars = SK.hierarchy_payloads(hier_elements(spark, sf_dir), FX.calendar_hierarchies(spark))
    return calendars.unionByName(SK.hierarchy_payloads(X.expand(generic, seed=SEED).edges, generic))


# -- configuration with bad rows and several tenants (S1-S3, P2, P4, P5, D4) ------------

from strata.sources import quarantine as Q  # noqa: E402


def _intake(spark, sf_dir):
    return Q.intake_dimension_lines(FX.rough_config_lines(spark, sf_dir))


@query
def config_problems(spark, sf_dir):
    """How many lines of each dimension have which problem."""
    return _intake(spark, sf_dir).problems()


@query
def config_quarantine(spark, sf_dir):
    """The lines that cannot be placed, with their text."""
    return _intake(spark, sf_dir).quarantine.select("line", F.array_join("problems", ",").alias("problems"))


@query
def config_tenants(spark, sf_dir):
    """Edges of every tenant of lines with none to three of them."""
    return C.config_edges(_intake(spark, sf_dir).config)


@query
def config_report(spark, sf_dir):
    """D4 with its account: tenants, levels, edges, verdict, and the counts of bad rows and cells per dimension."""
    intake = _intake(spark, sf_dir)
    edges, levels, counts = C.config_edges(intake.config), C.declared_levels(intake.config), intake.counts()
    v = P.validity(edges, DIM, groups=counts.select(*DIM))
    tenants = C.explode_tenants(intake.config).select(*DIM, "tenant_id").distinct().groupBy(*DIM).agg(
        _join_sorted(F.collect_list("tenant_id")).alias("tenant_ids"))
    n_levels = levels.groupBy(*DIM).agg(F.count(F.lit(1)).alias("n_levels"))
    full = counts.join(v, DIM).join(tenants, DIM, "left").join(n_levels, DIM, "left")
    return full.fillna({"tenant_ids": "", "n_levels": 0})


@query
def hier_tenant_lists(spark, sf_dir):
    """S3: hierarchies of one to three tenants, the list as ``array<int>``."""
    h = C.parse_hierarchy_lines(FX.shared_hier_lines(spark, sf_dir), tenant_as_array=True)
    return h.select(F.array_join("tenant_id", ",").alias("tenant_ids"), F.size("tenant_id").cast("bigint").alias("n_tenants"),
                    "dimension_id", "hierarchy_id", "from_level", "hierarchy_name", "to_level")


@query
def hier_tenants(spark, sf_dir):
    """The path edges of every tenant of a shared hierarchy."""
    return C.explode_tenants(C.parse_hierarchy_lines(FX.shared_hier_lines(spark, sf_dir), tenant_as_array=True))


@query
def one_dimension(spark, sf_dir):
    """P5: one dimension of one tenant, out of orders, geography and parts."""
    return C.dimension_of_tenant(FX.level_edges(spark, sf_dir), dimension_id="part", tenant_id=0)


# -- E1 at every level, A2 without one row, what the sinks wrote --------------------------

from strata.session import Store  # noqa: E402


@query
def timed_tops(spark, sf_dir):
    """Seeded tops at year, week, period, quarter and plain levels."""
    return X.top_elements(FX.top_paths(spark, sf_dir), seed=SEED)


@query
def hier_path_segments(spark, sf_dir):
    """A2 without a bound: the text of a path in segments of at most ``H.SEGMENT_EDGES`` edges."""
    return H.path_segments(H.path_edges(_hier(spark, sf_dir)))


def _rewritten(df, fmt: str, stale: str, tenant, **options: str):
    """Write ``df`` by tenant with column ``stale`` spoiled for one tenant, replace that tenant's
    folder by its right rows, and read the dataset back (kept below the checkpoint folder)."""
    path = f"{Store(df.sparkSession).path}/written"
    own = F.col("tenant_id") == tenant
    SK.write_table(df.withColumn(stale, F.when(own, F.lit("stale")).otherwise(F.col(stale))), path, fmt,
                   partition_by=["tenant_id"], **options)
    SK.replace_partitions(df.filter(own), path, fmt, **options)
    return df.sparkSession.read.schema(df.schema).options(**options).format(fmt).load(path).select(*df.columns)


@query
def dataset_read_back(spark, sf_dir):
    """Dimension edges as Parquet by tenant, one tenant rewritten."""
    return _rewritten(FX.dim_edges(spark, sf_dir), "parquet", "child", 1)


def _all_element_edges(spark, sf_dir):
    generic = _valid_generic(spark, sf_dir)
    return generic, hier_elements(spark, sf_dir).unionByName(X.expand(generic, seed=SEED).edges)


@query
def csv_read_back(spark, sf_dir):
    """Element edges of calendars and generic hierarchies as CSV with a header line, one tenant rewritten."""
    return _rewritten(_all_element_edges(spark, sf_dir)[1], "csv", "child_element_label", "0", header="true")


@query
def payloads_read_back(spark, sf_dir):
    """The payload of every path and element edge as JSON, one tenant rewritten, parsed again."""
    generic, elements = _all_element_edges(spark, sf_dir)
    payloads = SK.hierarchy_payloads(elements, generic.unionByName(FX.calendar_hierarchies(spark)))
    fields = [*X.ELEMENT_EDGE_COLUMNS, H.FROM, H.TO]
    back = _rewritten(payloads, "json", "payload", "0")
    p = back.select("kind", F.from_json("payload", ", ".join(f"{f} string" for f in fields)).alias("p")).select("kind", "p.*")
    return p.withColumns({"child_level": F.coalesce("child_level", H.FROM), "parent_level": F.coalesce("parent_level", H.TO)}).drop(H.FROM, H.TO)
