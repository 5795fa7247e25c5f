"""Hierarchy checks (H1-H6): a hierarchy is one unbroken chain of allowed edges.

A hierarchy is a group of path edges ``from_level -> to_level`` keyed by
``HIER_KEYS``. It is looked up in the graph of its ``dimension_id`` whatever
the tenant, as the reference does. Instead of walking each path inside a UDF
with a driver-side map of all dimensions, the walk is restated as a rule on
distinct edges (the chain rule): out-degree <= 1, in-degree <= 1, exactly one
start, no cycle, every edge in the dimension. The degrees come from one
shuffle keyed by (hierarchy, level); membership from one equi-join keyed by
(dimension, child, parent); cycles from pointer jumping, which applies because
only paths with out-degree <= 1 reach that test and which needs log2 of the
path length in rounds. A bad hierarchy yields a row with a reason instead of an
exception.

Hierarchies and dimensions have few edges as a rule. Those of at most ``SMALL``
are judged by the same rules within one array of edges (the peel too): each is
gathered once by its key and the two are joined once by dimension, where the
general way takes a shuffle for every test and several for every layer of the
peel and the jumps. What is larger is counted first, never gathered in one
task, and goes the general way.

Reasons, first match wins (fixed values): EMPTY, UNKNOWN_DIMENSION,
INVALID_DIMENSION, MULTI_PARENT, CYCLE, NOT_A_CHAIN, EDGE_NOT_IN_DIMENSION.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import edges as E
from strata.operators import jump as J
from strata.operators import peel as P
from strata.operators import salt as S
from strata.operators.sequence import row_number_by
from strata.session import Scope, Store

#: Groups of at most so many edges are judged as one array; larger ones by joins.
SMALL = 32
#: Rows of one dimension that may be gathered by group at all.
BOUND = 10_000
LARGE = "LARGE"

HIER_KEYS = ["tenant_id", "dimension_id", "hierarchy_id", "hierarchy_name"]
FROM, TO = "from_level", "to_level"


def path_edges(hier: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """Distinct, non-null path edges of every hierarchy."""
    return E.edge_set(hier, keys, FROM, TO)


def hierarchy_groups(hier: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    return hier.select(*keys).distinct()


def path_stats(pe: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """Per hierarchy: n_edges, max_out, max_in, n_starts (levels that are no target)."""
    d = E.node_degrees(pe, keys, FROM, TO)
    return d.groupBy(*keys).agg(
        F.sum("out_degree").cast("bigint").alias("n_edges"),
        F.max("out_degree").alias("max_out"),
        F.max("in_degree").alias("max_in"),
        F.count(F.when(F.col("in_degree") == 0, 1)).alias("n_starts"),
    )


def edge_membership(pe: DataFrame, dim_edges: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """Each path edge with ``in_dimension`` (equi-join on dimension, child, parent)."""
    d = (dim_edges.select("dimension_id", F.col("child").alias(FROM), F.col("parent").alias(TO))
         .distinct().withColumn("in_dimension", F.lit(True)))
    return S.left_join(pe, d, ["dimension_id", FROM, TO], keys).select(
        *keys, FROM, TO, F.coalesce("in_dimension", F.lit(False)).alias("in_dimension"))


def path_edges_exist(hier: DataFrame, dim_edges: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """H1: per hierarchy, whether every path edge is an edge of its dimension."""
    m = edge_membership(path_edges(hier, keys), dim_edges, keys)
    return m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.count(F.when(~F.col("in_dimension"), 1)).alias("n_missing"),
        F.bool_and("in_dimension").alias("all_exist"))


def single_parent(hier: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """H3: per hierarchy, whether each level has at most one parent."""
    s = path_stats(path_edges(hier, keys), keys)
    return s.select(*keys, "max_out", (F.col("max_out") <= 1).alias("single_parent"))


def json_single_parent(bodies: DataFrame, keys: list[str] = HIER_KEYS, body: str = "body") -> DataFrame:
    """H3 over ad-hoc JSON hierarchies ``{"from": ["to", ...]}``, answered as the route does."""
    from strata.sources.config import parse_dimension_json
    pe = parse_dimension_json(bodies, body, tuple(keys)).withColumnsRenamed({"child": FROM, "parent": TO})
    out = pe.groupBy(*keys, FROM).agg(F.count(F.lit(1)).alias("n_to"))
    ok = out.groupBy(*keys).agg((F.max("n_to") <= 1).alias("single_parent"))
    # A body that is no map of lists is no hierarchy; an empty map is one.
    parsed = F.from_json(F.col(body), "map<string,array<string>>").isNotNull()
    ok = bodies.select(*keys, parsed.alias("_parsed")).join(ok, keys, "left").select(
        *keys, (F.col("_parsed") & F.coalesce("single_parent", F.lit(True))).alias("single_parent"))
    return ok.withColumn("answer", F.concat(F.lit("Got the hierarchy and it is "),
                                            F.when(F.col("single_parent"), "true").otherwise("false")))


def dimension_status(dim_edges: DataFrame) -> DataFrame:
    """``dimension_id, dimension_valid`` for every dimension that has edges."""
    v = P.validity(dim_edges, ["dimension_id"])
    return v.select("dimension_id", F.col("valid").alias("dimension_valid"))


def _validate_large(hier: DataFrame, dim_edges: DataFrame, keys: list[str] = HIER_KEYS,
             require_valid_dimension: bool = True) -> DataFrame:
    """``validate`` for groups of any size: rows joined by (group, level), no group in one task."""
    scope = Scope()
    pe = scope.persist(path_edges(hier, keys))
    # Only dimensions some hierarchy names are peeled and joined.
    named = pe.select("dimension_id").distinct()
    dim_edges = scope.persist(dim_edges.select("dimension_id", "child", "parent")
                              .join(named, "dimension_id", "left_semi"))
    # From the hierarchies themselves: one whose levels are all null is EMPTY.
    groups = hierarchy_groups(hier, keys)
    stats = path_stats(pe, keys)
    missing = edge_membership(pe, dim_edges, keys).groupBy(*keys).agg(
        F.count(F.when(~F.col("in_dimension"), 1)).alias("n_missing"))
    dims = dimension_status(dim_edges)
    base = (groups.join(stats, keys, "left").join(missing, keys, "left")
            .join(dims, ["dimension_id"], "left"))
    base = scope.persist(base)
    # Only hierarchies that reach the cycle test are jumped; they have
    # out-degree <= 1, which pointer jumping requires.
    undecided = base.filter(
        (F.col("n_edges") > 0) & F.col("dimension_valid").isNotNull()
        & (F.col("dimension_valid") | F.lit(not require_valid_dimension))
        & (F.col("max_out") <= 1)).select(*keys)
    jumped = J.jump(pe.join(undecided, keys, "left_semi"), keys, FROM, TO)
    cyclic = jumped.cyclic_groups(keys).withColumn("cyclic", F.lit(True))
    full = base.join(cyclic, keys, "left")
    reason = (
        F.when(F.coalesce(F.col("n_edges"), F.lit(0)) == 0, "EMPTY")
        .when(F.col("dimension_valid").isNull(), "UNKNOWN_DIMENSION")
        .when(~F.col("dimension_valid") & F.lit(require_valid_dimension), "INVALID_DIMENSION")
        .when(F.col("max_out") > 1, "MULTI_PARENT")
        .when(F.col("cyclic").isNotNull(), "CYCLE")
        .when((F.col("max_in") > 1) | (F.col("n_starts") != 1), "NOT_A_CHAIN")
        .when(F.col("n_missing") > 0, "EDGE_NOT_IN_DIMENSION")
    )
    return scope.finish(full.select(*keys, F.coalesce("n_edges", F.lit(0)).cast("bigint").alias("n_edges"),
                                    reason.alias("reason")).withColumn("valid", F.col("reason").isNull()))


def _left(edges: Column) -> Column:
    """The peel within one array of distinct edges (``c``, ``p``): what stays is on a cycle or leads up to one."""
    rounds = F.sequence(F.lit(1), F.size(F.array_distinct(F.transform(edges, lambda e: e["c"]))))
    return F.when(F.size(edges) == 0, edges).otherwise(F.aggregate(
        rounds, edges, lambda left, _: F.filter(left, lambda e: F.exists(left, lambda f: f["c"] == e["p"]))))


def _arrays(edges: DataFrame, keys: list[str], child: str, parent: str) -> DataFrame:
    """``keys, edges``: the distinct, non-null edges of each group (at most ``BOUND``) as one array."""
    whole = F.col(child).isNotNull() & F.col(parent).isNotNull()
    return edges.groupBy(*keys).agg(F.collect_set(F.when(whole, F.struct(F.col(child).alias("c"), F.col(parent).alias("p")))).alias("edges"))


def _judged(hier: DataFrame, dim_edges: DataFrame, keys: list[str], require_valid_dimension: bool,
            store: Store) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """``keys, edges, reason`` of the hierarchies that are small and so is their dimension; path edges and
    dimension edges of the others, if there are any.

    A dimension with more than ``BOUND`` rows, its own or its hierarchies', is large and sorted out by a count before
    any group is gathered; so are, from the arrays, those of more than ``SMALL`` edges."""
    hier = store.put(hier.select(*keys, FROM, TO))
    dims = store.put(dim_edges.select("dimension_id", "child", "parent").filter("child IS NOT NULL AND parent IS NOT NULL"))
    counts = [x.groupBy("dimension_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BOUND).select("dimension_id") for x in (hier, dims)]
    hot = store.put(counts[0].unionByName(counts[1]).distinct())
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    # a hierarchy with a null key joins nothing: it has no edges
    lost = hier.filter(~known).select(*keys).distinct()
    keyed = hier.filter(known).join(hot, "dimension_id", "left_anti")
    status = _arrays(dims.join(hot, "dimension_id", "left_anti"), ["dimension_id"], "child", "parent").select(
        "dimension_id", F.col("edges").alias("own"), F.when(F.size("edges") <= SMALL, F.size(_left(F.col("edges"))) == 0).alias("dimension_valid"))
    both = _arrays(keyed, keys, FROM, TO).join(status, "dimension_id", "left")
    e = F.col("edges")
    n, sources, targets = F.size(e), F.transform(e, lambda x: x["c"]), F.transform(e, lambda x: x["p"])
    large = (n > SMALL) | (F.coalesce(F.size("own"), F.lit(0)) > SMALL)
    reason = (
        F.when(large, LARGE)
        .when(n == 0, "EMPTY")
        .when(F.col("own").isNull(), "UNKNOWN_DIMENSION")
        .when(~F.col("dimension_valid") & F.lit(require_valid_dimension), "INVALID_DIMENSION")
        .when(F.size(F.array_distinct(sources)) < n, "MULTI_PARENT")
        .when(F.size(_left(e)) > 0, "CYCLE")
        .when((F.size(F.array_distinct(targets)) < n) | (F.size(F.array_except(sources, targets)) != 1), "NOT_A_CHAIN")
        .when(F.exists(e, lambda x: ~F.array_contains("own", x)), "EDGE_NOT_IN_DIMENSION"))
    judged = store.put(both.select(*keys, "edges", reason.alias("reason")))
    small = judged.filter(~F.col("reason").eqNullSafe(LARGE)).unionByName(
        lost.select(*keys, F.lit(None).cast(judged.schema["edges"].dataType).alias("edges"), F.lit("EMPTY").alias("reason")))
    big = judged.filter(F.col("reason") == LARGE)
    if hot.isEmpty() and big.isEmpty():
        return small, None
    rest = hier.filter(known).join(hot, "dimension_id", "left_semi").select(*keys, FROM, TO).unionByName(
        big.select(*keys, F.explode("edges").alias("e")).select(*keys, F.col("e.c").alias(FROM), F.col("e.p").alias(TO)))
    return small, (rest, dims)


def validate(hier: DataFrame, dim_edges: DataFrame, keys: list[str] = HIER_KEYS,
             require_valid_dimension: bool = True) -> DataFrame:
    """H2 with reasons: ``keys, n_edges, reason, valid`` for every hierarchy.

    ``require_valid_dimension=False`` checks against unvalidated dimensions,
    as the reference's file form does."""
    store, result = Store(hier.sparkSession), Store(hier.sparkSession)
    small, large = _judged(hier, dim_edges, keys, require_valid_dimension, store)
    out = small.select(*keys, F.greatest(F.size("edges"), F.lit(0)).cast("bigint").alias("n_edges"), "reason",
                       F.col("reason").isNull().alias("valid"))
    if large is not None:
        out = out.unionByName(_validate_large(*large, keys, require_valid_dimension))
    out = result.put(out)
    store.clear()
    return out


def valid_hierarchies(hier: DataFrame, dim_edges: DataFrame, keys: list[str] = HIER_KEYS,
                      require_valid_dimension: bool = True) -> DataFrame:
    """H5: the path edges of the hierarchies that pass the checks of ``validate``."""
    store, result = Store(hier.sparkSession), Store(hier.sparkSession)
    small, large = _judged(hier, dim_edges, keys, require_valid_dimension, store)
    out = small.filter(F.col("reason").isNull()).select(*keys, F.explode("edges").alias("e")).select(
        *keys, F.col("e.c").alias(FROM), F.col("e.p").alias(TO))
    if large is not None:
        ok = _validate_large(*large, keys, require_valid_dimension).filter("valid").select(*keys)
        out = out.unionByName(path_edges(large[0], keys).join(ok, keys, "left_semi"))
    out = result.put(out)
    store.clear()
    return out


def invert_path(valid_pe: DataFrame, keys: list[str] = HIER_KEYS) -> DataFrame:
    """H6: parent -> child, root first. ``step`` 1 is the edge at the top.

    ``valid_pe`` holds chains (each level has one parent), so the step of an
    edge is the distance of its child level from the top, by pointer jumping
    (list ranking) in log2(path length) rounds."""
    depth = J.jump(valid_pe, keys, FROM, TO).depths(keys)
    return valid_pe.join(depth.withColumnRenamed("node", FROM), [*keys, FROM]).select(
        *keys, F.col(TO).alias("parent_level"), F.col(FROM).alias("child_level"),
        F.col("depth").cast("int").alias("step"))


#: Edges that the text of one path segment holds at most.
SEGMENT_EDGES = 10_000


def path_segments(pe: DataFrame, keys: list[str] = HIER_KEYS, order: list[str] | None = None,
                  segment_edges: int = SEGMENT_EDGES) -> DataFrame:
    """A2: ``keys, segment, n_edges, path``: a path's entries ``from>to`` as texts of bounded length.

    Entries are sorted (by ``order``, else by their text) and numbered without
    gathering the path; each run of ``segment_edges`` is one text, and the
    segments in order, joined by ``;``, are the whole. Key columns must not be null."""
    entry = pe.withColumn("_entry", F.concat_ws(">", FROM, TO))
    numbered = row_number_by(entry, keys, order or ["_entry"], out="_n")
    at = numbered.withColumn("segment", F.floor((F.col("_n") - 1) / F.lit(segment_edges)).cast("bigint"))
    run = F.array_sort(F.collect_list(F.struct("_n", "_entry")))
    return at.groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("n_edges"),
                                            F.array_join(F.transform(run, lambda e: e["_entry"]), ";").alias("path"))
