"""Hand-made cases (FIXTURES.md §2): dimension validity and hierarchy reasons."""

from strata.operators import hierarchy as H
from strata.operators import peel as P
from strata.sources import config as C

DIM_SCHEMA = "tenant_id int, dimension_id string, child string, parent string"
HIER_SCHEMA = ("tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string, "
               "from_level string, to_level string")

DIM_CASES = {
    "chain": [("a", "b"), ("b", "c")],
    "diamond": [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")],
    "self_loop": [("a", "a")],
    "two_cycle": [("a", "b"), ("b", "a")],
    "cycle_tail": [("x", "a"), ("a", "b"), ("b", "a")],
    "duplicate_parent": [("a", "b"), ("a", "b")],
}
EXPECTED = {"chain": None, "diamond": None, "self_loop": "CYCLE", "two_cycle": "CYCLE",
            "cycle_tail": "CYCLE", "duplicate_parent": None}


def _dims(spark, cases):
    rows = [(1, name, c, p) for name, edges in cases.items() for c, p in edges]
    return spark.createDataFrame(rows, DIM_SCHEMA)


def test_dimension_cases_in_one_job(spark):
    edges = _dims(spark, DIM_CASES)
    groups = spark.createDataFrame([(n,) for n in [*DIM_CASES, "empty"]], "dimension_id string")
    got = {r.dimension_id: (r.valid, r.reason) for r in
           P.validity(edges.distinct(), ["dimension_id"], groups=groups).collect()}
    for name, reason in EXPECTED.items():
        assert got[name] == (reason is None, reason), name
    assert got["empty"] == (False, "EMPTY")


def test_empty_is_valid_in_v1(spark):
    edges = _dims(spark, {"chain": DIM_CASES["chain"]})
    groups = spark.createDataFrame([("chain",), ("empty",)], "dimension_id string")
    got = {r.dimension_id: r.valid for r in
           P.validity(edges, ["dimension_id"], groups=groups, empty_is_valid=True).collect()}
    assert got == {"chain": True, "empty": True}


def test_residue_is_what_leads_to_a_cycle(spark):
    edges = _dims(spark, {"g": [("x", "a"), ("a", "b"), ("b", "a"), ("y", "z"), ("b", "c")]})
    res = P.cycle_residue(edges, ["dimension_id"])
    assert sorted((r.child, r.parent) for r in res.collect()) == [("a", "b"), ("b", "a"), ("x", "a")]


def test_empty_parent_list_and_null_cell(spark):
    lines = spark.createDataFrame([("1|d|a|",), ("1|d|b|a",), ("1,2|e|c| x , y ",)], "line string")
    cfg = C.parse_dimension_lines(lines)
    edges = C.config_edges(cfg)
    assert sorted((r.tenant_id, r.dimension_id, r.child, r.parent) for r in edges.collect()) == [
        (1, "d", "b", "a"), (1, "e", "c", "x"), (1, "e", "c", "y"), (2, "e", "c", "x"), (2, "e", "c", "y")]
    levels = C.declared_levels(cfg)
    v = P.validity(edges, ["dimension_id"], groups=levels)
    assert {r.dimension_id: r.valid for r in v.collect()} == {"d": True, "e": True}


def test_bad_tenant_does_not_fail_the_load(spark):
    lines = spark.createDataFrame([("x|d|a|b",)], "line string")
    row = C.parse_dimension_lines(lines).first()
    assert row.tenant_id == [None] and row.parents_level == ["b"]


PATH_CASES = {
    "good": [("Day", "Ad Week"), ("Ad Week", "Ad Year")],
    "missing": [("Day", "Ad Week"), ("Ad Week", "Fiscal Year")],
    "two_pieces": [("Day", "Ad Week"), ("Ad Year", "Top")],
    "two_starts": [("Day", "Ad Year"), ("Ad Week", "Ad Year")],
    "two_parents": [("Day", "Ad Week"), ("Day", "Ad Year")],
    "cycle_only": [("Day", "Ad Week"), ("Ad Week", "Day")],
}
PATH_EXPECTED = {"good": None, "missing": "EDGE_NOT_IN_DIMENSION", "two_pieces": "NOT_A_CHAIN",
                 "two_starts": "NOT_A_CHAIN", "two_parents": "MULTI_PARENT", "cycle_only": "CYCLE",
                 "unknown": "UNKNOWN_DIMENSION", "bad_dim": "INVALID_DIMENSION"}


def test_hierarchy_reasons(spark):
    dim = [("time", "Day", "Ad Week"), ("time", "Ad Week", "Ad Year"), ("time", "Day", "Ad Year"),
           ("time", "Ad Year", "Top"), ("loop", "a", "b"), ("loop", "b", "a")]
    dims = spark.createDataFrame([(1, *d) for d in dim], DIM_SCHEMA)
    rows = [("1", "time", name, name, c, p) for name, edges in PATH_CASES.items() for c, p in edges]
    rows.append(("1", "nowhere", "unknown", "unknown", "a", "b"))
    rows.append(("1", "loop", "bad_dim", "bad_dim", "a", "b"))
    hier = spark.createDataFrame(rows, HIER_SCHEMA)
    got = {r.hierarchy_id: r.reason for r in H.validate(hier, dims).collect()}
    assert got == PATH_EXPECTED


def test_file_form_accepts_unvalidated_dimensions(spark):
    dims = spark.createDataFrame([(1, "loop", "a", "b"), (1, "loop", "b", "a")], DIM_SCHEMA)
    hier = spark.createDataFrame([("1", "loop", "h", "h", "a", "b")], HIER_SCHEMA)
    strict = H.validate(hier, dims).first()
    loose = H.validate(hier, dims, require_valid_dimension=False).first()
    assert (strict.reason, loose.reason) == ("INVALID_DIMENSION", None)


def test_inverted_path_order(spark):
    hier = spark.createDataFrame([("1", "t", "h", "h", "Day", "Ad Week"), ("1", "t", "h", "h", "Ad Week", "Ad Period"),
                                  ("1", "t", "h", "h", "Ad Period", "Ad Year")], HIER_SCHEMA)
    inv = sorted((r.step, r.parent_level, r.child_level) for r in H.invert_path(hier).collect())
    assert inv == [(1, "Ad Year", "Ad Period"), (2, "Ad Period", "Ad Week"), (3, "Ad Week", "Day")]


def test_tenants_of_one_dimension_count_its_edges_once(spark):
    rows = [(t, "d", c, p) for t in (1, 2) for c, p in (("a", "b"), ("b", "a"), ("c", "d"))]
    e = spark.createDataFrame(rows, "tenant_id int, dimension_id string, child string, parent string")
    from strata.operators import edges, peel
    got = peel.validity(e, ["dimension_id"]).first()
    assert (got.n_edges, got.n_residue, got.reason) == (3, 2, "CYCLE")
    assert edges.profile(e, ["dimension_id"]).first().n_edges == 3


def test_rows_without_tenant_keep_their_edges(spark):
    from strata.sources import config
    lines = spark.createDataFrame([("|d|a|b",), ("1,2|d|b|c",)], "line string")
    got = config.config_edges(config.parse_dimension_lines(lines)).select("child", "parent").distinct().count()
    assert got == 2


def test_malformed_hierarchy_body_is_rejected(spark):
    from strata.operators.hierarchy import json_single_parent
    bodies = spark.createDataFrame([("1", "not json"), ("2", "{}"), ("3", '{"a":["b"]}'), ("4", '{"a":["b","c"]}')], "k string, body string")
    got = {r.k: r.single_parent for r in json_single_parent(bodies, ["k"]).collect()}
    assert got == {"1": False, "2": True, "3": True, "4": False}
