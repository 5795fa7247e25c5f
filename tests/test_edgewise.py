"""A path edge whose parent no rule can parse is rejected with a reason, not lost."""

from strata.operators import expand as X

PATHS = "tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string, from_level string, to_level string"


def test_unparsable_parents_are_rejected(spark):
    rows = [("1", "shop", "h", "H", "Day", "Ad Week"), ("1", "shop", "h", "H", "Ad Week", "Ad Year"), ("1", "shop", "h", "H", "Ad Period", "Ad Year"),
            ("1", "time", "t", "T", "Day", "Ad Week"), ("1", "time", "t", "T", "Ad Period", "Ad Year")]
    out = X.edgewise(spark.createDataFrame(rows, PATHS))
    rejected = {(r.dimension_id, r.child_level, r.parent_level, r.parent_element_id, r.reason) for r in out.rejected.collect()}
    assert rejected == {("shop", "Day", "Ad Week", "Ad Week_id1", "UNPARSABLE_PARENT_LABEL")}
    found = {(r.dimension_id, r.child_level, r.parent_level) for r in out.edges.collect()}
    assert found | {r[:3] for r in rejected} == {(r[1], r[4], r[5]) for r in rows} and len(found) == 4
