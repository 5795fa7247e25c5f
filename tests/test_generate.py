"""Calendar rules, expansion counts (FIXTURES.md §2) and reproducibility."""

from pyspark.sql import functions as F

from strata.functions import calendar as CAL
from strata.operators import expand as X
from strata.sources.fixtures import CALENDAR_CHAINS

HIER_SCHEMA = ("tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string, "
               "from_level string, to_level string")


def _chain(spark, hid, chain):
    rows = [("0", "time", hid, hid, c, p) for c, p in zip(chain, chain[1:])]
    return spark.createDataFrame(rows, HIER_SCHEMA)


def _roots(spark, hid, level, value):
    return spark.createDataFrame([("0", "time", hid, hid, level, value, value)],
                                 "tenant_id string, dimension_id string, hierarchy_id string, "
                                 "hierarchy_name string, level string, element_id string, element_label string")


def test_calendar_counts_per_root(spark):
    cases = {"ad_calendar": ("Ad Year", "1999", 429), "fiscal_calendar": ("Fiscal Year", "1999", 481),
             "fiscal_quarter": ("Fiscal Quarter", "199902", 132)}
    for hid, (level, root, expected) in cases.items():
        exp = X.expand(_chain(spark, hid, CALENDAR_CHAINS[hid]), roots=_roots(spark, hid, level, root))
        assert exp.edges.count() == expected, hid
        assert exp.rejected.count() == 0


def test_rules_on_labels(spark):
    row = spark.range(1).select(
        CAL.year_periods(F.lit("2001")).alias("p"), CAL.period_weeks(F.lit("200102")).alias("w"),
        CAL.week_days(F.lit("2001-01-29")).alias("d"), CAL.period_week_indices(F.lit("200113")).alias("i"),
        CAL.index_week(F.lit("20011304")).alias("iw"), CAL.quarter_periods(F.lit("200104")).alias("q"),
        CAL.week_days(F.lit("Day")).alias("bad"), CAL.index_week(F.lit("20010105")).alias("bad_idx"),
    ).first()
    assert row.p[0] == "200101" and row.p[-1] == "200113" and len(row.p) == 13
    assert row.w == ["2001-01-29", "2001-02-05", "2001-02-12", "2001-02-19"]
    assert row.d[-1] == "2001-02-04"
    assert row.i == ["20011301", "20011302", "20011303", "20011304"]
    assert row.iw == ["2001-12-24"]
    assert row.q == ["200110", "200111", "200112", "200113"]
    assert row.bad is None and row.bad_idx is None


def test_unparsable_parent_is_rejected_not_fatal(spark):
    # "Ad Week" below a generic level gets equal nodes named "Ad Week", which
    # merge into one element; the Day rule cannot parse that label.
    exp = X.expand(_chain(spark, "h", ["Day", "Ad Week", "Store"]))
    weeks = exp.edges.filter(F.col("child_level") == "Ad Week").collect()
    assert [(r.parent_element_id, r.child_element_id) for r in weeks] == [("Store_id", "Ad Week")]
    rejected = exp.rejected.collect()
    assert [(r.parent_element_id, r.child_level) for r in rejected] == [("Ad Week", "Day")]


def test_same_seed_same_output(spark):
    pe = _chain(spark, "g", ["L3", "L2", "L1", "L0"])
    a = sorted(X.expand(pe, seed=7).edges.collect())
    b = sorted(X.expand(pe.repartition(3), seed=7).edges.collect())
    assert a == b
    c = sorted(X.expand(pe, seed=8).edges.collect())
    assert len(a) > 0 and (a != c or len(a) == len(c))


def test_generic_layering(spark):
    pe = _chain(spark, "g", ["C", "B", "A"])
    edges = X.expand(pe, fanout=3).edges
    assert edges.count() == 3 + 9  # A_id -> 3 B; each B -> the same 3 C
    assert edges.filter(F.col("child_level") == "C").select("child_element_id").distinct().count() == 3
