"""Bad configuration rows: every line is placed, counted or kept in quarantine."""

from strata.sources import config as C
from strata.sources import quarantine as Q

LINES = [
    "1, 2|time|Day|Ad Week, Fiscal Week",
    "1,x|time|Ad Week|Ad Year",
    "|time|Fiscal Week|Ad Year",
    "3|time|Ad Year|",
    "3|time|Ad Day|, Ad Year,",
    "3||Day|Ad Week",
    "3|time| |Ad Week",
    "3| |  |",
    "3|time|Day",
    "3|time|Day|Ad Week|more",
    "3|time|Day|Ad Week|more",
    "",
    "   ",
    None,
]


def intake(spark, lines):
    return Q.intake_dimension_lines(spark.createDataFrame([(x, 1) for x in lines], "line string, problems int"))


def test_every_problem_has_its_line(spark):
    got = [(r["line"], r["problems"], r["quarantined"]) for r in intake(spark, LINES).rows.collect()]
    want = {
        LINES[0]: [], LINES[1]: ["BAD_TENANT"], LINES[2]: ["NO_TENANT"], LINES[3]: ["NO_PARENT"], LINES[4]: ["EMPTY_PARENT"],
        LINES[5]: ["NO_DIMENSION"], LINES[6]: ["NO_LEVEL"], LINES[7]: ["NO_DIMENSION", "NO_LEVEL", "NO_PARENT"],
        LINES[8]: ["CORRUPT_LINE"], LINES[9]: ["CORRUPT_LINE"], "": ["CORRUPT_LINE"], "   ": ["CORRUPT_LINE"], None: ["CORRUPT_LINE"],
    }
    assert len(got) == len(LINES)
    for line, problems, quarantined in got:
        assert problems == want[line] and quarantined == bool(set(problems) & set(Q.FATAL))


def test_rows_that_can_be_placed_stay(spark):
    made = intake(spark, LINES)
    rows = {(r["dimension_level"], tuple(r["tenant_id"] or ()), tuple(r["parents_level"] or ())) for r in made.config.collect()}
    assert rows == {("Day", (1, 2), ("Ad Week", "Fiscal Week")), ("Ad Week", (1,), ("Ad Year",)), ("Fiscal Week", (), ("Ad Year",)),
                    ("Ad Year", (3,), ()), ("Ad Day", (3,), ("Ad Year",))}
    assert (None, "Fiscal Week") in {(r["tenant_id"], r["child"]) for r in C.config_edges(made.config).collect()}
    assert made.quarantine.count() == 9
    (c,) = [r.asDict() for r in made.counts().collect()]
    assert c == {"dimension_id": "time", "n_rows": 9, "n_quarantined": 4, "n_no_tenant": 1, "n_bad_tenant": 1, "n_no_parent": 1, "n_empty_parent": 1}
    assert {(r["dimension_id"], r["problem"]): r["n_rows"] for r in made.problems().collect()}[("time", "CORRUPT_LINE")] == 3


def test_no_lines(spark):
    made = intake(spark, LINES).rows.limit(0).select("line")
    empty = Q.intake_dimension_lines(made)
    assert empty.config.isEmpty() and empty.quarantine.isEmpty() and empty.problems().isEmpty() and empty.counts().isEmpty()
