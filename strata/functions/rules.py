"""Which rule makes the children of an element (E11), how children are named
(E12) and what the top element of a hierarchy is (E1).

All three are ``when`` chains over level names: the rule table has nine
entries, so a join would only add a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions import calendar as cal

# Fixed values: (child level, parent level) -> rule, as in the reference.
RULES = [
    ("Ad Period", "Ad Year", cal.year_periods),
    ("Ad Week", "Ad Period", cal.period_weeks),
    ("Day", "Ad Week", cal.week_days),
    ("Fiscal Period", "Fiscal Year", cal.year_periods),
    ("Fiscal Week Index", "Fiscal Period", cal.period_week_indices),
    ("Fiscal Week", "Fiscal Week Index", cal.index_week),
    ("Fiscal Period", "Fiscal Quarter", cal.quarter_periods),
    ("Fiscal Week", "Fiscal Period", cal.period_weeks),
    ("Day", "Fiscal Week", cal.week_days),
]

# Levels whose elements use their value as id and label.
YEAR_LEVEL = "^(Fiscal|Ad) Year$"
WEEK_LEVEL = "^(Fiscal|Ad) Week$"
PERIOD_LEVEL = "^(Fiscal|Ad) Period$"
VALUE_NAMED_LEVEL = "^((Fiscal|Ad) (Year|Week|Period)|Fiscal Week Index|Day)$"
QUARTER_LEVEL = "Fiscal Quarter"
DEFAULT_FANOUT = (3, 4)  # generic levels get 3 or 4 children


def has_rule(child_level: Column, parent_level: Column) -> Column:
    cond = F.lit(False)
    for c, p, _ in RULES:
        cond = cond | ((child_level == c) & (parent_level == p))
    return cond


def child_values(child_level: Column, parent_level: Column, parent_label: Column,
                 fanout: Column) -> Column:
    """The values of the children; ``fanout`` copies of the level name
    when no calendar rule applies. Null when the parent label does not parse."""
    expr = None
    for c, p, rule in RULES:
        cond = (child_level == c) & (parent_level == p)
        expr = F.when(cond, rule(parent_label)) if expr is None else expr.when(cond, rule(parent_label))
    return expr.otherwise(F.array_repeat(child_level, fanout.cast("int")))


def child_id(child_level: Column, value: Column, pos: Column) -> Column:
    """Value-named levels use the value; others ``value_id{i}`` (i from 1)."""
    return F.when(child_level.rlike(VALUE_NAMED_LEVEL), value).otherwise(
        F.concat(value, F.lit("_id"), (pos + 1).cast("string")))


def child_label(child_level: Column, value: Column, pos: Column) -> Column:
    return F.when(child_level.rlike(VALUE_NAMED_LEVEL), value).otherwise(
        F.concat(value, F.lit("_label"), (pos + 1).cast("string")))


def top_element(level: Column, anchor: Column, seed, *keys) -> tuple[Column, Column]:
    """(id, label) of the top element of a hierarchy whose top level is ``level``."""
    value = (F.when(level.rlike(YEAR_LEVEL), cal.random_year(seed, *keys))
             .when(level.rlike(WEEK_LEVEL), cal.random_week_start(anchor, seed, *keys))
             .when(level.rlike(PERIOD_LEVEL), cal.random_period(seed, *keys))
             .when(level == QUARTER_LEVEL, cal.random_quarter(seed, *keys)))
    timed = level.rlike(YEAR_LEVEL) | level.rlike(WEEK_LEVEL) | level.rlike(PERIOD_LEVEL) | (level == QUARTER_LEVEL)
    eid = F.when(timed, value).otherwise(F.concat(level, F.lit("_id")))
    label = F.when(timed, value).otherwise(F.concat(level, F.lit("_label")))
    return eid, label
