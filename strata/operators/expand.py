"""Element generation (E1, E11-E17): valid hierarchies -> parent/child element edges.

The reference expands each hierarchy depth first inside a UDF, one task per
hierarchy, and merges equal nodes in a driver-side map. Here the expansion is
breadth first over **all hierarchies at once**: the frontier of elements is
joined with the inverted path (parent level -> child level), each joined row
makes its children with column expressions (the calendar rules or a seeded
fan-out), and the distinct children form the next frontier. Rounds = length
of the longest path. Equal elements merge through ``distinct``; the fan-out
draw is keyed by the element, so an element always gets the same children.

The inverted path has one row per path edge. Its join is planned by AQE from
the measured size: a broadcast, or a shuffle join in which a level holding
most of the frontier is split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import rules as R
from strata.functions.draws import draw
from strata.operators import edges as E
from strata.operators.hierarchy import FROM, HIER_KEYS, TO
from strata.operators.sequence import row_number_by
from strata.session import Store

# The element edge table, columns in this order.
ELEMENT_EDGE_COLUMNS = [
    "tenant_id", "hierarchy_id", "hierarchy_name", "dimension_id", "child_level", "parent_level",
    "parent_element_id", "child_element_id", "child_element_label", "parent_element_label",
]
REJECT_COLUMNS = ["parent_level", "child_level", "parent_element_id", "parent_element_label", "reason"]
DEFAULT_ANCHOR = "2023-01-01"


@dataclass
class Expansion:
    edges: DataFrame     # ELEMENT_EDGE_COLUMNS
    rejected: DataFrame  # parents whose label no rule could parse, with the child level
    rounds: int


def top_elements(valid_pe: DataFrame, seed: int = 42, anchor: str = DEFAULT_ANCHOR,
                 keys: list[str] = HIER_KEYS) -> DataFrame:
    """One top element per hierarchy, at the level that is no source."""
    ends = E.path_start_end(valid_pe, keys).filter(F.col("role") == "end")
    eid, label = R.top_element(F.col("level"), F.to_date(F.lit(anchor)), seed, *keys)
    return ends.select(*keys, "level", eid.alias("element_id"), label.alias("element_label"))


def fanout_column(fanout: int | None, seed, keys: list[str]) -> Column:
    if fanout is not None:
        return F.lit(int(fanout))
    lo, hi = R.DEFAULT_FANOUT
    return F.lit(lo) + draw(seed, *keys, "level", "element_id") % F.lit(hi - lo + 1)


def expand(valid_pe: DataFrame, roots: DataFrame | None = None, seed: int = 42,
           fanout: int | None = None, anchor: str = DEFAULT_ANCHOR,
           keys: list[str] = HIER_KEYS, max_rounds: int | None = None, path_unique_ids: bool = False) -> Expansion:
    """E13/E14. ``roots``: ``keys, level, element_id, element_label``; drawn by E1 if omitted.

    Each round joins the frontier once, writes its edges and rejects to their
    tables and keeps only the new frontier. ``path_unique_ids`` puts the
    parent's id before each child's (``parent/child``), so that an element has
    one parent and the result is a tree; labels, which the calendar rules read,
    stay as they are."""
    store, result = Store(valid_pe.sparkSession), Store(valid_pe.sparkSession)
    inv = store.put(valid_pe.select(*keys, F.col(TO).alias("level"), F.col(FROM).alias("child_level")).distinct())
    if roots is None:
        roots = top_elements(valid_pe, seed, anchor, keys)
    frontier = store.put(roots.select(*keys, "level", "element_id", "element_label").distinct())
    rounds = 0
    while not frontier.isEmpty():
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"expansion did not end after {max_rounds} rounds")
        j = frontier.join(inv, [*keys, "level"])
        vals = R.child_values(F.col("child_level"), F.col("level"), F.col("element_label"),
                              fanout_column(fanout, seed, keys))
        # Value-named children that repeat are one element: dedupe inside the
        # array, so that (parent, child) rows are distinct without a shuffle.
        vals = F.when(F.col("child_level").rlike(R.VALUE_NAMED_LEVEL), F.array_distinct(vals)).otherwise(vals)
        j = j.withColumn("_vals", vals)
        # A parent without children it can have stays as one row with a null value: the reject.
        kids = j.select(
            *keys, F.col("level").alias("parent_level"), "child_level",
            F.col("element_id").alias("parent_element_id"),
            F.col("element_label").alias("parent_element_label"),
            F.col("_vals").isNull().alias("_rejected"), F.posexplode_outer("_vals").alias("_pos", "_value"))
        child = R.child_id(F.col("child_level"), F.col("_value"), F.col("_pos"))
        if path_unique_ids:
            child = F.concat("parent_element_id", F.lit("/"), child)
        kids = kids.filter(F.col("_rejected") | F.col("_value").isNotNull()).select(
            *keys, "parent_level", "child_level", "parent_element_id", "parent_element_label", "_rejected",
            child.alias("child_element_id"),
            R.child_label(F.col("child_level"), F.col("_value"), F.col("_pos")).alias("child_element_label"))
        made = result.add(kids, "rounds")
        frontier = store.put(made.filter(~F.col("_rejected")).select(
            *keys, F.col("child_level").alias("level"), F.col("child_element_id").alias("element_id"),
            F.col("child_element_label").alias("element_label")).distinct())
        rounds += 1
    store.clear()
    if rounds == 0:
        nothing = [F.lit(None).cast("string").alias(c) for c in ELEMENT_EDGE_COLUMNS]
        edges = valid_pe.limit(0).select(*nothing)
        return Expansion(edges=edges, rejected=edges.select(*keys, *REJECT_COLUMNS[:-1], F.lit(None).cast("string").alias("reason")), rounds=0)
    every = result.all("rounds")
    rejected = every.filter("_rejected").withColumn("reason", F.lit("UNPARSABLE_PARENT_LABEL")).select(*keys, *REJECT_COLUMNS)
    return Expansion(edges=every.filter(~F.col("_rejected")).select(*ELEMENT_EDGE_COLUMNS), rejected=rejected, rounds=rounds)


# -- v1: each path edge on its own (E15-E17) ---------------------------------

# v1 placeholder parents for time levels without a rule.
V1_PLACEHOLDER = {
    "Ad Period": "Ad period from case matching_id1",
    "Fiscal Period": "Fiscal Period from case matching_id1",
    "Fiscal Week": "Fiscal Week from case matching_id1",
    "Fiscal Year": "Fiscal Year from case matching_id1",
}
V1_PLACEHOLDER_LABEL = "label from case matching_id1"
V1_COLUMNS = ["tenant_id", "dimension_id", "child_level", "parent_level", "parent_element_id",
              "child_element_id", "child_element_label", "parent_element_label"]


def sequential_years(groups: DataFrame, by: list[str], order: list[str], seed: int = 42,
                     out: str = "year") -> DataFrame:
    """Years handed out one after another within each ``by`` group, from a
    seeded start in 1998-2022 (the v1 counter, made reproducible)."""
    from strata.functions.calendar import FIRST_YEAR, N_YEARS
    numbered = row_number_by(groups, by, order, out="_rn")
    start = F.lit(FIRST_YEAR) + draw(seed, *by, F.lit("start")) % F.lit(N_YEARS)
    return numbered.withColumn(out, (start + F.col("_rn")).cast("string")).drop("_rn")


def edgewise_elements(path_edges: DataFrame, seed: int = 42, anchor: str = DEFAULT_ANCHOR,
                      keys: list[str] = HIER_KEYS) -> DataFrame:
    """One parent and its children per path edge (v1 generator).

    Edges whose parent no rule can parse have no children; ``edgewise`` lists them."""
    return edgewise(path_edges, seed, anchor, keys).edges


def edgewise(path_edges: DataFrame, seed: int = 42, anchor: str = DEFAULT_ANCHOR,
             keys: list[str] = HIER_KEYS) -> Expansion:
    """E15/E16 with the rejected path edges, as ``expand`` gives them."""
    pe = path_edges.select(*keys, F.col(FROM).alias("child_level"), F.col(TO).alias("parent_level"))
    is_time = F.col("dimension_id") == "time"
    ad_year = is_time & (F.col("parent_level") == "Ad Year")
    years = sequential_years(pe.filter(ad_year), ["tenant_id"], [*keys[1:], "child_level"], seed,
                             out="_year")
    pe = pe.filter(~ad_year).withColumn("_year", F.lit(None).cast("string")).unionByName(years)
    from strata.functions.calendar import random_week_start
    week = random_week_start(F.to_date(F.lit(anchor)), seed, *keys, "child_level")
    pid = F.when(is_time & (F.col("parent_level") == "Ad Week"), week).when(ad_year, F.col("_year"))
    plabel = pid
    for level, text in V1_PLACEHOLDER.items():
        hit = is_time & (F.col("parent_level") == level)
        pid = pid.when(hit, F.lit(text))
        plabel = plabel.when(hit, F.lit(V1_PLACEHOLDER_LABEL))
    pid = pid.otherwise(F.concat("parent_level", F.lit("_id1")))
    plabel = plabel.otherwise(F.concat("parent_level", F.lit("_label_id1")))
    from strata.functions.calendar import week_days, year_periods
    p = pe.withColumn("parent_element_id", pid).withColumn("parent_element_label", plabel)
    kids = (F.when((F.col("child_level") == "Day") & (F.col("parent_level") == "Ad Week"),
                   week_days(F.col("parent_element_id")))
            .when((F.col("child_level") == "Ad Period") & (F.col("parent_level") == "Ad Year"),
                  year_periods(F.col("parent_element_id")))
            .otherwise(F.transform(F.sequence(F.lit(1), F.lit(2)),
                                   lambda i: F.concat(F.col("child_level"), F.lit("_id"), i.cast("string")))))
    out = p.select("*", F.explode_outer(kids).alias("child_element_id"), kids.isNull().alias("_rejected"))
    edges = out.filter(~F.col("_rejected")).withColumn("child_element_label", F.col("child_element_id")).select(*V1_COLUMNS)
    rejected = out.filter("_rejected").select(
        *keys, "parent_level", "child_level", "parent_element_id", "parent_element_label",
        F.lit("UNPARSABLE_PARENT_LABEL").alias("reason"))
    return Expansion(edges=edges, rejected=rejected, rounds=1)
