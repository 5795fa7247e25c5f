"""Configuration lines with an account of every bad cell.

A line is parsed once. Lines that cannot be placed (wrong number of fields, no
dimension, no level) go to a quarantine table with their text; cells that lose
only themselves (a tenant that is no integer, an empty parent) are counted and
the rest of the row stays. Nothing is dropped without a row or a count, and no
bad line fails the load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut
from strata.sources.config import CSV_OPTIONS, DIM_RAW, parse_dimension_rows, split_ints

#: Problems that put a line into quarantine.
FATAL = ("CORRUPT_LINE", "NO_DIMENSION", "NO_LEVEL")
#: Problems that are counted while the row stays: ``NO_PARENT`` marks a root level.
COUNTED = ("NO_TENANT", "BAD_TENANT", "NO_PARENT", "EMPTY_PARENT")


@dataclass
class Intake:
    rows: DataFrame  # line, parsed columns, problems array<string>, quarantined

    @property
    def config(self) -> DataFrame:
        """S1 rows that can be placed, as ``parse_dimension_lines`` gives them; tenants that are no integer left out."""
        good = F.filter("tenant_id", lambda t: t.isNotNull())
        return self.rows.filter(~F.col("quarantined")).select(
            good.alias("tenant_id"), "dimension_id", "dimension_level", "parents_level")

    @property
    def quarantine(self) -> DataFrame:
        """``line, problems`` of the lines that cannot be placed; equal lines stay apart."""
        return self.rows.filter("quarantined").select("line", "problems")

    def problems(self) -> DataFrame:
        """``dimension_id, problem, n_rows``: every problem of every dimension (null: none readable)."""
        return (self.rows.select("dimension_id", F.explode("problems").alias("problem"))
                .groupBy("dimension_id", "problem").agg(F.count(F.lit(1)).alias("n_rows")))

    def counts(self) -> DataFrame:
        """Per readable dimension: rows, quarantined rows and one count per counted problem."""
        held = [F.count_if(~F.col("quarantined") & F.array_contains("problems", p)).alias(f"n_{p.lower()}") for p in COUNTED]
        return self.rows.filter(F.col("dimension_id").isNotNull()).groupBy("dimension_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if("quarantined").alias("n_quarantined"), *held)


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def intake_dimension_lines(lines: DataFrame, column: str = "line") -> Intake:
    """Parse dimension lines (``tenants|dimension|level|parents``) in one pass and write the result once.

    A null or blank line, or one with missing or extra fields, is ``CORRUPT_LINE``
    and nothing else; it is read only to say which dimension it names."""
    schema = f"{DIM_RAW}, _corrupt string"
    options = {"sep": CSV_OPTIONS["sep"], "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = F.col(column)
    raw = lines.select(text.alias("line"), F.from_csv(text, schema, options).alias("r")).select("line", "r.*")
    blank = F.col("line").isNull() | (F.trim("line") == "")
    tenants = split_ints(F.col("tenant_id"))
    cells = F.split(F.col("parents_level"), ",")
    corrupt = blank | F.col("_corrupt").isNotNull()
    cell_tests = {
        "NO_DIMENSION": _blank("dimension_id"),
        "NO_LEVEL": _blank("dimension_level"),
        "NO_TENANT": _blank("tenant_id"),
        "BAD_TENANT": ~_blank("tenant_id") & F.exists(tenants, lambda t: t.isNull()),
        "NO_PARENT": _blank("parents_level"),
        "EMPTY_PARENT": ~_blank("parents_level") & F.exists(cells, lambda x: F.trim(x) == ""),
    }
    cell_problems = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in cell_tests.items()]))
    marked = raw.withColumn("problems", F.when(corrupt, F.array(F.lit("CORRUPT_LINE"))).otherwise(cell_problems))
    parsed = parse_dimension_rows(marked, ("line", "problems"))
    dimension = F.when(F.col("dimension_id") != "", F.col("dimension_id"))
    return Intake(cut(parsed.withColumn("dimension_id", dimension).withColumn(
        "quarantined", F.arrays_overlap("problems", F.array(*[F.lit(p) for p in FATAL])))))
