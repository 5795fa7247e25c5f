"""Calendar element rules (E2-E10) as column expressions over element labels.

Every rule maps the *label* of a parent element to the array of its
children's values, entirely with built-in functions (``sequence``,
``transform``, date arithmetic), so it runs inside whole-stage codegen.
Labels that do not parse give ``null`` (Spark 4 runs in ANSI mode, so every
parse is a ``try_`` form); the generator turns those into rejected rows
instead of failing the job.

Fixed values: dates are ``yyyy-MM-dd`` strings, periods ``yyyypp`` (13 per
year, 4 weeks each, starting on January 1st), week indices ``yyyypp0i``
(i = 1..4), quarters ``yyyy0q`` (q = 1..4, four periods each, neighbours
sharing one), random years 1998-2022, week starts on Wednesday.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.draws import draw_below

DATE_FMT = "yyyy-MM-dd"
FIRST_YEAR, N_YEARS = 1998, 25
PERIODS_PER_YEAR, WEEKS_PER_PERIOD = 13, 4
DEFAULT_WEEKDAY = "WEDNESDAY"


def _int(c: Column) -> Column:
    return c.try_cast("int")


def year_start(year: Column) -> Column:
    """January 1st of an integer year, null when the year is out of range."""
    return F.when((year >= 1) & (year <= 9999),
                  F.try_to_date(F.format_string("%04d-01-01", year), DATE_FMT))


def fmt(d: Column) -> Column:
    return F.date_format(d, DATE_FMT)


# -- draws (E2-E4) ----------------------------------------------------------

def random_year(seed, *keys) -> Column:
    """A year in 1998-2022 as text."""
    return (F.lit(FIRST_YEAR) + draw_below(N_YEARS, seed, *keys, F.lit("year"))).cast("string")


def random_week_start(anchor: Column, seed, *keys, weekday: str = DEFAULT_WEEKDAY) -> Column:
    """Anchor minus a random number of years, then weeks, then months (each 0-24),
    then the first ``weekday`` one to seven days after."""
    a = draw_below(25, seed, *keys, F.lit("years")).cast("int")
    b = draw_below(25, seed, *keys, F.lit("weeks")).cast("int")
    c = draw_below(25, seed, *keys, F.lit("months")).cast("int")
    d = F.add_months(F.date_sub(F.add_months(anchor, -12 * a), 7 * b), -c)
    return fmt(F.next_day(d, weekday[:3].title()))


def random_quarter(seed, *keys) -> Column:
    """``yyyy0q``."""
    q = (F.lit(1) + draw_below(4, seed, *keys, F.lit("quarter"))).cast("string")
    return F.concat(random_year(seed, *keys), F.lit("0"), q)


def random_period(seed, *keys) -> Column:
    """A random period of a random year (top element of a period level)."""
    p = F.lit(1) + draw_below(PERIODS_PER_YEAR, seed, *keys, F.lit("period"))
    return F.concat(random_year(seed, *keys), F.lpad(p.cast("string"), 2, "0"))


# -- rules (E5-E10) ---------------------------------------------------------

def year_periods(label: Column) -> Column:
    """E5: ``yyyy`` -> ``yyyy01`` ... ``yyyy13``."""
    return F.transform(F.sequence(F.lit(1), F.lit(PERIODS_PER_YEAR)),
                       lambda p: F.concat(label, F.lpad(p.cast("string"), 2, "0")))


def _period_first_day(year: Column, period: Column) -> Column:
    return F.date_add(year_start(year), 28 * (period - 1))


def period_weeks(label: Column) -> Column:
    """``yyyypp`` -> the 4 week starts of the period (Jan 1 + 28(p-1) + 7i)."""
    y, p = _int(F.substring(label, 1, 4)), _int(F.substring(label, 5, 2))
    first = F.when(p >= 1, _period_first_day(y, p))
    return F.when(first.isNotNull(), F.transform(
        F.sequence(F.lit(0), F.lit(WEEKS_PER_PERIOD - 1)), lambda i: fmt(F.date_add(first, 7 * i))))


def week_days(label: Column) -> Column:
    """A week start ``yyyy-MM-dd`` -> its 7 days."""
    d = F.try_to_date(label, DATE_FMT)
    return F.when(d.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(6)),
                                             lambda i: fmt(F.date_add(d, i))))


def period_week_indices(label: Column) -> Column:
    """``yyyypp`` -> ``yyyypp01`` ... ``yyyypp04``."""
    y = _int(F.substring(label, 1, 4))
    p = F.substring(label, 5, 2)
    return F.when(y.isNotNull() & (F.length(label) >= 6), F.transform(
        F.sequence(F.lit(1), F.lit(WEEKS_PER_PERIOD)),
        lambda i: F.concat(y.cast("string"), p, F.lit("0"), i.cast("string"))))


def index_week(label: Column) -> Column:
    """``yyyypp0i`` -> the single week start of that index."""
    y, p, i = (_int(F.substring(label, 1, 4)), _int(F.substring(label, 5, 2)),
               _int(F.substring(label, 7, 2)))
    d = F.when((p >= 1) & (i >= 1) & (i <= WEEKS_PER_PERIOD),
               F.date_add(_period_first_day(y, p), 7 * (i - 1)))
    return F.when(d.isNotNull(), F.array(fmt(d)))


def quarter_periods(label: Column) -> Column:
    """``yyyy0q`` -> periods 3(q-1)+1 ... 3(q-1)+4 of the year (clamped to 1-13)."""
    y = F.substring(label, 1, 4)
    q = _int(F.substring(label, 5, 2))
    lo = F.greatest(F.lit(1), 3 * (q - 1) + 1)
    hi = F.least(F.lit(PERIODS_PER_YEAR), 3 * (q - 1) + 4)
    return F.when(q.isNotNull() & (F.length(label) >= 6),
                  F.when(lo <= hi, F.transform(F.sequence(lo, hi),
                                               lambda p: F.concat(y, F.lpad(p.cast("string"), 2, "0"))))
                  .otherwise(F.array().cast("array<string>")))
