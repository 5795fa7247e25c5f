"""Semi and anti joins that split hot keys of the streamed side.

A semi join deals its rows out by the join key, so the rows of one key meet in
one task; AQE splits a partition only between plain shuffles, and a distinct
probe side is none. Here the keys that hold many rows are **measured** first,
in one aggregation that is partial before its shuffle. A hot key of c rows gets
``ceil(c / rows)`` salts: its rows carry a salt from a hash of ``spread``
(columns that differ within the key), and the probe's row of that key is
repeated once per salt. Light keys have the one salt 0, so a single equi-join
on (key, salt) serves both, and no task gets more than about ``rows`` rows of a
key.

The table of hot keys has at most n / rows rows: at ``rows = max(min_rows,
n / SPLIT)`` that is ``SPLIT`` at most, whatever the data, which is what its
broadcast rests on. With no more than ``min_rows`` rows no key can be hot and
nothing is measured.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"
#: A key is hot above this many rows at least, and above n / SPLIT of n rows.
MIN_ROWS = 500_000
SPLIT = 4096


@dataclass
class Salting:
    """Hot keys of a frame: ``keys, _salts`` (None: there can be none)."""
    keys: list[str]
    hot: DataFrame | None

    @property
    def on(self) -> list[str]:
        return [*self.keys, SALT]

    def _with_salts(self, df: DataFrame) -> DataFrame:
        if self.hot is None:
            return df.withColumn("_salts", F.lit(1))
        return df.join(F.broadcast(self.hot), self.keys, "left").withColumn(  # at most SPLIT rows
            "_salts", F.coalesce("_salts", F.lit(1)))

    def streamed(self, df: DataFrame, spread: list[str]) -> DataFrame:
        """``df`` with the salt of each row."""
        if self.hot is None:
            return df.withColumn(SALT, F.lit(0))
        return self._with_salts(df).withColumn(SALT, F.pmod(F.xxhash64(*spread), "_salts").cast("int")).drop("_salts")

    def probe(self, df: DataFrame) -> DataFrame:
        """``df``, one row a key, with every salt of its key."""
        if self.hot is None:
            return df.withColumn(SALT, F.lit(0))
        return self._with_salts(df).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")


def measure(df: DataFrame, keys: list[str], n: int | None = None, min_rows: int = MIN_ROWS) -> Salting:
    """The hot keys of ``df``; ``n`` is its number of rows where that is known."""
    n = df.count() if n is None else n
    rows = max(min_rows, n // SPLIT)
    if n <= rows:
        return Salting(keys, None)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    found = counted.select(*keys, F.ceil(F.col("_n") / F.lit(rows)).cast("int").alias("_salts")).collect()
    if not found:
        return Salting(keys, None)
    schema = df.select(*keys).schema.add("_salts", T.IntegerType())
    return Salting(keys, df.sparkSession.createDataFrame(found, schema))


def _joined(df: DataFrame, probe: DataFrame, keys: list[str], spread: list[str], how: str, min_rows: int, n: int | None) -> DataFrame:
    salting = measure(df, keys, n, min_rows)
    if salting.hot is None:
        return df.join(probe, keys, how)
    return salting.streamed(df, spread).join(salting.probe(probe), salting.on, how).drop(SALT)


def semi_join(df: DataFrame, probe: DataFrame, keys: list[str], spread: list[str], min_rows: int = MIN_ROWS,
              n: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in ``probe`` (one row a key)."""
    return _joined(df, probe, keys, spread, "left_semi", min_rows, n)


def anti_join(df: DataFrame, probe: DataFrame, keys: list[str], spread: list[str], min_rows: int = MIN_ROWS,
              n: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``probe`` (one row a key)."""
    return _joined(df, probe, keys, spread, "left_anti", min_rows, n)


def left_join(df: DataFrame, probe: DataFrame, keys: list[str], spread: list[str], min_rows: int = MIN_ROWS,
              n: int | None = None) -> DataFrame:
    """Every row of ``df`` with the columns of its key's row in ``probe``."""
    return _joined(df, probe, keys, spread, "left", min_rows, n)
