"""Seeded, reproducible draws as column expressions.

The reference draws with an unseeded ``Random`` inside UDFs, so its output
changes between passes over the same data. Here a draw is a pure function of
a seed and stable keys: the first 32 bits of ``md5(seed|key|...)``. It is the
same on every executor and on every recomputation after a lost task, and
DuckDB computes the same number with ``('0x' || substr(md5(...), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int | str, *keys: Column | str) -> Column:
    """A non-negative bigint in [0, 2^32) from the seed and the key columns."""
    parts = [F.lit(str(seed))] + [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def draw_below(n: int, seed: int | str, *keys: Column | str) -> Column:
    """A draw in [0, n)."""
    return draw(seed, *keys) % F.lit(n)
