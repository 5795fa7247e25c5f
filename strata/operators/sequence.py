"""Row numbers within groups without putting a group in one task.

``Window.partitionBy(group).orderBy(...)`` sends a whole group to one task; a
group holding a third of the rows would make that task the job. Instead the
rows are range-partitioned on (group, order) - a hot group spans many
partitions - numbered by position inside each sorted partition, and shifted
by the counts of the same group in earlier partitions. The offsets come from
a table with one row per (partition, group) piece; each group has at most as
many pieces as there are partitions, so the window over it is bounded.

The ranged frame is checkpointed once so that the counts and the numbering
use the same materialisation (range bounds come from a sample).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut


def row_number_by(df: DataFrame, keys: list[str], order: list[str], out: str = "row_number",
                  partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1, 2, ... within each group of ``keys`` in ``order``.

    The order columns should be unique within a group for a reproducible
    result; key columns must not be null."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = cut(ranged)
    pieces = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (ranged.join(pieces.select("_pid", *keys, "_first", "_offset"), ["_pid", *keys])
            .withColumn(out, (F.col("_pos") - F.col("_first") + F.col("_offset") + 1).cast("bigint"))
            .drop("_pid", "_pos", "_first", "_offset"))
