"""Connected components of an edge list by minimum labels and pointer jumping, written to the checkpoint folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Tables


def components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``node, label`` of every node of ``edges`` (``a``, ``b``): the smallest node of its component; kept in ``tables``.

    A round takes the smallest label among a node's neighbours (aggregated before the shuffle, so a hub is no hot task)
    and then the label of that label. Rounds follow the logarithm of the longest chain; the loop ends when none changes.
    """
    spark = edges.sparkSession
    own, last = Tables(spark), Tables(spark)
    both = own.put(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = last.put(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        better = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("label").alias("up"))
        this = Tables(spark)
        moved = this.put(better.join(up, "new").select("node", F.col("label").alias("old"), F.least("new", "up").alias("label")))
        free_shuffles(edges)
        last.clear()
        labels, last = moved.select("node", "label"), this
        if moved.filter("label != old").isEmpty():
            out = (tables or Tables(spark)).put(labels)
            last.clear()
            own.clear()
            return out


def merged(labels: DataFrame, links: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``labels`` after further ``links`` (``a``, ``b``). Only the classes that these join are gone through, each as one
    node, so the rounds follow what is new."""
    def named(pairs: DataFrame, end: str) -> DataFrame:
        own = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        return pairs.join(own, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))

    tables = tables or Tables(labels.sparkSession)
    ends = tables.put(named(named(links, "a"), "b"))
    new = components(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).filter("a != b"), tables)
    new = new.select(F.col("node").alias("label"), F.col("label").alias("new"))
    nodes = labels.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("label_a").alias("label")),
                                                             F.struct(F.col("b").alias("node"), F.col("label_b").alias("label")))).alias("x"))
                               .select("x.node", "x.label")).distinct()
    return tables.put(nodes.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label")))


def free_shuffles(df: DataFrame) -> None:
    """Let the driver collect what earlier rounds left, upon which Spark deletes their shuffle files."""
    df.sparkSession.sparkContext._jvm.System.gc()
