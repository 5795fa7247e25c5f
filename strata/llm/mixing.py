"""Mixing sources to target weights by hash-threshold histograms (operator 4).

Sizes are counted once per document. A source's target is its weight's share of all words, at most ``max_times`` its
size; what is over is shared among the others by weight. A source gives every document ``floor(target / size)`` times
and the rest of its target by hash: words are summed by source and hash bucket, the bucket in which the rest runs out
is the only one that is refined by the next digits, and a document is taken once more if its hash lies under the
threshold. Nothing is sorted but the histogram of one source (at most 4,096 rows).

Defined results: a null text has size 0 and is taken 0 times; null sources form one source, the last; equal rows share
their hash and are taken alike; the documents at the very threshold (one hash value) are taken iff this brings the
source nearer to its target. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import document_rows
from strata.session import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash in a histogram level, and levels.
DIGITS, LEVELS = 3, 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mixing_hash(doc_id: Column, text: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))), 1, DIGITS * LEVELS)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_times: int = 3) -> DataFrame:
    """``source, source_size, target, times, rest``: one row per source.

    Sources rise in ``max_times * size / weight``; those under the water line stop at their cap, the line is what is
    left over the weights that are left. ``sized`` has ``source, size``; the windows run over one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    s = by_source.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_times).cast("decimal(38,0)"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("left", F.sum("source_size").over(everything).cast("decimal(38,0)") - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("decimal(38,0)"))
          .withColumn("left_weight", F.sum("weight").over(after))
          .withColumn("capped", F.col("cap") * F.col("left_weight") < F.col("left") * F.col("weight")))
    s = s.withColumn("line", F.max(F.when(~F.col("capped"), F.struct(F.col("left_weight"), F.col("left")))).over(everything))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("line.left") * F.col("weight")).cast("double") / F.col("line.left_weight").cast("double"))
    s = s.withColumn("target", target)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    s = s.withColumn("times", times)
    return s.select("source", "source_size", "target", "times", (F.col("target") - F.col("times") * F.col("source_size")).alias("rest"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, source_size, target, times, prefix, extra``: documents of hash under ``prefix`` are taken once more;
    those of hash ``prefix`` itself if ``extra``. Each level reads only the rows of the boundary buckets."""
    rows = sized.select(F.col("source").alias("s"), "hash", "size")
    state = targets.withColumns({"prefix": F.lit(""), "below": F.lit(0).cast("bigint"), "inside": F.lit(0).cast("bigint")})
    for level in range(1, LEVELS + 1):
        width = DIGITS * level
        held = state.select(F.col("source").alias("hs"), "prefix", "below", "rest")
        inside = rows.join(held, F.col("s").eqNullSafe(F.col("hs")) & F.col("hash").startswith(F.col("prefix")))
        histogram = inside.groupBy("s", F.substring("hash", 1, width).alias("bucket"), "below", "rest").agg(F.sum("size").alias("words"))
        upto = F.col("below") + F.sum("words").over(Window.partitionBy("s").orderBy("bucket"))
        over = histogram.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
        edge = over.groupBy("s").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"), "words")).alias("e"))
        state = cut(state.drop("prefix", "below", "inside").join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "times", "rest", F.coalesce("e.bucket", F.lit("")).alias("prefix"),
            F.coalesce("e.below", F.lit(0)).alias("below"), F.coalesce("e.words", F.lit(0)).alias("inside")))
    return state.select("source", "source_size", "target", "times", "prefix",
                        (F.lit(2) * (F.col("rest") - F.col("below")) >= F.col("inside")).alias("extra"))


def sizes(docs: DataFrame) -> DataFrame:
    """The documents' columns with ``size`` and ``hash`` in place of the text."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing_hash(F.col("doc_id"), F.col("text")).alias("hash"))


def limits(sized: DataFrame, weights: tuple[int, ...], max_times: int) -> DataFrame:
    """One row per source: its target, and what is taken of it."""
    found = thresholds(sized, cut(source_targets(sized, weights, max_times)))
    return found.withColumnRenamed("source", "limit_source").withColumnRenamed("times", "whole")


def taken(sized: DataFrame, limit: DataFrame) -> DataFrame:
    """``sized`` with ``source_size, target, times, taken``; one row per source is joined to every document."""
    more = (F.col("hash") < F.col("prefix")) | ((F.col("hash") == F.col("prefix")) & F.col("extra"))
    return (sized.join(limit, F.col("source").eqNullSafe(F.col("limit_source")))
            .withColumn("times", F.col("whole") + F.when(more, 1).otherwise(0))
            .withColumn("taken", F.col("times") * F.col("size"))
            .drop("limit_source", "whole", "prefix", "extra", "hash"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_times: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken`` of every row: ``times`` copies, ``taken`` words."""
    sized = cut(sizes(docs))
    return taken(sized, limits(sized, weights, max_times))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_times: int = 3) -> DataFrame:
    """The documents that the mix takes, with ``size, source_size, target, times, taken``. Texts don't move: they are
    read once for the sizes and once for the result."""
    limit = limits(cut(sizes(docs)), weights, max_times)
    rows = document_rows(docs).withColumns({"size": word_count(F.col("text")), "hash": mixing_hash(F.col("doc_id"), F.col("text"))})
    return taken(rows, limit).filter("times > 0")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15) AS h
           FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size,
             [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS w
      FROM d GROUP BY source),
f AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rw
      FROM s WINDOW o AS (ORDER BY source_size * (10 // w), source NULLS LAST)),
g AS (SELECT *, 3 * source_size * rw < rem * w AS capped FROM f),
l AS (SELECT arg_max(rem, rw) AS rem, max(rw) AS rw FROM g WHERE NOT capped),
t AS (SELECT source, source_size::BIGINT AS source_size,
             CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE (l.rem * w)::DOUBLE / l.rw::DOUBLE END AS target
      FROM g, l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
v AS (SELECT d.*, u.source_size, u.target, u.whole, u.target - u.whole * u.source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS inside
      FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR (upto - inside <= rest AND 2 * (rest - (upto - inside)) >= inside) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v
"""
