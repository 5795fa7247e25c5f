"""Filter interaction audit: contingency tensor contractions (operator 11).

Five filters are applied in every order. What a step keeps, removes or repeats depends only on which of the five
conditions a document fails, so the documents of a part are counted once into a table of 2 x 2 x 2 x 2 x 2 cells (axis i:
0 passes, 1 fails filter i), and every number of every step is a contraction of that tensor: each axis is selected as
pass, fail or all, and ``einsum`` sums the selected cells for all steps at once.

The counting is Spark's: conditions A to D are column expressions over whole texts. E needs the smallest id of each
text; rows are first counted by (id, digest of the text, part), and the few-byte rows that hold a text's smallest id are
found by an equi-join on (digest, id), so that a text on a third of all rows is no hot key. At most 32 cells a part leave
the shuffle, and parts are contracted independently.

Defined results: a null text is an empty one; null and empty ``lang`` are one part, ''; a null doc_id is never smaller
and has no smaller id, so it passes E; rows of one id do not repeat each other; a document is good (toxic) if any label
row of its id says 1; labels of unknown ids and null labels count nothing. An empty table has no parts and no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Selections along an axis: documents that pass, that fail, or all.
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
#: White space between words.
SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ("docs", "good", "toxic")
SCHEMA = ("part string, filter_order string, step int, filter string, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def conditions(text: Column) -> list[Column]:
    """Whether a text fails A, B, C and D."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.size(words)
    return [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n,
            100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text), text.rlike("[#$%&*|]")]


def document_cells(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, part, a, b, c, d, n``: equal rows counted, texts left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    flags = [c.cast("int").alias(k) for k, c in zip("abcd", conditions(F.col("text")))]
    rows = rows.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "part", *flags)
    return rows.groupBy("doc_id", "digest", "part", "a", "b", "c", "d").agg(F.count(F.lit(1)).alias("n"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, a, b, c, d, e, docs, good, toxic``: the non-zero cells of every part's tensor."""
    from strata.session import cut

    known = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("is_good"),
                  F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("is_toxic")))
    flat = cut(document_cells(docs))  # read for the smallest ids and for the rows
    first = flat.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("e", F.lit(0))
    named = flat.filter(F.col("doc_id").isNotNull())
    named = named.join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    named = named.select("part", "a", "b", "c", "d", F.coalesce("e", F.lit(1)).alias("e"), "n",
                         F.coalesce("is_good", F.lit(0)).alias("is_good"), F.coalesce("is_toxic", F.lit(0)).alias("is_toxic"))
    nameless = flat.filter(F.col("doc_id").isNull()).select(
        "part", "a", "b", "c", "d", F.lit(0).alias("e"), "n", F.lit(0).alias("is_good"), F.lit(0).alias("is_toxic"))
    return named.unionByName(nameless).groupBy("part", "a", "b", "c", "d", "e").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("is_good")).alias("good"), F.sum(F.col("n") * F.col("is_toxic")).alias("toxic"))


def selections() -> dict[str, np.ndarray]:
    """Per kind of count, for each (order, step) and axis, which of pass and fail is summed: 600 x 5 x 2."""
    out = {k: np.empty((len(ORDERS) * 5, 5, 2), np.int64) for k in ("kept", "removed", "failed", "only")}
    for i, order in enumerate(ORDERS):
        for s, name in enumerate(order):
            at, before, own = i * 5 + s, {FILTERS.index(x) for x in order[:s]}, FILTERS.index(name)
            for axis in range(5):
                out["kept"][at, axis] = PASS if axis in before or axis == own else ALL
                out["removed"][at, axis] = FAIL if axis == own else PASS if axis in before else ALL
                out["failed"][at, axis] = FAIL if axis == own else ALL
                out["only"][at, axis] = FAIL if axis == own else PASS
    return out


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums of a measures x 2 x 2 x 2 x 2 x 2 tensor under every row of ``chosen``: measures x rows, exact."""
    return np.einsum("mabcde,na,nb,nc,nd,ne->mn", tensor, *(chosen[:, axis] for axis in range(5)), optimize=True)


def steps(part: str, tensor: np.ndarray) -> pd.DataFrame:
    """The 600 rows of a part."""
    pick = selections()
    removed = contract(tensor, pick["removed"])
    names = [f for order in ORDERS for f in order]
    total = {f: int(removed[0][[n == f for n in names]].sum()) for f in FILTERS}
    return pd.DataFrame({
        "part": part, "filter_order": [o for o in ORDERS for _ in o], "step": [s for _ in ORDERS for s in range(1, 6)], "filter": names,
        "kept": contract(tensor[:1], pick["kept"])[0], "removed": removed[0],
        "redundant": contract(tensor[:1], pick["failed"])[0] - removed[0], "unique_fails": contract(tensor[:1], pick["only"])[0],
        "good_lost": removed[1], "toxic_lost": removed[2], "shapley": [total[n] for n in names]})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every filter order, per part."""
    def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tensor = np.zeros((len(MEASURES), 2, 2, 2, 2, 2), np.int64)
        tensor[(slice(None), *(frame[k].to_numpy() for k in "abcde"))] = frame[list(MEASURES)].to_numpy().T
        return steps(key[0], tensor)

    return cells(docs, labels).groupBy("part").applyInPandas(work, SCHEMA)


_TEXT = "coalesce(text, '')"
_WORDS = rf"regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+')"
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, {_TEXT} AS text, {_WORDS} AS w FROM documents
), smallest AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         CAST(len(w) < 200 AS INTEGER) AS a, CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER) AS b,
         CAST(100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) AS INTEGER) AS c,
         CAST(regexp_matches(d.text, '[#$%&*|]') AS INTEGER) AS d, CAST(coalesce(s.least < d.doc_id, false) AS INTEGER) AS e
  FROM d JOIN smallest s ON s.text = d.text LEFT JOIN l ON l.doc_id = d.doc_id
), cell AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), x AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT p.i AS p, q.i AS q, r.i AS r, s.i AS s, t.i AS t,
         substr('ABCDE', p.i, 1) || substr('ABCDE', q.i, 1) || substr('ABCDE', r.i, 1) || substr('ABCDE', s.i, 1) || substr('ABCDE', t.i, 1) AS filter_order
  FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5
), step AS (
  SELECT filter_order, [p, q, r, s, t] AS seq, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders
), hit AS (
  SELECT c.part, st.filter_order, st.step, substr(st.filter_order, st.step, 1) AS filter, c.n, c.good, c.toxic,
         c.fails[st.seq[st.step]] AS own, list_sum(c.fails) AS n_fails,
         coalesce(list_sum(list_transform(st.seq[1:st.step - 1], lambda k: c.fails[k])), 0) AS before
  FROM cell c, step st
), r AS (
  SELECT part, filter_order, step, filter,
         CAST(sum(CASE WHEN own = 0 AND before = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN own = 1 AND before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN own = 1 AND before > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN own = 1 AND n_fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN own = 1 AND before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN own = 1 AND before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM hit GROUP BY part, filter_order, step, filter
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r
"""
