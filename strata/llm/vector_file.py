"""Centroid clustering over a VA-file (operator 13).

Every kept vector is stored twice, in full and as an approximation of ``BITS`` bits a dimension: the number of the cell
that its component lies in. Cells follow the distribution of all vectors (exact histograms of every dimension), and their
borders are exact, so for a set of centroids two lookup tables [dimension, cell] -> squared distance give, by 64 lookups
a centroid, an interval that holds the true distance. Where the interval of one centroid lies below all others the vector
is decided. Where intervals overlap, a third table gives the interval of the difference between the distances from the
likeliest centroid and from each other one; it is far narrower for centroids near each other, as what both share cancels.
A full vector is fetched only where that interval holds 0 too, or where its components are needed because it moved.

A round reads the cells alone. It places each vector under the previous and the present centroids; vectors that stay
where they were, decided by their cells both times, end there. Keys of the others are joined with the full vectors (a
table bucketed by key, so that only the keys move), and their differences are added to the sums kept per cluster, exact
integers. No assignment is stored between rounds, so a lost executor costs the tasks it ran. The driver holds the
centroids, their sums and histograms whose size the integer range bounds.

Defined results: vectors of another length, or with a null or non-finite component, are left out; components beyond
+-``LIMIT`` count as that limit, so that squared distances fit a bigint; with fewer kept vectors than centroids each is
one; of equal hashes the smaller vector (component by component) comes first; a null vec_id hashes as empty text; equal
rows count each; a sum that fits no bigint is null; no kept vector gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Tables

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
BITS = 6
LIMIT = 1 << 27
#: Rows worked on at once.
CHUNK = 2048
#: A histogram bin holds integers of equal sign and equal leading 6 bits.
TOP_BIN = 22 * 32 + 63
BINS = 2 * TOP_BIN + 1
BIGINT = 2 ** 63 - 1


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that count."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.filter(e.isNotNull() & (F.size(e) == DIMS) & fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")


def integers(column: pa.Array) -> np.ndarray:
    """The integer components of a column of kept embeddings."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIMS)
    return np.clip(np.floor(256 * x), -LIMIT, LIMIT).astype(np.int64)


# -- cells ----------------------------------------------------------------------

def bins_of(v: np.ndarray) -> np.ndarray:
    m = np.abs(v)
    e = np.maximum(np.frexp(m.astype(np.float64))[1] - 6, 0)
    return np.sign(v) * ((e << 5) + (m >> e))


def bin_range(b: int) -> tuple[int, int]:
    """Least and greatest integer of a bin."""
    k = abs(b)
    low, high = (k, k) if k < 64 else ((32 + k % 32) << (k // 32 - 1), ((33 + k % 32) << (k // 32 - 1)) - 1)
    return (low, high) if b >= 0 else (-high, -low)


def histograms(kept: DataFrame) -> dict[int, list[tuple[int, int]]]:
    """Per dimension the sorted (bin, count) over every kept vector; at most DIMS x BINS rows reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS * BINS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 8 * CHUNK):
                v = integers(batch.column(0).slice(at, 8 * CHUNK))
                total += np.bincount((bins_of(v) + TOP_BIN + np.arange(DIMS) * BINS).ravel(), minlength=DIMS * BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"dim": (at // BINS).astype(np.int32), "bin": (at % BINS - TOP_BIN).astype(np.int32), "n": total[at]})

    counted = kept.select("embedding").mapInArrow(count, "dim int, bin int, n bigint").groupBy("dim", "bin").agg(F.sum("n").alias("n"))
    out: dict[int, list[tuple[int, int]]] = {d: [] for d in range(DIMS)}
    for r in counted.collect():
        out[r["dim"]].append((r["bin"], r["n"]))
    return {d: sorted(b) for d, b in out.items()}


@dataclass
class Cells:
    """Borders of the cells: cell j of a dimension holds the integers low[j] .. high[j]; unused cells hold none."""
    low: np.ndarray   # DIMS x cells
    high: np.ndarray
    bits: int
    greatest: int     # of all components' sizes

    @classmethod
    def fit(cls, counts: dict[int, list[tuple[int, int]]], bits: int = BITS) -> Cells:
        """Cells of about equal numbers of vectors."""
        n = 1 << bits
        low, high = np.full((DIMS, n), 2 * LIMIT), np.full((DIMS, n), 2 * LIMIT)
        for d, pairs in counts.items():
            total, seen, starts = sum(c for _, c in pairs), 0, []
            for b, c in pairs:
                if len(starts) < n and seen * n >= len(starts) * total:
                    starts.append(bin_range(b)[0])
                seen += c
            low[d, :len(starts)] = starts
            high[d, :len(starts)] = [*[s - 1 for s in starts[1:]], bin_range(pairs[-1][0])[1]]
        greatest = max((max(abs(x) for x in (*bin_range(p[0][0]), *bin_range(p[-1][0]))) for p in counts.values() if p), default=0)
        return cls(low, high, bits, greatest)

    def encode(self, v: np.ndarray) -> np.ndarray:
        """The packed cells of vectors, DIMS * bits / 8 bytes each."""
        at = np.stack([np.searchsorted(self.low[d, 1:], v[:, d], side="right") for d in range(DIMS)], axis=1).astype(np.uint8)
        return np.packbits(np.unpackbits(at[:, :, None], axis=2)[:, :, 8 - self.bits:].reshape(len(v), -1), axis=1)

    def decode(self, packed: np.ndarray) -> np.ndarray:
        flags = np.unpackbits(packed, axis=1)[:, :DIMS * self.bits].reshape(len(packed), DIMS, self.bits)
        return flags @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint8)

    def lookup(self, centroids: np.ndarray) -> Lookup:
        """The lookup tables of a set of centroids; each task makes its own from the few borders and centroids."""
        used = self.low < 2 * LIMIT
        low, high = (np.where(used, x, 0)[:, :, None] for x in (self.low, self.high))
        return Lookup(low, high, centroids, np.int32 if DIMS * (2 * self.greatest + 2) ** 2 < 2 ** 31 else np.int64)


# -- placing vectors --------------------------------------------------------------

class Lookup:
    """``bounds``: dimensions x cells x 2k, least and greatest squared distance of a cell from each centroid's component."""

    def __init__(self, low: np.ndarray, high: np.ndarray, centroids: np.ndarray, kind: type):
        self.low, self.high, self.centroids, self.kind = low, high, centroids, kind
        c = centroids.T[:, None, :]
        near = np.maximum(low - c, 0) + np.maximum(c - high, 0)
        far = np.maximum(np.abs(c - low), np.abs(c - high))
        self.bounds = np.ascontiguousarray(np.concatenate([near ** 2, far ** 2], axis=2).astype(kind))
        self.made: dict[int, np.ndarray] = {}

    def ahead(self, own: int) -> np.ndarray:
        """dimensions x cells x k: the most by which the distance from centroid ``own`` exceeds that from each other one.

        (x - own)^2 - (x - c)^2 is linear in x, so its greatest value in a cell is at a border."""
        if own not in self.made:
            c, o = self.centroids.T[:, None, :], self.centroids[own][:, None, None]
            gap = -2 * (o - c)
            self.made[own] = (np.maximum(self.low * gap, self.high * gap) + o * o - c * c).astype(self.kind)
        return self.made[own]


def summed(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Sums over the dimensions of a table's rows for the cells."""
    total = table[0][cells[:, 0]]
    for d in range(1, DIMS):
        total += table[d][cells[:, d]]
    return total


def place(cells: np.ndarray, lookup: Lookup) -> np.ndarray:
    """The nearest centroid (of equally near ones the smaller number) as far as the cells decide it, else -1."""
    total = summed(lookup.bounds, cells)
    k = total.shape[1] // 2
    least, most = total[:, :k], total[:, k:]
    overlap = (least <= most.min(axis=1)[:, None]).sum(axis=1) > 1
    found = (least.astype(np.float64) + most).argmin(axis=1)
    open_ = np.flatnonzero(overlap)
    order = open_[np.argsort(found[open_], kind="stable")]
    for rows in np.split(order, np.flatnonzero(np.diff(found[order])) + 1):
        if len(rows):
            own = found[rows[0]]
            worst = summed(lookup.ahead(int(own)), cells[rows])
            worst[:, :own] += 1  # a smaller number wins a tie
            worst[:, own] = 0
            found[rows] = np.where((worst <= 0).all(axis=1), own, -1)
    return found


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x centroids."""
    top = 2 * max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0))
    if DIMS * int(top) ** 2 < 2 ** 53:  # doubles hold every intermediate integer
        x, c = v.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def settle(found: np.ndarray, v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """``found`` with the undecided placed by their full vectors; ties go to the smaller number."""
    open_ = np.flatnonzero(found < 0)
    if len(open_):
        found = found.copy()
        found[open_] = squared(v[open_], centroids).argmin(axis=1)
    return found


def binary_rows(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """A column of equally long binaries as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def moved_sums(batches: Iterator[pa.RecordBatch], work, k: int) -> Iterator[pa.RecordBatch]:
    """One row a cluster and task: ``cluster, parts``, the sums of the components and the count, of what ``work`` moves."""
    total = np.zeros((k, DIMS + 1), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            work(batch.slice(at, CHUNK), total)
    at = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_pydict({"cluster": at.astype(np.int32), "parts": pa.array(total[at].tolist(), pa.list_(pa.int64()))})


def add(total: np.ndarray, v: np.ndarray, cluster: np.ndarray, sign: int) -> None:
    if len(v):
        order = np.argsort(cluster, kind="stable")
        first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
        rows = cluster[order][first]
        total[rows, :DIMS] += sign * np.add.reduceat(v[order].astype(np.int64), first, axis=0)
        total[rows, DIMS] += sign * np.diff(np.append(first, len(v)))


def gathered(df: DataFrame, k: int) -> np.ndarray:
    """The sums of all tasks, k x (DIMS + 1) Python integers."""
    rows = (df.select("cluster", F.posexplode("parts").alias("dim", "part")).groupBy("cluster", "dim")
            .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    out = np.zeros((k, DIMS + 1), object)
    for r in rows:
        out[r["cluster"], r["dim"]] = int(r["total"])
    return out


# -- the operator -----------------------------------------------------------------

@dataclass
class Clustering:
    vectors: DataFrame      # vec_id, cluster, distance
    centroids: np.ndarray   # k x DIMS
    fetched: list[int]      # full vectors fetched by each round after the first


def first_centroids(kept: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors of the smallest hashes, in ascending order."""
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    limit = float(LIMIT)
    v = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(256 * x.cast("double"), F.lit(limit)), F.lit(-limit))))
    rows = kept.select(F.sha2(name.cast("binary"), 256).alias("hash"), v.alias("v")).orderBy("hash", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, DIMS)


def write_vectors(kept: DataFrame, cells: Cells, tables: Tables, name: str) -> DataFrame:
    """The VA-file: ``key, vec_id, cells, vec``, one bucket file a task, bucketed by key."""
    spark = kept.sparkSession
    kind = np.int16 if cells.greatest < 1 << 15 else np.int32

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                v = integers(part.column(1))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column(0), "cells": pa.array([r.tobytes() for r in cells.encode(v)], pa.binary()),
                    "vec": pa.array([r.tobytes() for r in v.astype(kind)], pa.binary())})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = kept.mapInArrow(encode, "vec_id bigint, cells binary, vec binary").withColumn("key", F.monotonically_increasing_id())
    (coded.repartition(n, "key").write.format("parquet").bucketBy(n, "key").sortBy("key")
     .option("path", f"{tables.path}/{name}").saveAsTable(name))
    return spark.table(name)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, bits: int = BITS) -> Clustering:
    """``rounds`` rounds of exact integer k-means over the VA-file of all kept vectors."""
    spark, kept = vectors.sparkSession, kept_vectors(vectors)
    centroids = first_centroids(kept, k)
    k = len(centroids)
    if k == 0:
        return Clustering(spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids, [])
    cells = Cells.fit(histograms(kept), bits)
    kind = np.int16 if cells.greatest < 1 << 15 else np.int32
    tables, name, out = Tables(spark), f"vectors_{uuid4().hex}", Tables(spark)
    stored = write_vectors(kept, cells, tables, name)

    def sums_of_all(centroids: np.ndarray) -> np.ndarray:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = cells.lookup(centroids)

            def work(part: pa.RecordBatch, total: np.ndarray) -> None:
                v = binary_rows(part.column(1), kind)
                found = place(cells.decode(binary_rows(part.column(0), np.uint8)), lookup)
                add(total, v, settle(found, v.astype(np.int64), centroids), 1)

            return moved_sums(batches, work, k)

        return gathered(stored.select("cells", "vec").mapInArrow(task, "cluster int, parts array<bigint>"), k)

    def sums_of_moves(before: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, int]:
        def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            old_table, new_table = cells.lookup(before), cells.lookup(now)
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    coded = cells.decode(binary_rows(part.column(1), np.uint8))
                    old, new = place(coded, old_table), place(coded, new_table)
                    go = np.flatnonzero((old < 0) | (old != new))
                    yield pa.RecordBatch.from_pydict({"key": part.column(0).take(pa.array(go)), "old": old[go].astype(np.int32), "new": new[go].astype(np.int32)})

        def work(part: pa.RecordBatch, total: np.ndarray) -> None:
            v = binary_rows(part.column(2), kind).astype(np.int64)
            old = settle(part.column(0).to_numpy(), v, before)
            new = settle(part.column(1).to_numpy(), v, now)
            go = old != new
            add(total, v[go], old[go], -1)
            add(total, v[go], new[go], 1)

        keys = out.put(stored.select("key", "cells").mapInArrow(undecided, "key bigint, old int, new int"))
        fetched = keys.join(stored.select("key", "vec"), "key").select("old", "new", "vec")
        return gathered(fetched.mapInArrow(lambda b: moved_sums(b, work, k), "cluster int, parts array<bigint>"), k), keys.count()

    sums, fetched, before = np.zeros((k, DIMS + 1), object), [], None
    for _ in range(rounds):
        if before is None:
            sums += sums_of_all(centroids)
        else:
            delta, n = sums_of_moves(before, centroids)
            sums += delta
            fetched.append(n)
        before = centroids
        centroids = np.array([[int(s) // int(row[DIMS]) for s in row[:DIMS]] if row[DIMS] else old for row, old in zip(sums, before)], np.int64)
    final = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = cells.lookup(final)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                v = binary_rows(part.column(2), kind).astype(np.int64)
                found = settle(place(cells.decode(binary_rows(part.column(1), np.uint8)), lookup), v, final)
                yield pa.RecordBatch.from_pydict({"vec_id": part.column(0), "cluster": found.astype(np.int32), "distance": ((v - final[found]) ** 2).sum(axis=1)})

    result = Tables(spark)
    placed = result.put(stored.select("vec_id", "cells", "vec").mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"))
    spark.sql(f"DROP TABLE {name}")
    tables.clear()
    out.clear()
    return Clustering(placed, centroids, fetched)


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, bits: int = BITS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    found = cluster(vectors, k, rounds, bits)
    spark = vectors.sparkSession
    inertia = {r["cluster"]: int(r["total"]) for r in
               found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    total = sum(inertia.values())
    fits = {c: v if v <= BIGINT else None for c, v in inertia.items()}
    rows = [(c, fits[c], total if total <= BIGINT else None, sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest())
            for c in sorted(inertia)]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.vectors.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def _oracle() -> str:
    """The rounds spelt out as common table expressions."""
    nearest = ("SELECT rid, c, dist FROM (SELECT rid, c, dist, row_number() OVER (PARTITION BY rid ORDER BY dist, c) AS nth FROM ("
               "SELECT x.rid, {c}.c, sum((x.x - {c}.y) * (x.x - {c}.y)) AS dist FROM x JOIN {c} ON {c}.d = x.d GROUP BY x.rid, {c}.c)) WHERE nth = 1")
    ctes = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS comps
  FROM embeddings WHERE len(embedding) = {DIMS} AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e))))""",
            f"x AS MATERIALIZED (SELECT rid, unnest(range(1, {DIMS + 1})) AS d, unnest(comps) AS x FROM v)",
            f"""seed AS MATERIALIZED (SELECT rid, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), comps) - 1 AS c
  FROM v QUALIFY c < {CENTROIDS})""",
            "c0 AS MATERIALIZED (SELECT seed.c, x.d, x.x AS y FROM seed JOIN x ON x.rid = seed.rid)"]
    for i in range(ROUNDS):
        ctes.append(f"a{i} AS MATERIALIZED ({nearest.format(c=f'c{i}')})")
        ctes.append(f"s{i} AS (SELECT a.c, x.d, CAST(sum(x.x) AS BIGINT) AS s, count(*) AS n FROM a{i} a JOIN x ON x.rid = a.rid GROUP BY a.c, x.d)")
        ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, o.y) AS y "
                    f"FROM c{i} o LEFT JOIN s{i} s ON s.c = o.c AND s.d = o.d)")
    ctes.append(f"last AS MATERIALIZED ({nearest.format(c=f'c{ROUNDS}')})")
    ctes.append(f"h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)")
    return f"""WITH {', '.join(ctes)}
SELECT v.vec_id, CAST(l.c AS INTEGER) AS cluster, CAST(l.dist AS BIGINT) AS distance,
       CAST(sum(l.dist) OVER (PARTITION BY l.c) AS BIGINT) AS cluster_inertia, CAST(sum(l.dist) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM last l JOIN v ON v.rid = l.rid JOIN h ON h.c = l.c"""


ORACLE = _oracle()
