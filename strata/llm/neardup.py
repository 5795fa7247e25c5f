"""Near-duplicate classes by BagMinHash (operator 8).

A document is the multiset of its five-word shingles. Every shingle of count c is a Poisson process in time on the
weight range [0, c): the range is cut into the intervals [0,1), [1,2), [2,4), [4,8), ..., each with a process of a rate
equal to its width whose points carry a place inside it; of the interval that holds c only the points below c count.
Each point belongs to one of ``SIZE`` signature places, and a place keeps its earliest point. Two documents agree in a
place with the probability of their weighted Jaccard likeness. Points are drawn in time order up to a horizon at which
all places are filled, so a document costs its shingles plus SIZE log SIZE points.

Equal multisets are one node. Nodes that share a band (4 places) are candidates, in three rounds: each with one node of
the band, another one in every band; then, in bands that still hold several classes, each with the band's node of most
links; then each with the nodes of the other classes. The joins let pass only pairs whose weights allow the likeness
and whose signatures agree enough, so what they give grows with the links and not with the square of a band. Passed
pairs are verified on whole texts: sum of minima over sum of maxima of the counts is at least ``threshold``. Classes are
the connected components of the verified links; a pair that shares a band is left out only if it is in one class.

With 24 bands a pair of likeness 0.8 shares none with probability 3e-6. The estimate lets pass what agrees in at least
four standard deviations less than the threshold, and a pair is passed in one band only. In the third round, where
thousands of texts a little below the threshold may meet, the nodes that are left get a second, longer signature, whose
estimate is twice as sharp; signing all documents with it would cost more than it saves.

Defined results: a text of one to four words is one shingle; texts without words are classes of equal texts; a null
text is a class of its own id; a class is named by its smallest doc_id (null if all are null); equal rows are copies.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import chain
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from strata.llm.common import KEY, Tables, document_rows, map_rows, plain, rows_of, squeezed, with_key
from strata.llm.components import components, merged
from strata.llm.decontaminate import words_of

SHINGLE, THRESHOLD = 5, 0.8
BANDS = 24


class Sketch(NamedTuple):
    """``size`` places of a signature, of which ``bits`` bits each are kept, ``packed`` of them in a long with a free bit
    for counting above each. ``margin`` is four standard deviations of the share that agrees, at the threshold."""

    size: int
    bits: int
    packed: int
    margin: float


COARSE = Sketch(96, 14, 4, 0.16)
FINE = Sketch(504, 7, 7, 0.072)
SIZE = COARSE.size

_U = np.uint64


class _Hashes(dict):
    """Hashes of words, kept for at most 200,000 of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


_word = _Hashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a whole text, rising, and their counts."""
    return shingle_lists([text])[0]


def shingle_lists(texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``shingles`` of several texts, hashed in one go."""
    lists = [words_of(t) for t in texts]
    ends = np.cumsum([len(x) for x in lists]).tolist()
    h = np.fromiter(map(_word.__getitem__, chain.from_iterable(lists)), _U, ends[-1] if ends else 0)
    total = roll(h, SHINGLE) if len(h) >= SHINGLE else None
    out = []
    for x, end in zip(lists, ends):
        n = len(x)
        own = total[end - n:end - SHINGLE + 1] if n >= SHINGLE else roll(h[end - n:end], n) if n else h[:0]
        out.append(np.unique(own, return_counts=True))
    return out


def roll(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` neighbouring words."""
    total = np.zeros(len(h) - width + 1, _U)
    for j in range(width):
        total = mix(total + h[j:len(h) - width + 1 + j] + _U(j + 1))
    return total


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def intervals(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The processes of a multiset: their identities, rates, and the share of each interval that counts."""
    ids, widths, caps = [], [], []
    low, width, level = 0.0, 1.0, 0
    while len(elements):
        ids.append(mix(elements + _U(0x9E3779B97F4A7C15 * (level + 1) % 2 ** 64)))
        widths.append(np.full(len(elements), width))
        caps.append(np.minimum(weights - low, width) / width)
        low += width
        width = 1.0 if level == 0 else width * 2
        level += 1
        more = weights > low
        elements, weights = elements[more], weights[more]
    return np.concatenate(ids), np.concatenate(widths), np.concatenate(caps)


def signatures_of(sets: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """A row of ``size`` numbers for each (non-empty) multiset; equal ones stand for the same earliest point."""
    rows = np.full((len(sets), size), np.inf)
    todo, slack = np.arange(len(sets)), 4.0
    while len(todo):
        parts = [intervals(*sets[i]) for i in todo]
        ident, rate, cap = (np.concatenate(x) for x in zip(*parts))
        horizon = size * (np.log(size) + slack) / np.array([float(sets[i][1].sum()) for i in todo])
        at = np.repeat(np.arange(len(todo)), [len(p[0]) for p in parts])
        best, time, step, until = np.full(len(todo) * size, np.inf), np.zeros(len(ident)), 0, horizon[at]
        while len(ident):
            ahead = min(64, max(1, 8192 // len(ident)))  # points a process draws at once: many where few processes go on
            draw = mix(ident[:, None] ^ mix(np.arange(step + 1, step + 1 + ahead, dtype=_U)))
            times = np.cumsum(np.column_stack([time, -np.log(uniform(draw)) / rate[:, None]]), axis=1)[:, 1:]
            early = times < until[:, None]
            own, draw = np.nonzero(early)[0], draw[early]
            place = at[own] * size + (mix(draw + _U(1)) % _U(size)).astype(np.int64)
            taken = (cap[own] >= 1) | (uniform(mix(draw + _U(2))) < cap[own])
            np.minimum.at(best, place[taken], times[early][taken])
            alive, step = early[:, -1], step + ahead
            ident, time, rate, cap, at, until = (x[alive] for x in (ident, times[:, -1], rate, cap, at, until))
        best = best.reshape(-1, size)
        full = np.isfinite(best).all(axis=1)
        rows[todo[full]] = best[full]
        todo, slack = todo[~full], slack * 2  # a place was left empty before the horizon: look further
    return (mix(rows.view(_U)) >> _U(32)).astype(np.uint32)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard likeness of two multisets."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][x], b[1][y]).sum())
    return least / max(int(a[1].sum() + b[1].sum()) - least, 1)


def packed(sigs: np.ndarray, sketch: Sketch) -> list[list[int]]:
    """The longs of each signature."""
    places = (sigs & np.uint32((1 << sketch.bits) - 1)).astype(np.int64).reshape(len(sigs), -1, sketch.packed)
    return (places << (np.arange(sketch.packed) * (sketch.bits + 1))).sum(axis=2).tolist()


def differing(a: Column, b: Column, sketch: Sketch) -> Column:
    """How many places of two longs differ: a place of their difference that isn't zero carries into its free bit when
    all its bits are added."""
    at = [i * (sketch.bits + 1) for i in range(sketch.packed)]
    ones, free = (F.lit(sum(x << i for i in at)) for x in ((1 << sketch.bits) - 1, 1 << sketch.bits))
    return F.bit_count((a.bitwiseXOR(b) + ones).bitwiseAND(free))


#: A long of the coarse sketch holds the places of one band.
SKETCH = [f"s{i}" for i in range(COARSE.size // COARSE.packed)]


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, did, rk, node, weight, sketch, bands`` of every row; ``node`` is the digest of its multiset, ``weight``
    the number of its shingles; ``sketch`` and ``bands`` are null without words."""
    def work(c: dict) -> dict:
        sets = shingle_lists(c["text"])
        spoken = [i for i, (h, _) in enumerate(sets) if len(h)]
        out = {k: c[k] for k in ("doc_id", *KEY)} | {"node": [], "weight": [int(n.sum()) for _, n in sets],
                                                     "sketch": [None] * len(sets), "bands": [None] * len(sets)}
        for doc_id, text, (h, n) in zip(c["doc_id"], c["text"], sets):
            own = h.tobytes() + n.tobytes() if len(h) else b"null %r" % doc_id if text is None else b"text " + text
            out["node"].append(blake2b(own, digest_size=16).digest())
        if spoken:
            sigs = signatures_of([sets[i] for i in spoken])
            band = np.broadcast_to(np.arange(BANDS, dtype=_U), (len(spoken), BANDS))
            for r in range(SIZE // BANDS):
                band = mix(band + (sigs[:, r::SIZE // BANDS] & np.uint32((1 << COARSE.bits) - 1)).astype(_U))
            for i, own, row in zip(spoken, packed(sigs, COARSE), band.view(np.int64).tolist()):
                out["sketch"][i], out["bands"][i] = own, row
        return out

    return map_rows(rows_of(docs), work, "doc_id bigint, did bigint, rk bigint, node binary, weight bigint, sketch array<bigint>, bands array<bigint>")


def alike(threshold: float) -> Column:
    """Can nodes a and b reach the threshold by their weights, and do enough places of their coarse sketches agree?"""
    differ = F.lit(0)
    for s in SKETCH:
        differ = differ + differing(F.col(f"{s}_a"), F.col(f"{s}_b"), COARSE)
    a, b = F.col("weight_a"), F.col("weight_b")
    return (F.least(a, b) >= F.greatest(a, b) * threshold) & (differ <= COARSE.size - int((threshold - COARSE.margin) * COARSE.size))


def closely_alike(threshold: float) -> Column:
    """Do enough places of the fine sketches of nodes a and b agree?"""
    differ = F.aggregate(F.zip_with("fine_a", "fine_b", lambda a, b: differing(a, b, FINE)), F.lit(0), lambda n, x: n + x)
    return differ <= FINE.size - int((threshold - FINE.margin) * FINE.size)


def fine_sketches(texts: DataFrame, nodes: DataFrame, tables: Tables) -> DataFrame:
    """``x, fine``: the fine sketch of each of the given nodes (``node, did, rk``; with words), from its whole text."""
    def work(c: dict) -> dict:
        sets = shingle_lists([plain(z) for z in c["z"]])
        return {"x": c["node"], "fine": packed(signatures_of(sets, FINE.size), FINE) if sets else []}

    signed = map_rows(nodes.join(texts, KEY).select("node", "z"), work, "x binary, fine array<bigint>")
    return tables.put(signed.groupBy("x").agg(F.min("fine").alias("fine")))


def first_common_band() -> Column:
    """Number of the first band that nodes a and b share."""
    return F.coalesce(*[F.when(F.col(f"{s}_a") == F.col(f"{s}_b"), i) for i, s in enumerate(SKETCH)])


def side(nodes: DataFrame, name: str, *more: str) -> DataFrame:
    """Columns of ``nodes`` as those of node ``name`` of a pair."""
    return nodes.select(F.col("node").alias(name), *[F.col(k).alias(f"{k}_{name}") for k in ("weight", *more)],
                        *[F.col("sketch")[i].alias(f"{s}_{name}") for i, s in enumerate(SKETCH)],
                        *[F.col("row")[k].alias(f"{k}_{name}") for k in KEY])


PAIR = ["a", "b", *[f"{k}_{x}" for x in "ab" for k in KEY]]


def likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) that can be links, with the rows that stand for them."""
    return pairs.join(side(nodes, "a"), "a").join(side(nodes, "b"), "b").filter(alike(threshold)).select(*PAIR)


def verified(texts: DataFrame, pairs: DataFrame, threshold: float, tables: Tables) -> DataFrame:
    """The pairs whose multisets overlap enough, from whole texts. Node ``b`` may have very many partners: its texts are
    written first, so that its join has two plain shuffles and is split like any skewed join."""
    pairs = tables.put(pairs)
    centres = tables.put(pairs.select(*[F.col(f"{k}_b").alias(k) for k in KEY]).distinct())
    left, right = (t.select(*[F.col(k).alias(f"{k}_{x}") for k in KEY], F.col("z").alias(f"z_{x}"))
                   for x, t in (("a", texts), ("b", tables.put(texts.join(centres, KEY, "left_semi").drop("doc_id")))))
    both = (pairs.join(left, [f"{k}_a" for k in KEY]).select("a", "b", "z_a", *[f"{k}_b" for k in KEY])
            .join(right, [f"{k}_b" for k in KEY]).select("a", "b", "z_a", "z_b"))
    last: dict[bytes, tuple] = {}

    def work(c: dict) -> dict:
        keep = []
        for i, (x, y) in enumerate(zip(c["z_a"], c["z_b"])):
            if y not in last:  # rows of one partner follow one another
                last.clear()
                last[y] = shingles(plain(y))
            if overlap(shingles(plain(x)), last[y]) >= threshold:
                keep.append(i)
        return {k: [c[k][i] for i in keep] for k in ("a", "b")}

    return tables.put(map_rows(both, work, "a binary, b binary"))


def mixed_bands(shared: DataFrame, labels: DataFrame, tables: Tables) -> DataFrame:
    """``no, band, node, label`` of the bands that hold nodes of several classes."""
    tagged = tables.put(shared.join(labels.withColumnRenamed("node", "x"), F.col("node") == F.col("x"), "left")
                 .select("no", "band", "node", F.coalesce("label", "node").alias("label")))
    mixed = tables.put(tagged.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("band"))
    return tagged.join(mixed, "band")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, did, rk, class_id, first``: the class of every row; ``first`` marks rows equal to the class's first one."""
    kept, tables = Tables(docs.sparkSession), Tables(docs.sparkSession)  # the result reads from kept
    signed = kept.put(signatures(docs))
    texts = squeezed(docs)
    row = F.struct((F.col("doc_id").isNull()).alias("none"), *KEY)
    nodes = tables.put(signed.groupBy("node", "weight").agg(F.min(row).alias("row"), F.min("sketch").alias("sketch"), F.min("bands").alias("bands")))
    banded = nodes.filter(F.col("bands").isNotNull()).select("node", F.posexplode("bands").alias("no", "band"))
    # (every aggregate that is joined to its rows is written: both sides are plain shuffles and a hot key is split)
    heads = tables.put(banded.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node")).alias("head"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("band", F.col("head.node").alias("head")))
    together = tables.put(banded.join(heads, "band"))
    star = together.filter("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    links = verified(texts, likely(star, nodes, threshold), threshold, tables)
    labels = components(links, tables)
    # the node of most links in each band
    shared = together.select("no", "band", "node")
    degree = tables.put(links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("x")).agg(F.count(F.lit(1)).alias("degree")))
    open_bands = tables.put(mixed_bands(shared, labels, tables).join(degree, F.col("node") == F.col("x"), "left")
                     .select("band", "node", "label", F.coalesce("degree", F.lit(0)).alias("degree")))
    hubs = tables.put(open_bands.groupBy("band").agg(F.max(F.struct("degree", "node", "label")).alias("hub")))
    star = (open_bands.join(hubs, "band").filter("label != hub.label")
            .select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct())
    labels = merged(labels, verified(texts, likely(star, nodes, threshold), threshold, tables), tables)
    # what is left: nodes of different classes in one band, paired only if they can be links
    open_bands = tables.put(mixed_bands(shared, labels, tables))
    left_over = tables.put(nodes.join(open_bands.select("node").distinct(), "node", "left_semi"))
    fine = fine_sketches(texts, left_over.select("node", *[F.col("row")[k].alias(k) for k in KEY]), tables)
    left_over = tables.put(left_over.join(fine, F.col("node") == F.col("x")).drop("x"))
    a = open_bands.select("no", "band", "label", F.col("node").alias("a")).join(side(left_over, "a", "fine"), "a").withColumnRenamed("label", "label_a")
    b = open_bands.select("band", "label", F.col("node").alias("b")).join(side(left_over, "b", "fine"), "b").withColumnRenamed("label", "label_b")
    across = a.join(b, (a["band"] == b["band"]) & (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & alike(threshold)
                    & (first_common_band() == F.col("no")) & closely_alike(threshold)).select(*PAIR).distinct()
    labels = merged(labels, verified(texts, across, threshold, tables), tables)
    named = tables.put(nodes.select("node", "row").join(labels.withColumnRenamed("node", "x"), F.col("node") == F.col("x"), "left")
                .select("node", "row", F.coalesce("label", "node").alias("label")))
    lowest = tables.put(named.groupBy("label").agg(F.min("row").alias("head_row")))
    named = kept.put(named.join(lowest, "label").select("node", "head_row"))
    tables.clear()
    texts.unpersist()
    head = F.col("head_row")
    return signed.select("doc_id", *KEY, "node").join(named, "node").select(
        "doc_id", *KEY, F.when(~head["none"], head["did"]).alias("class_id"),
        ((F.col("did") == head["did"]) & (F.col("rk") == head["rk"])).alias("first"))


def distinct_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, that of the smallest doc_id; of rows with equal id and text the least."""
    kept = classes(docs, threshold).filter("first").select(*KEY).distinct()
    rows = with_key(document_rows(docs))
    return (rows.join(kept, KEY, "left_semi").groupBy("doc_id", *KEY).agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("d"))
            .select("doc_id", "d.text", "d.lang", "d.source", "d.n_chars"))
