"""Repeated byte strings by a depth-limited radix sort of suffixes (operator 2).

A string of ``length`` bytes that starts at two places is found by sorting suffixes through ``length`` bytes only: each
pass puts suffixes that agree in the next digits into one group, and groups of one leave. Digits are hashed, so a pass
is an aggregation by (digits so far, next digit), and no group meets in one task.

Passes over every byte position would move the corpus many times over, so suffixes are sorted through their window's
*anchor*: the window's least hashed gram of ``length / 4`` bytes. Equal windows have equal anchors at equal offsets;
consecutive windows mostly share theirs, so one row stands for about ``3/8 length`` suffixes. The digits of a window are
its anchor's gram first and then the bytes around it, outwards:

* pass 1: the gram. Anchors whose gram occurs once leave.
* pass 2: all bytes of all windows that could hold the anchor. If these occur twice, every window in them repeats.
* passes 3 to 5: the windows of the other anchors in blocks of 32, 4 and 1 offsets. A block goes on only if the bytes
  that its windows have in common (368, 396, 400 of 400) occur twice, and it is done if the bytes of all its windows do.
  Blocks of one offset are windows: equal groups are exactly the repeated windows. Of members that are done and equal
  one goes on as the partner of those that are not.

A group is told by two independent 64-bit hashes, of the gram and of the digits. Bytes under a repeated window are
removed; windows are judged on the input.

Defined results: a null text is empty; texts shorter than ``length`` are kept; equal rows repeat each other; rows of one
id with different texts are documents of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KEY, Tables, map_rows, plain, rows_of, squeezed
from strata.session import cut

LENGTH = 400
#: Offsets in a block of passes 3 to 5.
BLOCKS = (32, 4, 1)
#: Starts of windows that are hashed at once; bounds the memory for a long text.
PIECE = 1 << 17

_U = np.uint64
_rng = np.random.default_rng(20_250_101)
#: For each of two polynomials modulo 2^64: a number for each byte, an odd base and its inverse.
_TABLES = [_rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1) for _ in range(2)]
_BASES = [int(x) * 8 + 5 for x in _rng.integers(1, 2 ** 60, 2)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of base ``k`` and of its inverse, kept per process up to the piece's size."""
    if k not in _powers or len(_powers[k][0]) < n:
        size = max(n, 1 << 12)
        both = []
        for base in (_BASES[k], pow(_BASES[k], -1, 2 ** 64)):
            p = np.ones(size, _U)
            p[1:] = np.multiply.accumulate(np.full(size - 1, base, _U))
            both.append(p)
        _powers[k] = (both[0], both[1])
    return _powers[k][0][:n], _powers[k][1][:n]


class Rolling:
    """Hashes of any substrings of some bytes."""

    def __init__(self, data: np.ndarray, k: int):
        self.prefix = np.zeros(len(data) + 1, _U)
        up, self.down = powers(k, len(data) + 1)
        np.cumsum(_TABLES[k][data] * up[:-1], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix(raw + (end - start).astype(_U) * _U(0x9E3779B97F4A7C15))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, from the running minima of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, _U)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For each run of windows with one anchor: place of the anchor, least and greatest offset of the anchor in its
    windows, hash of the gram, hash of all bytes around it (``reach`` before, ``length`` behind, or up to the ends)."""
    gram = max(length // 4, 1)
    reach = length - gram
    n_windows = len(text) - length + 1
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for begin in range(0, max(n_windows, 0), PIECE):
        end = min(begin + PIECE, n_windows)
        low, high = max(0, begin - reach), min(len(text), end + reach + length)
        data = np.frombuffer(text, np.uint8, high - low, low)
        first = Rolling(data, 0)
        at = np.arange(begin - low, end - 1 + reach + 1 - low)
        grams = first.of(at, at + gram)
        # the leftmost of equal grams: the place is the lower part of what is compared
        ranked = (mix(grams) & ~_U(PIECE * 4 - 1)) | np.arange(len(at)).astype(_U)
        place = (least(ranked, reach + 1) & _U(PIECE * 4 - 1)).astype(np.int64)
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        ends = np.append(starts[1:], len(place)) - 1
        a = place[starts]
        pos = a + begin
        whole = Rolling(data, 1)
        left, right = np.maximum(pos - reach, 0) - low, np.minimum(pos + length, len(text)) - low
        out[0].append(pos)
        out[1].append(a - ends)
        out[2].append(a - starts)
        out[3].append(grams[a])
        # where in the bytes the anchor stands is told by the gram's place from the left
        out[4].append(mix(whole.of(left, right) + (pos - low - left).astype(_U)))
    pos, low_at, high_at, gram_at, whole_at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
    first_of = np.flatnonzero(np.diff(pos, prepend=-1))  # a run that two pieces share is one
    last_of = np.append(first_of[1:], len(pos)) - 1 if len(pos) else first_of
    return pos[first_of], low_at[last_of], high_at[first_of], gram_at[first_of].astype(_U), whole_at[first_of].astype(_U)


def pack(pos: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (pos << 24) | (low << 12) | high


def unpack(packed: int) -> tuple[int, int, int]:
    return packed >> 24, packed >> 12 & 0xFFF, packed & 0xFFF


def repeated_spans(docs: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``did, rk, start, end``: ranges whose every ``length`` bytes start somewhere else too; ranges may overlap."""
    if not 4 <= length < 4096:
        raise ValueError("length must lie between 4 and 4095")
    reach = length - max(length // 4, 1)

    def suffixes(c: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("did", "rk", "packed", "gram", "whole", "size")}
        for did, rk, text in zip(c["did"], c["rk"], c["text"]):
            pos, low, high, gram, whole = anchors(text, length)
            out["packed"] += pack(pos, low, high).tolist()
            out["gram"] += gram.view(np.int64).tolist()
            out["whole"] += whole.view(np.int64).tolist()
            out["did"] += [did] * len(pos)
            out["rk"] += [rk] * len(pos)
            out["size"] += [len(text)] * len(pos)
        return out

    # written once for both of its readers, and deleted when they are done
    tables = Tables(docs.sparkSession)
    rows = tables.put(map_rows(rows_of(docs).filter(F.octet_length("text") >= length), suffixes,
                               "did bigint, rk bigint, packed bigint, gram bigint, whole bigint, size bigint", 32))
    # pass 1: grams that occur twice
    # (cut, so that both sides of the join are plain shuffles and a gram that is very common is split)
    twice = cut(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    kept = cut(rows.join(twice, "gram"))
    tables.clear()
    # pass 2: all bytes that the anchor's windows can have
    groups = cut(kept.groupBy(F.col("gram").alias("g"), F.col("whole").alias("w"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "packed")).alias("one")).filter("n > 1"))
    judged = kept.join(groups, (F.col("gram") == F.col("g")) & (F.col("whole") == F.col("w")), "left")
    pos = F.shiftright("packed", 24)
    found = [judged.filter("n IS NOT NULL").select(*KEY, F.greatest(pos - reach, F.lit(0)).alias("start"),
                                                   F.least(pos + length, F.col("size")).alias("end"))]
    # passes 3 to 5, on the bytes around what is left; of equal anchors that are done one stays as the others' partner
    undone = judged.filter("n IS NULL").select(*KEY, "packed", "gram")
    partners = groups.select("one.*", F.col("g").alias("gram")).join(undone.select("gram").distinct(), "gram", "left_semi")
    todo = undone.unionByName(partners).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("packed", "gram"))).alias("todo"))

    def around(c: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("did", "rk", "packed", "gram", "before", "bytes")}
        for did, rk, z, anchors_here in zip(c["did"], c["rk"], c["z"], c["todo"]):
            text = plain(z)
            for x in anchors_here:
                at = unpack(x["packed"])[0]
                left = max(0, at - reach)
                out["did"].append(did)
                out["rk"].append(rk)
                out["packed"].append(x["packed"])
                out["gram"].append(x["gram"])
                out["before"].append(at - left)
                out["bytes"].append(text[left:at + length])
        return out

    joined = texts.join(todo, KEY).select(*KEY, "z", "todo")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spot = F.struct(*KEY, "packed")
    context = (map_rows(joined, around, "did bigint, rk bigint, packed bigint, gram bigint, before int, bytes binary", 16)
               .select(spot.alias("spot"), "gram", "before", "bytes").repartition(n, "spot").persist(StorageLevel.MEMORY_AND_DISK))
    active = None
    for level, size in enumerate(BLOCKS):
        wider = BLOCKS[level - 1] if level else reach + 1

        def digits(c: dict, size: int = size, wider: int = wider) -> dict:
            out: dict[str, list] = {k: [] for k in ("spot", "gram", "block", "core", "hull")}
            for i, (spot, data, before) in enumerate(zip(c["spot"], c["bytes"], c["before"])):
                _, low, high = unpack(spot["packed"])
                n = len(data)
                first = []
                for b in c["active"][i] or [0]:  # blocks of the pass before
                    first += [o for o in range(b, min(b + wider, reach + 1), size) if o <= high and o + size > low]
                if not first:
                    continue
                o1 = np.array(first)
                o2 = np.minimum(o1 + size - 1, reach)
                hashes = Rolling(np.frombuffer(data, np.uint8), 1)
                # offsets that this document has: at most ``before`` bytes lie before the anchor, and n - before behind
                inside = (o1 <= before) & (before - o2 + length <= n)
                o1, o2 = o1[inside], o2[inside]
                core = hashes.of(before - o1, before - o2 + length)
                fits = (o2 <= before) & (before - o1 + length <= n)
                hull = hashes.of(np.where(fits, before - o2, 0), np.where(fits, before - o1 + length, 0))
                out["spot"] += [spot] * len(o1)
                out["gram"] += [c["gram"][i]] * len(o1)
                out["block"] += o1.tolist()
                out["core"] += core.view(np.int64).tolist()
                out["hull"] += [h if f else None for h, f in zip(hull.view(np.int64).tolist(), fits.tolist())]
            return out

        source = context if active is None else context.join(active, "spot")
        source = source.withColumn("active", F.lit(None).cast("array<int>")) if active is None else source
        nodes = map_rows(source, digits, "spot struct<did:bigint,rk:bigint,packed:bigint>, gram bigint, block int, core bigint, hull bigint", 64)
        nodes = nodes.persist(StorageLevel.MEMORY_AND_DISK)
        key = ["gram", "block", "core"]
        groups = nodes.groupBy(*key, "hull").agg(F.count(F.lit(1)).alias("n"), F.min("spot").alias("one"))
        cores = groups.groupBy(*key).agg(F.sum("n").alias("n_core")).filter("n_core > 1").select(*key)
        hulls = groups.filter("n > 1 AND hull IS NOT NULL").withColumnRenamed("n", "n_hull")
        judged = cut(nodes.join(cut(cores), key).join(cut(hulls), [*key, "hull"], "left"))
        nodes.unpersist()
        at = F.shiftright("spot.packed", 24)
        found.append(judged.filter("n_hull IS NOT NULL").select(
            "spot.did", "spot.rk", (at - F.least(F.col("block") + (size - 1), F.lit(reach))).alias("start"), (at - F.col("block") + length).alias("end")))
        undone = judged.filter("n_hull IS NULL").select("spot", *key)
        partners = (judged.filter("spot <=> one").select("spot", *key)
                    .join(undone.select(*key).distinct(), key, "left_semi"))
        active = undone.unionByName(partners).groupBy("spot").agg(F.sort_array(F.collect_set("block")).alias("active"))
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return cut(spans)


def merged(spans: list[int]) -> list[tuple[int, int]]:
    """Maximal ranges of rising (start, end) pairs packed as start << 32 | end."""
    out: list[tuple[int, int]] = []
    for x in spans:
        s, e = x >> 32, x & 0xFFFFFFFF
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, rk, kept, n_bytes, spans`` of every row: the remaining bytes, and the removed ranges."""
    texts = squeezed(docs)
    spans = repeated_spans(docs, texts, length)
    packed = F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("end").cast("bigint"))
    listed = spans.select(*KEY, packed.alias("span")).groupBy(*KEY).agg(F.sort_array(F.collect_set("span")).alias("listed"))

    def work(c: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("kept", "n_bytes", "spans")}
        for z, listed in zip(c["z"], c["listed"]):
            text = plain(z)
            ranges = merged(listed or [])
            at, kept = 0, []
            for s, e in ranges:
                kept.append(text[at:s])
                at = e
            out["kept"].append(b"".join([*kept, text[at:]]))
            out["n_bytes"].append(len(text))
            out["spans"].append([{"start": s, "end": e} for s, e in ranges])
        return {"doc_id": c["doc_id"], "rk": c["rk"]} | out

    joined = texts.join(listed, KEY, "left").select("doc_id", "rk", "z", "listed")
    return map_rows(joined, work, "doc_id bigint, rk bigint, kept binary, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>", 64)


def digest(removed: DataFrame) -> DataFrame:
    """The contract's columns."""
    width = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return removed.select("doc_id", "n_bytes", width.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
