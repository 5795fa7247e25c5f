"""Quality classifier: a factorisation machine (operator 5).

A document is a sparse vector of hashed words (share of the words, square root), structure statistics and length
metadata. Its score is the logistic of

    b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which takes time linear in the words. Fitting uses at most ``max_rows`` labelled rows, chosen by a hash of the label's
id (never held-out ones); only their vectors come to the driver. Scoring runs over every row and whole texts.

Defined results: a null text scores as an empty one; several labels of one id count as their smallest; null labels are
not learnt from; without labels of both kinds the score is the label seen, or 1 (nothing speaks against any document).
A null doc_id counts as empty text in the held-out rule. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import DOCUMENT_SCHEMA, crc_mod, document_rows, hash_share, map_rows

WORD_DIMS = 1 << 14
FACTORS = 8
#: Classes of bytes: 0 lower case, 1 upper case, 2 digit, 3 white space, 4 sentence mark, 5 other mark, 6 beyond ASCII.
CLASS = bytes(6 if b >= 0x80 else 0 if chr(b).islower() else 1 if chr(b).isupper() else 2 if chr(b).isdigit()
              else 3 if b in b" \t\n\r\x0b\x0c" else 4 if b in b".,;:?'\"-" else 5 for b in range(256))
SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Upper limits of the statistics' steps; each statistic is one of len + 1 indicators and its own value.
STEPS = (0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
N_STATS = 13
DIMS = WORD_DIMS + N_STATS * (len(STEPS) + 2)

_bucket: dict[bytes, int] = {}


def bucket(word: bytes) -> int:
    """Bucket of a word; the table of words seen is emptied when it is large."""
    at = _bucket.get(word)
    if at is None:
        if len(_bucket) > 200_000:
            _bucket.clear()
        at = _bucket[word] = crc32(word) & (WORD_DIMS - 1)
    return at


def statistics(text: bytes, words: list[bytes], idx: np.ndarray) -> list[float]:
    """Shares in 0..1 that describe the form of a text."""
    n = max(len(text), 1)
    kinds = np.bincount(np.frombuffer(text.translate(CLASS), np.uint8), minlength=7) / n if text else np.zeros(7)
    raw = text.split()
    nw = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    distinct = len(set(words)) / nw
    pairs = idx[:-1] * 31 + idx[1:] if len(idx) > 1 else idx
    tops = Counter(words).most_common(1)
    return [kinds[1], kinds[2], kinds[4], kinds[5], kinds[6], min(1.0, n / nw / 25), distinct, repeated,
            1 - len(np.unique(pairs)) / max(len(pairs), 1), min(1.0, len(lines) / nw), tops[0][1] / nw if tops else 0.0,
            sum(1 for w in raw if len(w) > 1 and w[-1:] in b"$*%&#!|") / max(len(raw), 1), min(1.0, np.log1p(len(text)) / 14)]


def vector(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and values of a whole text."""
    text = text or b""
    words = text.translate(SPLIT).split()
    idx = np.fromiter(map(bucket, words), np.int64, len(words))
    tf = np.bincount(idx, minlength=WORD_DIMS) if len(idx) else np.zeros(WORD_DIMS)
    at = np.flatnonzero(tf)
    value = np.sqrt(tf[at] / max(len(words), 1))
    stats = np.array(statistics(text, words, idx))
    base = WORD_DIMS + np.arange(N_STATS) * (len(STEPS) + 2)
    return (np.concatenate([at, base + np.searchsorted(STEPS, stats), base + len(STEPS) + 1]),
            np.concatenate([value, np.full(N_STATS, 0.5), stats]).astype(np.float32))


@dataclass
class FactorisationMachine:
    b: float
    w: np.ndarray
    v: np.ndarray
    constant: float | None = None

    def score(self, text: bytes | None) -> float:
        if self.constant is not None:
            return self.constant
        at, x = vector(text)
        v = self.v[at] * x[:, None]
        z = self.b + self.w[at] @ x + 0.5 * float((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, batch: int = 64, rate: float = 0.1, reg: float = 1e-5) -> FactorisationMachine:
    """AdaGrad on the logistic loss, batches in a fixed shuffled order."""
    labels = {r[2] for r in rows}
    if len(labels) < 2:
        return FactorisationMachine(0.0, np.zeros(0), np.zeros((0, 0)), float(labels.pop()) if labels else 1.0)
    rng = np.random.default_rng(7)
    b, w, v = 0.0, np.zeros(DIMS), rng.normal(0, 0.05, (DIMS, FACTORS))
    gb, gw, gv = 1e-6, np.full(DIMS, 1e-6), np.full((DIMS, FACTORS), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            part = [rows[i] for i in order[start:start + batch]]
            at, x = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part]).astype(float)
            y = np.array([p[2] for p in part], float)
            first = np.cumsum([0, *[len(p[0]) for p in part[:-1]]])
            doc = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
            vx = v[at] * x[:, None]
            s = np.add.reduceat(vx, first)
            z = b + np.add.reduceat(w[at] * x, first) + 0.5 * ((s ** 2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), first))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(part)
            touched, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, err[doc] * x) + reg * w[touched]
            each = (err[doc] * x)[:, None] * (s[doc] - vx)
            dv = np.stack([np.bincount(inverse, each[:, f]) for f in range(FACTORS)], axis=1) + reg * v[touched]
            gb += err.sum() ** 2
            gw[touched] += dw ** 2
            gv[touched] += dv ** 2
            b -= rate * err.sum() / np.sqrt(gb)
            w[touched] -= rate * dw / np.sqrt(gw[touched])
            v[touched] -= 0.3 * rate * dv / np.sqrt(gv[touched])
    return FactorisationMachine(float(b), w.astype(np.float32), v.astype(np.float32))


def held_out_rule() -> Column:
    return crc_mod(F.col("doc_id"), 4) == 2


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000) -> FactorisationMachine:
    """Fit on the labelled rows that are not held out, at most ``max_rows`` of them (a broadcast of that many ids).

    A label id that several documents carry labels each of them; equal rows count once, and where these are more than
    ``max_rows`` in all, those of the least hashes are taken, before anything reaches the driver."""
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out_rule())
             .groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.min("quality").cast("int").alias("quality")))
    chosen = known.orderBy(hash_share(F.col("label_id"), "quality"), "label_id").limit(max_rows)
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
              .select("text", "quality", "label_id", F.xxhash64("text").alias("rk")))

    def features(c: dict) -> dict:
        got = [vector(t) for t in c["text"]]
        return {"at": [a.astype(np.uint16).tobytes() for a, _ in got], "x": [x.tobytes() for _, x in got]} | {k: c[k] for k in ("quality", "label_id", "rk")}

    made = map_rows(sample, features, "at binary, x binary, quality int, label_id bigint, rk bigint")
    distinct = made.groupBy("label_id", "rk").agg(F.min(F.struct("at", "x", "quality")).alias("row"))
    got = distinct.orderBy(hash_share(F.col("label_id"), "quality"), F.xxhash64("rk"), "label_id", "rk").limit(max_rows).select("row.*").collect()
    rows = sorted((r["at"], r["x"], r["quality"]) for r in got)
    return fit([(np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(x, np.float32), int(q > 0)) for a, x, q in rows])


def score_documents(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """The documents' columns and ``score``, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x (FACTORS + 1) numbers

    def score(c: dict) -> dict:
        return c | {"score": [shared.value.score(t) for t in c["text"]]}

    return map_rows(document_rows(docs), score, f"{DOCUMENT_SCHEMA}, score double")


def assess(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(c: dict) -> dict:
        return {"doc_id": c["doc_id"], "score": [shared.value.score(t) for t in c["text"]]}

    scored = map_rows(docs.select(F.col("doc_id").cast("bigint"), "text"), score, "doc_id bigint, score double")
    return scored.select("doc_id", held_out_rule().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
