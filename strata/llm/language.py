"""Language identification by hierarchical discrimination (operator 9).

A text becomes the frequencies of its hashed byte trigrams (lower case, everything but letters as a space). Linear
support vector machines first separate the language families one against the rest; within a family one-versus-one
machines separate the languages and vote. All machines are columns of one matrix, so a text is scored in one pass.

Fitting reads a bounded sample of labelled rows: about ``per_lang`` rows a language, chosen by a hash of the text
(never in the held-out part), at most ``max_rows`` in all; only their trigram counts come to the driver. Scoring runs
over every row and whole texts.

Defined results: a null text and a text without a letter are ``und`` with score 0; without any labelled row every text
is ``und`` with score 0; a null doc_id counts as empty text in the held-out rule; equal texts get equal results. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, hash_share, map_rows

#: Families of common language codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa ur",
    "celtic": "br cy ga gd",
    "semitic": "ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMS = 1 << 13
PIECE = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become a space; runs of spaces stay one by one trigram of spaces that weighs nothing.
CLEAN = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def trigrams(text: bytes):
    """Buckets of the byte trigrams of a text, piece by piece."""
    data = b" " + text.decode("utf-8", "replace").lower().encode("utf-8").translate(CLEAN) + b" "
    for at in range(0, max(1, len(data) - 2), PIECE):
        b = np.frombuffer(data[at:at + PIECE + 2], np.uint8).astype(np.uint32)
        if len(b) > 2:
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            code = code[code != 0x202020]
            yield ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.intp)


def counts(text: bytes) -> np.ndarray:
    total = np.zeros(DIMS)
    for idx in trigrams(text):
        total += np.bincount(idx, minlength=DIMS)
    return total


def has_letter(text: bytes | None) -> bool:
    return text is not None and LETTER.search(text.decode("utf-8", "replace")) is not None


@dataclass
class LanguageModel:
    langs: list[str]
    families: list[str]
    members: list[list[int]]          # languages of each family
    pairs: list[tuple[int, int]]      # of each machine behind the families'
    weights: np.ndarray               # DIMS x machines, scaling folded in
    bias: np.ndarray

    def predict(self, text: bytes) -> tuple[str, float]:
        total, n = np.zeros(self.weights.shape[1]), 0
        for idx in trigrams(text):
            total += np.bincount(idx, minlength=DIMS) @ self.weights if len(idx) > 8000 else self.weights[idx].sum(axis=0)
            n += len(idx)
        margin = total / max(n, 1) + self.bias
        nf = len(self.families)
        sure = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
        family = int(margin[:nf].argmax()) if nf > 1 else 0
        score = float(sure[family]) if nf > 1 else 1.0
        votes = {lang: [0, 0.0] for lang in self.members[family]}
        for k, (a, b) in enumerate(self.pairs, nf):
            if a in votes:
                win = a if margin[k] >= 0 else b
                votes[win][0] += 1
                votes[win][1] += abs(margin[k])
        lang = max(votes, key=lambda v: (*votes[v], -v))
        for k, (a, b) in enumerate(self.pairs, nf):
            if lang in (a, b):
                score = min(score, float(sure[k] if lang == a else 1 - sure[k]))
        return self.langs[lang], min(1.0, max(0.0, score))


def machine(x: np.ndarray, y: np.ndarray, steps: int = 150, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge) by accelerated gradient steps; classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    look, b, look_b, t = w.copy(), 0.0, 0.0, 1.0
    rate = 1 / (2 * float((x * x).sum(axis=1).max() + 1) + reg)
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ look + look_b)) * weight * y
        new, new_b = look + rate * (2 * (slack @ x) - reg * look), look_b + rate * 2 * float(slack.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / nt * (new - w), new_b + (t - 1) / nt * (new_b - b)
        w, b, t = new, new_b, nt
    return w, b


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel | None:
    """``samples``: language, buckets, counts of each sampled text."""
    langs = sorted({s[0] for s in samples})
    if not langs:
        return None
    freq = np.zeros((len(samples), DIMS), np.float32)
    for row, (_, idx, n) in enumerate(samples):
        freq[row, idx] = n / max(n.sum(), 1)
    scale = (1 / np.sqrt(freq.mean(axis=0) + 1e-5)).astype(np.float32)
    freq *= scale
    of = np.array([langs.index(s[0]) for s in samples])
    families = sorted({FAMILY_OF.get(x, x) for x in langs})
    members = [[i for i, x in enumerate(langs) if FAMILY_OF.get(x, x) == f] for f in families]
    pairs = [p for m in members for p in combinations(m, 2)]
    found = []
    if len(families) > 1:
        found += [machine(freq, np.where(np.isin(of, m), 1, -1).astype(np.float32)) for m in members]
    else:
        found.append((np.zeros(DIMS, np.float32), 0.0))
    for a, b in pairs:
        rows = (of == a) | (of == b)
        found.append(machine(freq[rows], np.where(of[rows] == a, 1, -1).astype(np.float32)))
    weights = np.stack([w * scale for w, _ in found], axis=1)
    return LanguageModel(langs, families, members, pairs, weights.astype(np.float32), np.array([b for _, b in found]))


def train(docs: DataFrame, learn: Column, per_lang: int = 150, max_rows: int = 600) -> LanguageModel | None:
    """Fit on at most ``max_rows`` rows that fulfil ``learn``, about ``per_lang`` of each language."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    shares = {r["lang"]: per_lang / r["count"] for r in rows.groupBy("lang").count().collect()}
    if not shares:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("lang"))
    order = hash_share(F.col("text"), "language")
    chosen = rows.withColumn("at", order / share).filter("at < 1").orderBy("at", F.xxhash64("text")).limit(max_rows).select("lang", "text")

    def features(c: dict) -> dict:
        idx, n = [], []
        for text in c["text"]:
            total = counts(text)
            at = np.flatnonzero(total)
            idx.append(at.astype(np.uint16).tobytes())
            n.append(total[at].astype(np.float32).tobytes())
        return {"lang": [x.decode() for x in c["lang"]], "idx": idx, "n": n}

    got = map_rows(chosen, features, "lang string, idx binary, n binary").collect()
    return fit([(r["lang"], np.frombuffer(r["idx"], np.uint16).astype(np.intp), np.frombuffer(r["n"], np.float32)) for r in got])


def identify(docs: DataFrame, model: LanguageModel | None, held_out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x machines: bounded by the number of languages

    def score(c: dict) -> dict:
        m = shared.value
        out = [m.predict(t) if m and has_letter(t) else ("und", 0.0) for t in c["text"]]
        return {"doc_id": c["doc_id"], "held_out": c["held_out"], "lang_pred": [x for x, _ in out], "score": [s for _, s in out]}

    rows = docs.select(F.col("doc_id").cast("bigint"), (F.lit(False) if held_out is None else held_out).alias("held_out"), "text")
    return map_rows(rows, score, "doc_id bigint, held_out boolean, lang_pred string, score double")


def held_out_rule() -> Column:
    return crc_mod(F.col("doc_id"), 5) == 0
