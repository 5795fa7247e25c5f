"""Operators 11, 12 and 13 against brute-force versions, and their edge cases."""

import math
from collections import Counter
from hashlib import sha256
from itertools import permutations
from zlib import crc32

import numpy as np
import pytest

from strata.llm import filter_audit, lm_score, queries, recurrent, vector_file

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, label_id bigint, e int"
LABELS = "doc_id bigint, quality int, toxic int, part string, n int"
VECTORS = "vec_id bigint, embedding array<double>, label int, cells string, key int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", 1, 7) for i, t, lang in rows], DOCS)


# -- 11 ---------------------------------------------------------------------------

LONG = " ".join(f"word{i}" for i in range(220))
ROWS = [(1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, "Short $ text", None), (4, "SHORT", ""), (5, None, "de"), (6, "", "de"),
        (None, LONG, "en"), (7, "a " * 300, "fr"), (8, "a " * 300, "de"), (9, LONG + " |", "en"), (None, "", "fr"), (10, "é b\x0bc\x85d", "fr")]
MARKS = [(1, 1, 0, "p", 1), (2, 0, 1, "p", 1), (2, 1, 0, "p", 1), (3, None, 1, "p", 1), (99, 1, 1, "p", 1), (None, 1, 1, "p", 1), (7, 1, None, "p", 1)]


def failures(rows):
    words = lambda t: [w for w in "".join(" " if c in "\x20\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    for i, t, lang in rows:
        t = t or ""
        w = words(t)
        yield (lang or ""), i, {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                                "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)}


def brute_audit(rows, marks):
    good = {i for i, q, _, _, _ in marks if i is not None and q == 1}
    toxic = {i for i, _, x, _, _ in marks if i is not None and x == 1}
    docs, out = list(failures(rows)), {}
    for part in {d[0] for d in docs}:
        own, total = [d for d in docs if d[0] == part], Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [d for d in left if d[2][f]]
                left = [d for d in left if not d[2][f]]
                total[f] += len(removed)
                out[part, "".join(order), step] = [f, len(left), len(removed), sum(d[2][f] for d in own) - len(removed),
                                                   sum(d[2][f] and sum(d[2].values()) == 1 for d in own), sum(d[1] in good for d in removed), sum(d[1] in toxic for d in removed)]
        for key in list(out):
            if key[0] == part:
                out[key].append(total[out[key][0]])
    return out


def test_audit_equals_brute_force(spark):
    got = filter_audit.audit(documents(spark, ROWS), spark.createDataFrame(MARKS, LABELS)).collect()
    assert len(got) == 600 * 4
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == brute_audit(ROWS, MARKS)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(documents(spark, []), empty).collect() == []
    assert len(filter_audit.audit(documents(spark, ROWS[:1]), empty).collect()) == 600


def test_text_on_a_third_of_the_rows(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "en") for i in range(600)]
    got = filter_audit.audit(documents(spark, rows), spark.createDataFrame([], LABELS)).filter("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r["kept"], r["removed"]) for r in got] == [(401, 199)]


def test_contraction_counts_selected_cells():
    tensor = np.random.default_rng(1).integers(0, 9, (1, 2, 2, 2, 2, 2))
    chosen = np.array([[filter_audit.PASS, filter_audit.FAIL, filter_audit.ALL, filter_audit.ALL, filter_audit.FAIL]])
    assert filter_audit.contract(tensor, chosen)[0, 0] == tensor[0, 0, 1, :, :, 1].sum()


# -- 12 ---------------------------------------------------------------------------

TEXTS = [(1, "The cat sat on the mat"), (2, "the DOG sat"), (3, None), (4, ""), (5, "É the\x0bcat x"), (None, "the end"), (6, "unseen words only"), (6, "unseen words only"),
         (7, "the cat " * 3000)] + [(i, "the cat sat on the mat and the dog sat too") for i in range(20, 60)]


def brute_base(rows):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = [crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)))
            for (i, t), h in zip(rows, held)]


@pytest.mark.parametrize("frequent", [lm_score.FREQUENT, 4])
def test_base_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_score.vocabulary, "__defaults__", (lm_score.WORDS, frequent))  # 4: nearly all words meet their counts in the join
    got = lm_score.scores(documents(spark, [(i, t, "en") for i, t in TEXTS])).collect()
    assert {r["score"] <= 0 for r in got} == {True}
    flat = lambda rows: sorted((*(x if x is not None else -1 for x in r[:5]), round(r[5], 6)) for r in rows)
    assert flat([tuple(r)[:6] for r in got]) == flat(brute_base(TEXTS))


def test_no_documents_and_none_to_learn_from(spark):
    assert lm_score.scores(documents(spark, [])).collect() == []
    held = next(i for i in range(99) if crc32(str(i).encode()) % 5 == 1)
    got = lm_score.scores(documents(spark, [(held, "a b", "en")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)]


def network(seed=1, n_words=64, shapes=3):
    counts = np.random.default_rng(seed).integers(1, 50, n_words + shapes + 1).astype(float)
    net = recurrent.Network.start(counts, n_words)
    rng = np.random.default_rng(seed)
    return counts, net.like(net.flat() + rng.normal(0, 0.3, net.flat().shape).astype(np.float32))


def test_untrained_network_is_the_unigram_model():
    counts, _ = network()
    net = recurrent.Network.start(counts, 64)
    doc = np.array([3, 60, 65, 1, 67])
    share = (counts + 0.5) / (counts + 0.5).sum()
    assert recurrent.score(net, [doc])[0] == pytest.approx(np.log(share[doc]).sum(), rel=1e-5)


def test_every_state_gives_a_distribution():
    _, net = network()
    hidden = np.random.default_rng(3).normal(0, 1, (1, recurrent.HIDDEN)).astype(np.float32)
    every = np.arange(68)
    assert np.exp(recurrent.log_probabilities(net, np.repeat(hidden, 68, axis=0), every)).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows():
    _, net = network()
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(0, 67, n), 67) for n in (0, 1, 5, 63, 64, 65, 700)]
    for doc, got in zip(docs, recurrent.score(net, docs)):
        h, total = np.zeros((1, recurrent.HIDDEN), np.float32), 0.0
        for t in doc:
            total += recurrent.log_probabilities(net, h, np.array([t]))[0]
            h = recurrent.step(net, h, net.inp[[t]])[0]
        assert got == pytest.approx(total, rel=1e-4)


def test_gradient_equals_differences():
    _, net = network()
    net = net.like(net.flat() * 1.0)
    tokens = np.random.default_rng(6).integers(0, 67, (4, 24))
    taken = {}

    class Spy(recurrent.Trainer):
        def adapt(self, name, grad, rows=slice(None)):
            whole = taken.setdefault(name, np.zeros(getattr(self.net, name).shape))
            whole[rows] += grad

    Spy(net).window(tokens, np.zeros((24, recurrent.HIDDEN), np.float32))

    def loss(n):
        h, total = np.zeros((24, recurrent.HIDDEN), np.float32), 0.0
        for t in tokens:
            total -= recurrent.log_probabilities(n, h, t).astype(np.float64).sum()
            h = recurrent.step(n, h, n.inp[t])[0]
        return total / max(1, tokens.size // recurrent.STEPS)

    for name, at in (("inp", (tokens[0, 0], 3)), ("rec", (2, 5)), ("rec", (1, 30)), ("cls", (4, 0)), ("word", (0, 7, 3)), ("cls_b", (1,))):
        up, down = net.like(net.flat()), net.like(net.flat())
        getattr(up, name)[at] += 1e-2
        getattr(down, name)[at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(taken[name][at], rel=0.05, abs=5e-3)


def test_training_beats_the_counts_on_held_out_documents(spark):
    got = queries.op12_lm_score(spark, "/root/testdata/sf0.01").filter("held_out").groupBy().sum("score", "base_score").collect()[0]
    assert got[0] > got[1]


# -- 13 ---------------------------------------------------------------------------

def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in first]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, own in members.items():
            centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    placed = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, c, d in placed:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in placed]


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", 1) for i, e in rows], VECTORS)


def in_order(rows):
    return sorted(rows, key=str)


def vector_rows(n, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.5, (5, 64))
    return [(int(i), (centres[i % 5] + rng.normal(0, 0.1, 64)).tolist()) for i in range(n)]


def test_clusters_equal_brute_force(spark):
    rows = vector_rows(150)
    rows += [rows[3], rows[3], (3, rows[4][1]), (None, rows[5][1]), (901, None), (902, [0.1] * 63), (903, [0.1] * 63 + [None]), (904, [float("nan")] * 64),
             (905, [float("inf")] + [0.0] * 63), (906, [0.0] * 64), (907, [-1e4] * 64), (908, [])]
    got = vector_file.clusters(vectors(spark, rows)).collect()
    assert in_order(tuple(r) for r in got) == in_order(brute_clusters(rows))


def test_few_vectors_and_ties(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(12)]
    assert in_order(tuple(r) for r in vector_file.clusters(vectors(spark, rows)).collect()) == in_order(brute_clusters(rows))
    assert vector_file.clusters(vectors(spark, [])).collect() == []


def test_components_beyond_the_limit_count_as_it(spark):
    got = vector_file.clusters(vectors(spark, [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)])).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in got) == [(1, 0), (2, 0), (3, 0)]


def test_cells_decide_only_what_is_so():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-200, 200, (40, 64))
    centroids[7] = centroids[3]
    v = np.concatenate([centroids[rng.integers(0, 40, 300)] + rng.integers(-20, 20, (300, 64)), rng.integers(-250, 250, (300, 64))])
    counts = {d: sorted(Counter(vector_file.bins_of(v[:, d]).tolist()).items()) for d in range(64)}
    cells = vector_file.Cells.fit(counts)
    packed = cells.encode(v)
    assert packed.shape[1] == 64 * vector_file.BITS // 8
    coded = cells.decode(packed)
    rows = np.arange(64)
    assert all((cells.low[rows, c] <= x).all() and (x <= cells.high[rows, c]).all() for x, c in zip(v, coded))
    found, truth = vector_file.place(coded, cells.lookup(centroids)), vector_file.squared(v, centroids).argmin(axis=1)
    decided = found >= 0
    assert (found[decided] == truth[decided]).all() and decided.mean() > 0.5


@pytest.mark.parametrize("b", [0, 1, 63, 64, 65, 200, vector_file.TOP_BIN])
def test_bins_hold_what_they_say(b):
    for sign in (1, -1):
        low, high = vector_file.bin_range(sign * b)
        assert vector_file.bins_of(np.array([low, high])).tolist() == [sign * b, sign * b]
