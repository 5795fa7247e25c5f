"""Small cases of the training-data operators: brute force, round trips, nulls, ties, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, fingerprint, html_extract, language, mixing, neardup, pii, quality, repeats

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(seed: int, n: int) -> str:
    return " ".join(hashlib.md5(f"{seed}/{i}".encode()).hexdigest()[:3 + i % 5] for i in range(n))


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


LONG = prose(1, 4000)
TEXTS = [
    (1, prose(2, 120)), (2, prose(2, 120)), (3, prose(2, 118) + " other end"), (4, None), (5, ""), (6, "One two."), (7, LONG),
    (8, LONG[:9000] + prose(3, 30)), (None, prose(4, 40)), (None, None), (9, prose(5, 200)), (9, prose(5, 200)), (9, prose(6, 90)),
    (10, "aaaa " * 400), (11, "!!! ..."), (12, "!!! ..."), (13, prose(7, 60) + " " + prose(2, 80)[40:]), (14, "ünï cödé " * 90),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 2 else "de", None if k == 5 else f"s{k % 3}", None) for k, (i, t) in enumerate(TEXTS)]
    extra = {c: F.lit("x") for c in ("size", "hash", "rk", "did", "node", "label", "n", "score", "z", "doc", "block")}
    return spark.createDataFrame(rows, DOCS).withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_decontamination_against_brute_force(spark, docs, empty):
    items = [(1, prose(2, 14)), (1, prose(2, 14)), (2, "TWO"), (3, None), (4, "..."), (None, prose(5, 12)), (10, "cödé ünï")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(docs, bench).collect())
    expected = Counter()
    for doc_id, text in TEXTS:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for win in {tuple(v[i:i + 10]) for i in range(max(1, len(v) - 9))} if v else ():
                for at in range(len(w) - len(win) + 1):
                    if tuple(w[at:at + len(win)]) == win:
                        hit.update(range(at, at + len(win)))
                        found |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected[doc_id, len(w), len(hit), len(found), digest, bool(hit)] += 1
    assert got == expected
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_blocks_of_windows_give_the_same(spark, docs):
    bench = spark.createDataFrame([(1, prose(2, 30)), (2, prose(5, 30))], "item_id bigint, text string")
    windows = decontaminate.item_windows(bench, 10)
    found = [sorted((r.doc, r.win, r.start) for r in decontaminate.match(decontaminate.build_index(docs.filter("doc_id > 0"), windows, block), windows)
                    .filter("phrase").collect()) for block in (50_000, 7)]
    assert found[0] and found[0] == found[1]


def test_proximity_finds_words_out_of_order(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    rows = spark.createDataFrame([(1, "gamma x beta x alpha"), (2, "alpha beta gamma"), (3, "alpha " + "x " * 50 + "beta gamma")], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_items, r.n_near) for r in decontaminate.report(rows, bench, within=6).collect()}
    assert got == {1: (0, 1), 2: (1, 1), 3: (0, 0)}


def test_repeats_against_brute_force(docs, empty):
    texts = [(i, (t or "").encode()) for i, t in TEXTS]
    for length in (400, 40):
        seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
        expected = Counter()
        for doc_id, t in texts:
            covered = bytearray(len(t))
            for p in range(len(t) - length + 1):
                if seen[t[p:p + length]] > 1:
                    covered[p:p + length] = b"\1" * length
            kept = bytes(b for b, c in zip(t, covered) if not c)
            expected[doc_id, len(t), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest()] += 1
        got = Counter(tuple(r) for r in repeats.digest(repeats.remove_repeats(docs, length)).collect())
        assert got == expected
    assert repeats.remove_repeats(empty).count() == 0


def test_anchors_don_t_depend_on_pieces(monkeypatch):
    text = (LONG * 2).encode()
    whole = [x.tolist() for x in repeats.anchors(text, 40)]
    monkeypatch.setattr(repeats, "PIECE", 1 << 8)
    # the hash keeps fewer low bits for the place, so only coverage is compared
    pos, low, high, *_ = repeats.anchors(text, 40)
    starts = sorted(s for p, a, b in zip(pos, low, high) for s in range(p - b, p - a + 1))
    assert starts == list(range(len(text) - 39)) and len(set(pos.tolist())) == len(pos)
    assert sum(b - a + 1 for a, b in zip(whole[1], whole[2])) == len(text) - 39


def test_html(spark):
    head = "<html><head><title>T</title><script>if (a<b) x='</p>'</script></head><body><nav><a href=/>Home</a></nav>"
    article = "<div>Menu line</div><article><h1>A &amp; B</h1><p>one\n  two<br>three<p>four<aside>no</aside><div class='ad-box'>buy</div><div class=comments><p>nice</p></div></article>"
    pages = [(1, "http://h/a/1", head + article + "<footer>f</footer>"), (2, "http://h/a/2", head + "<div>Site</div><p>Own text</p><p>Shared</p>"),
             (3, "http://h/a/3", head + "<div>Site</div><p>Other text</p><p>Shared</p>"), (4, None, None), (5, "http://x/", ""), (6, "http://y/", "plain &lt;text&gt;"),
             (7, "http://h/a/0", head + article), (7, "http://h/a/0", head + article), (None, "http://h/a/9", "<p>x")]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("pair", F.lit(1))).collect()
    assert len(got) == len(pages)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[7] == "A & B\none two three\nfour"
    assert text[2] == "Own text" and text[3] == "Other text"
    assert (text[4], text[5], text[6], text[None]) == ("", "", "plain <text>", "x")
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_shared_lines_are_a_longest_common_subsequence():
    import random
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        in_a, in_b = html_extract.shared(a, b)
        assert [a[i] for i in sorted(in_a)] == [b[j] for j in sorted(in_b)] and len(in_a) == best[-1][-1]


def test_mixing_targets_and_limits(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.times <= 3 and r.taken == r.times * r.size for r in rows)
    sources = {r.source: (r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in sources.values()) - sum(s for s, _ in sources.values())) < 1e-6
    for source, (size, target) in sources.items():
        largest = max(r.size for r in rows if r.source == source)
        assert target <= 3 * size and abs(sum(r.taken for r in rows if r.source == source) - target) <= largest / 2 + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(empty).count() == 0


def test_quality_learns_form(spark, empty):
    rows = [(i, prose(i, 60).upper().replace(" ", "!! ") if i % 3 == 0 else prose(i, 60)) for i in range(240)] + [(None, None), (900, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(None, 1), (5, None), (5, 1)], "doc_id bigint, quality int")
    got = quality.assess(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert held and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    assert {r.score for r in quality.assess(docs, quality.train(docs, labels.limit(0))).collect()} == {1.0}
    assert quality.score_documents(empty, quality.train(docs, labels)).count() == 0


def test_factorisation_machine_identity():
    import numpy as np
    model = quality.FactorisationMachine(0.1, np.linspace(-1, 1, quality.DIMS), np.random.default_rng(0).normal(0, 0.1, (quality.DIMS, quality.FACTORS)))
    at, x = quality.vector(b"some words and some more words")
    pairs = sum(model.v[at[i]] @ model.v[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert abs(model.score(b"some words and some more words") - 1 / (1 + np.exp(-(0.1 + model.w[at] @ x + pairs)))) < 1e-6


def test_base_spans_are_those_of_the_rules():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for text in ("a@b.c_d@e.f", "x@@y.z a.b@c-d.e.f, @q.r", "ö.a@b.co", "me@x you@y.com@z.org", "no at all", "a@b.c@d.e"):
        assert pii.emails(text) == [("email", *m.span()) for m in email.finditer(text)]
    got = pii.base_spans("ip 10.0.0.255 not 1.2.3.256, card 4111 1111 1111 1111, tel +1 (830) 555-5433 x 4111111111111112")
    assert [k for k, _, _ in got] == ["ip", "card", "phone"]


def test_pii_adds_and_redacts(spark, empty):
    rows = [(1, "mail a@b.com or +49 30 1234567 now", None, None, 34), (2, None, "en", None, None), (3, "clean text, nothing here", None, None, 24)]
    rows += [(10 + i, f"call tel (212) 555-01{i:02d} today, iban DE89370400440532013000", None, None, 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    w = pii.train(docs)
    got = {r.doc_id: r for r in pii.find(docs, w).collect()}
    assert got[1].spans == "email:5:12,phone:16:30" and got[2].spans == got[3].spans == ""
    assert "tel:9:23" in got[10].spans and "iban:" in got[10].spans
    text = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs, w).collect()}
    assert text[1] == ("mail [EMAIL] or [PHONE] now", 27) and text[2] == (None, None) and text[3] == rows[2][1::3]
    assert pii.find(empty, w).count() == 0


def test_fingerprints(spark, docs, empty):
    ordered = sorted(((i, t or "") for i, t in TEXTS if i is not None and i not in (9,)), key=lambda x: x[0])
    rows = spark.createDataFrame(ordered, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprint.fingerprints(rows).collect()}
    for k, (i, t) in enumerate(ordered):
        other = ordered[(k + 1) % len(ordered)][1]
        changed = fingerprint.edited(t, other)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == fingerprint.written(fingerprint.tree(t))
        assert abs(got[i].near_next - fingerprint.likeness(fingerprint.read(got[i].fingerprint), fingerprint.tree(other))) < 1e-12
    assert got[1].fingerprint == got[2].fingerprint and got[1].near_next == 1
    assert fingerprint.fingerprints(docs).count() == len(TEXTS)
    assert fingerprint.fingerprints(empty).count() == 0
    a, b = fingerprint.tree("x.\n" * 40 + "old line\n" + "y.\n" * 40), fingerprint.tree("x.\n" * 40 + "new line\n" + "y.\n" * 40)
    assert fingerprint.differing(a, a) == [] and len(fingerprint.differing(a, b)) == 1


def test_near_duplicates_against_brute_force(docs, empty):
    def shingles(t):
        w = words(t)
        k = min(5, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()

    sets = [shingles(t) for _, t in TEXTS]
    label = list(range(len(TEXTS)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            alike = sum((a & b).values()) >= 0.8 * sum((a | b).values()) if a and b else TEXTS[i][1] == TEXTS[j][1] is not None or TEXTS[i] == TEXTS[j]
            if alike:
                label = [label[j] if x == label[i] else x for x in label]
    named = {x: min((TEXTS[i][0] for i in range(len(TEXTS)) if label[i] == x and TEXTS[i][0] is not None), default=None) for x in label}
    got = Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect())
    assert got == Counter((TEXTS[i][0], named[x]) for i, x in enumerate(label))
    kept = neardup.distinct_documents(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == len(set(label))
    assert neardup.classes(empty).count() == 0


def test_signatures_estimate_the_weighted_likeness():
    import numpy as np
    rng = np.random.default_rng(3)
    est, true = [], []
    for _ in range(60):
        e = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
        e.sort()
        a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
        x, y = neardup.signatures_of([(e, a), (e[100:], b[100:])])
        est.append((x == y).mean())
        true.append(neardup.overlap((e, a), (e[100:], b[100:])))
    assert abs(np.mean(est) - np.mean(true)) < 0.02


def test_language(spark, empty):
    alphabets = {"en": "the and of ing with", "de": "der und ich sch ung", "fr": "les eau que dans oi", "xx": "zzyx qwom uul"}
    rows = [(i, " ".join(alphabets[x].split()[(i * k) % len(alphabets[x].split())] for k in range(1, 12)), x) for i in range(60) for x in alphabets]
    rows = [(k, t, x) for k, (_, t, x) in enumerate(rows)] + [(900, None, "en"), (901, "12 !", "en"), (None, "the and of", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(docs, ~language.held_out_rule())
    got = {r.doc_id: r for r in language.identify(docs, model, language.held_out_rule()).collect()}
    assert all(got[k].lang_pred == x for k, _, x in rows[:240]) and got[900].lang_pred == got[901].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.train(empty, F.lit(True))).collect()} == {"und"}


def test_chat_round_trip(spark):
    texts = ["a\\b", "<|im_end|>\n", "x<\\|y\\\\<|", "", None, "plain $1"]
    rows = [(1, i, "user" if i < 3 else "assistant", t) for i, t in enumerate(texts)] + [(2, 0, "we\nird<|", "t"), (None, None, None, None), (3, 1, "user", "same"), (3, 1, "user", "same")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    out = chat.format_conversations(table).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    turns = {r.conv_id: [tuple(t) for t in r.turns] for r in out}
    assert turns[1] == [(role, t or "") for _, _, role, t in rows[:6]]
    assert turns[2] == [("we\nird<|", "t")] and turns[None] == [("", "")] and turns[3] == [("user", "same")] * 2
    one = next(r for r in out if r.conv_id == 1)
    assert "".join(s.text for s in one.segments) == one.formatted and one.formatted.count("<|im_start|>") == 2
    digest = {r.conv_id: r for r in chat.chat_digest(chat.format_conversations(chat.with_probe(table))).collect()}
    assert digest[1].loss_chars == 8 and digest[-1].n_turns == 2
    assert chat.format_conversations(table.limit(0)).count() == 0
