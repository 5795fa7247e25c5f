"""Personal data by weak supervision (operator 6).

Four kinds (email, ip, card, phone) are found by fixed rules and always stay. Looser patterns propose further spans:
telephone numbers without a country code, written-out addresses ("ann at mail dot com"), national numbers, IBANs and
titled names. Labelers vote yes, no or nothing on every candidate, which are the spans of the rules, the matches that
the rules drop (an address with a part of 256, a number that fails its check digit) and the proposals: its form, a
checksum or range rule, a gazetteer, and cue words around it. How often each labeler is right is estimated by
expectation-maximisation over the counts of all vote patterns of the corpus, with a prior of each kind; a logistic
classifier of votes, form and context is then trained on the resulting probabilities, and proposals of at least
``threshold`` become spans. What a rule drops is voted on and learned from, but never a span of that kind.

The corpus pass gives one row per kind, votes, form and context (pre-aggregated); EM and training see those counts
only, so what reaches the driver is bounded by the number of such patterns, not by the documents.

Defined results: a null text is empty and has no spans; proposals that overlap a span of the rules or a proposal of an
earlier kind are dropped; without candidates the classifier accepts none. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import re
from hashlib import sha256
from typing import NamedTuple
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import DOCUMENT_SCHEMA, document_rows, map_rows

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]
#: What the classifier sees of a candidate.
PATTERN = ("kind", "votes", "form", "context")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches; the part before each @ reaches back to the last character that can't belong to it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def rule_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, kept) of what the rules match; of digits that aren't a card only those of a card's length."""
    out = [(*m, True) for m in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            out.append(("ip", m.start(), m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = re.sub("[^0-9]", "", m.group())
                if 14 <= len(digits) <= 19:
                    out.append(("card", m.start(), m.end(), luhn(digits)))
        if "+" in text:
            for m in PHONE.finditer(text):
                out.append(("phone", m.start(), m.end(), 10 <= sum(map(str.isdigit, m.group())) <= 15))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def base_spans(text: str) -> list[Span]:
    return [(k, s, e) for k, s, e, kept in rule_matches(text) if kept]


#: Loose patterns of further kinds, tried in this order where none of an earlier kind lies.
LOOSE = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "national": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "tel": re.compile(r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z-])"),
    "address": re.compile(r"(?<![A-Za-z0-9])[a-z0-9._-]{2,40} ?[\[(]? ?(?:at|AT) ?[\])]? ?[a-z0-9-]{2,40} ?[\[(]? ?(?:dot|DOT) ?[\])]? ?(?:com|org|net|edu|de|fr|es|io)(?![A-Za-z])"),
    "name": re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Madame|Monsieur)\.? [A-Z][a-zà-öø-ÿ]{1,20}(?: [A-Z][a-zà-öø-ÿ]{1,20})?(?![a-z])"),
}
EXTRA = tuple(LOOSE)
#: A pattern is tried only on texts that hold one of these.
NEEDS = {"address": ("dot", "DOT")}
#: Gazetteer and cue words, fixed values.
CUES = {
    "email": "mail email e-mail contact write reach correo courriel",
    "ip": "ip address host server addr client",
    "card": "card visa mastercard amex credit debit karte tarjeta carte",
    "phone": "tel phone call fax mobile cell telefon teléfono téléphone",
    "iban": "iban bank account konto cuenta compte",
    "national": "ssn social security number",
    "tel": "tel phone call fax mobile cell telefon teléfono téléphone",
    "address": "mail email e-mail contact write reach",
    "name": "dear contact from by signed name patient client",
}
AGAINST = frozenset("version isbn issue order invoice page section figure rev build id serial ticket".split())
GIVEN = frozenset("james john robert michael william david mary patricia jennifer linda anna maria jean pierre marie hans peter thomas juan jose carlos ana laura sofia".split())
COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
DOMAINS = frozenset("com org net edu gov info io de fr es it uk eu ch at".split())
CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 380 420 421".split())
LABELERS = ("form", "rule", "gazetteer", "cue", "against")
#: The least probability of a proposal that becomes a span.
THRESHOLD = 0.9


def vote(kind: str, text: str, start: int, end: int) -> str:
    """One character per labeler: + yes, - no, . nothing."""
    span, digits = text[start:end], re.sub("[^0-9]", "", text[start:end])
    before = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 40):start].lower())[-4:]
    if kind == "email":
        local, _, domain = span.partition("@")
        form, rule, listed = domain.rsplit(".", 1)[1].isalpha(), not (local.startswith(".") or local.endswith(".") or ".." in local), domain.rsplit(".", 1)[1].lower() in DOMAINS
    elif kind == "ip":
        parts = span.split(".")
        form, rule, listed = all(p == "0" or p[0] != "0" for p in parts), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts), None
    elif kind == "card":
        form, rule, listed = len(digits) in (15, 16), luhn(digits), digits[0] in "3456"
    elif kind == "phone":
        form, rule, listed = len(digits) < end - start - 1, 10 <= len(digits) <= 15, digits.startswith(CALLING)
    elif kind == "iban":
        compact = span.replace(" ", "")
        turned = "".join(str(int(c, 36)) for c in compact[4:] + compact[:4])
        form, rule, listed = len(compact) >= 15, int(turned) % 97 == 1, compact[:2] in COUNTRIES
    elif kind == "national":
        form, rule, listed = True, digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000", None
    elif kind == "tel":
        form, rule, listed = span[0] == "(" or "-" in span, digits[0] in "23456789" and digits[3] in "23456789", None
    elif kind == "address":
        form, rule, listed = "(" in span or "[" in span, None, any(w in span for w in ("mail", "yahoo", "outlook", "example"))
    else:
        words = span.lower().split()
        form, rule, listed = len(words) > 2, None, words[1] in GIVEN
    cue = any(w in CUES[kind].split() for w in before)
    against = any(w in AGAINST for w in before) or len(set(digits)) == 1
    mark = {True: "+", False: "-", None: "."}
    return mark[form] + mark[rule] + ("." if not listed else "+") + ("+" if cue else ".") + ("-" if against else ".")


def form_of(kind: str, span: str) -> str:
    """Shape of a span for the classifier: length step and marks inside."""
    return f"{min(len(span) // 6, 6)}{'(' in span:d}{' ' in span:d}{'-' in span:d}"


#: Classes of the word before a span that the classifier knows.
CONTEXT = 16


def context_of(text: str, start: int, end: int) -> int:
    """Class of the last word before a span, 0 without one, and whether a word follows at once."""
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 40):start].lower())
    return (1 + crc32(before[-1].encode()) % (CONTEXT - 1) if before else 0) + CONTEXT * (text[end:end + 1].isalnum())


class Candidate(NamedTuple):
    kind: str
    start: int
    end: int
    votes: str
    form: str
    context: int


def candidate(text: str, kind: str, start: int, end: int) -> Candidate:
    return Candidate(kind, start, end, vote(kind, text, start, end), form_of(kind, text[start:end]), context_of(text, start, end))


def proposals(text: str, taken: list[Span]) -> list[Candidate]:
    """The proposals that overlap nothing, by start: each kind's matches are swept along what lies there already."""
    used: list[tuple[int, int]] = []
    for _, s, e in sorted(taken, key=lambda t: t[1]):
        if used and s < used[-1][1]:
            used[-1] = (used[-1][0], max(e, used[-1][1]))
        else:
            used.append((s, e))
    out = []
    for kind, pattern in LOOSE.items():
        if kind in NEEDS and not any(w in text for w in NEEDS[kind]):
            continue
        new, i = [], 0
        for m in pattern.finditer(text):
            s, e = m.span()
            while i < len(used) and used[i][1] <= s:
                i += 1
            if i == len(used) or used[i][0] >= e:
                new.append((s, e))
                out.append(candidate(text, kind, s, e))
        used = sorted(used + new)
    return sorted(out, key=lambda c: c.start)


def candidates(text: str) -> list[Candidate]:
    """What the labelers vote on: all matches of the rules, kept or not, and the proposals."""
    found = rule_matches(text)
    return [candidate(text, k, s, e) for k, s, e, _ in found] + proposals(text, [(k, s, e) for k, s, e, kept in found if kept])


def reliabilities(patterns: list[tuple[str, str, int]], rounds: int = 50) -> dict[tuple[str, str], float]:
    """Probability of each (kind, votes): EM over the counts of all patterns.

    For each labeler the chances of yes and no on true and false candidates are estimated over all kinds, and for each
    kind the share of true ones; silence says nothing. Pseudo counts start from a labeler that is right four times in
    five and a kind that is half true, so that few candidates don't decide alone.
    """
    votes = np.array([[{"+": 1, "-": -1, ".": 0}[c] for c in v] for _, v, _ in patterns]).reshape(len(patterns), len(LABELERS))
    n = np.array([c for _, _, c in patterns], float)
    kinds, at = np.unique([k for k, _, _ in patterns], return_inverse=True)
    of_kind = np.bincount(at, n, len(kinds))
    p = 1 / (1 + np.exp(-1.4 * votes.sum(axis=1)))
    for _ in range(rounds):
        prior = (np.bincount(at, n * p, len(kinds)) + 5) / (of_kind + 10)
        odds = np.log(prior / (1 - prior))[at]
        for k in range(len(LABELERS)):
            yes, no = votes[:, k] == 1, votes[:, k] == -1
            right = (n[yes] @ p[yes] + 8) / (n[yes] @ p[yes] + n[no] @ p[no] + 10)
            wrong = (n[yes] @ (1 - p[yes]) + 2) / (n[yes] @ (1 - p[yes]) + n[no] @ (1 - p[no]) + 10)
            odds += yes * np.log(right / wrong) + no * np.log((1 - right) / (1 - wrong))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {(kind, v): float(x) for (kind, v, _), x in zip(patterns, p)}


def features(kind: str, votes: str, form: str, context: int) -> np.ndarray:
    names = (*KINDS, *EXTRA)
    x = np.zeros(1 + len(names) + 2 * len(LABELERS) + 10 + CONTEXT + 1)
    x[0] = x[1 + names.index(kind)] = 1
    at = 1 + len(names)
    for k, c in enumerate(votes):
        x[at + 2 * k + (c == "-")] = c != "."
    at += 2 * len(LABELERS)
    x[at + int(form[0])] = 1
    x[at + 7:at + 10] = [int(c) for c in form[1:]]
    x[at + 10 + context % CONTEXT] = 1
    x[at + 10 + CONTEXT] = context >= CONTEXT
    return x


def train(docs: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from the vote patterns of all documents; every kind weighs the same."""
    def work(c: dict) -> dict:
        found = [x for text in c["text"] for x in candidates((text or b"").decode("utf-8", "replace"))]
        return {n: [getattr(x, n) for x in found] for n in PATTERN}

    rows = map_rows(docs.select("text"), work, "kind string, votes string, form string, context int").groupBy(*PATTERN).count().collect()
    table = sorted((*[r[n] for n in PATTERN], r["count"]) for r in rows)
    dims = len(features(EXTRA[0], "." * len(LABELERS), "0000", 0))
    w = np.zeros(dims)
    w[0] = -9.0
    if not table:
        return w
    sums: dict[tuple[str, str], int] = {}
    of_kind: dict[str, int] = {}
    for k, v, _, _, n in table:
        sums[k, v] = sums.get((k, v), 0) + n
        of_kind[k] = of_kind.get(k, 0) + n
    p = reliabilities([(k, v, n) for (k, v), n in sums.items()])
    x = np.stack([features(*key) for *key, _ in table])
    y = np.array([p[k, v] for k, v, *_ in table])
    weight = np.array([n / of_kind[k] / len(of_kind) for k, *_, n in table])
    w = np.zeros(dims)
    for _ in range(2000):
        z = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 1.0 * (x.T @ (weight * (z - y)) + 1e-4 * w)
    return w


def probability(c: Candidate, w: np.ndarray) -> float:
    return 1 / (1 + np.exp(-float(features(c.kind, c.votes, c.form, c.context) @ w)))


def all_spans(text: str, w: np.ndarray, threshold: float = THRESHOLD) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans by start."""
    base = base_spans(text)
    more = [(c.kind, c.start, c.end) for c in proposals(text, base) if probability(c, w) >= threshold]
    return base, sorted(base + more, key=lambda s: (s[1], (*KINDS, *EXTRA).index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row."""
    def work(c: dict) -> dict:
        out = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in c["text"]:
            base, spans = all_spans((text or b"").decode("utf-8", "replace"), w)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
            out["base_sha256"].append(sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return out | {"doc_id": c["doc_id"]}

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), "text"), work,
                    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def replace_spans(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in brackets; overlapping ones by the first one's."""
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """The documents' columns with the spans in ``text`` replaced, and ``n_chars`` counted anew where a text changed."""
    def work(c: dict) -> dict:
        text, size = [], []
        for t, n in zip(c["text"], c["n_chars"]):
            new = t
            if t is not None:
                old = t.decode("utf-8", "replace")
                _, spans = all_spans(old, w)
                if spans:
                    new = replace_spans(old, spans)
                    n = len(new)
            text.append(new)
            size.append(n)
        return c | {"text": text, "n_chars": size}

    return map_rows(document_rows(docs), work, DOCUMENT_SCHEMA)
