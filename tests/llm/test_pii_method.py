"""Personal data: base spans against the rules as written, the method against planted truth, very many proposals."""

from __future__ import annotations

import random
import re
import time

from strata.llm import pii

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def by_the_rules(text: str) -> list[tuple[str, int, int]]:
    def digits(m: re.Match) -> str:
        return re.sub("[^0-9]", "", m.group())

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    }
    found = [(k, m.start(), m.end()) for k, (pattern, keep) in rules.items() for m in re.finditer(pattern, text) if keep(m)]
    return sorted(found, key=lambda s: (s[1], list(rules).index(s[0])))


def test_base_spans_of_random_texts():
    draw = random.Random(7)
    parts = ["1", "4", "25", "256", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "x@y", "4111111111111111", "10.0.0.1", "+49 30 ", "555-4081", "é"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(1, 14)))
        assert pii.base_spans(text) == by_the_rules(text), text


def test_the_method_adds_what_the_rules_miss(spark):
    draw = random.Random(3)
    rows, truth, false = [], {}, {}
    for i in range(300):
        near = f"{draw.randrange(200, 999)}) {draw.randrange(200, 999)}-{draw.randrange(1000, 9999)}"
        kind = i % 5
        if kind == 0:
            text, span = f"Please call ({near} before noon", ("tel", 12, 12 + 1 + len(near))
        elif kind == 1:
            text, span = "our bank account DE89370400440532013000 is open", ("iban", 17, 39)
        elif kind == 2:  # a wrong check digit
            text, span = "order serial DE88370400440532013000 is open", ("iban", 13, 35)
        elif kind == 3:  # no such number
            text, span = f"order version {draw.randrange(100, 199)}.{draw.randrange(100, 199)}.{draw.randrange(1000, 9999)} is out", None
            span = ("tel", 14, 26)
        else:
            text, span = f"mail x{i}@mail.example.com, call +1 (826) 555-40{i % 90 + 10:02d}, card 4111 1111 1111 1111 or 10.0.{i % 200}.7", None
        rows.append((i, text, None, None, 0))
        if span:
            (false if kind in (2, 3) else truth)[i] = ":".join(map(str, span))
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert all(got[i].spans == s for i, s in truth.items())  # the rules alone find none of these
    assert not any(s in got[i].spans for i, s in false.items())
    assert not any(by_the_rules(rows[i][1]) for i in truth)
    for i, text, *_ in rows[4::5]:
        assert got[i].spans == pii.joined(by_the_rules(text)) and got[i].n_email == got[i].n_ip == got[i].n_card == got[i].n_phone == 1


def test_labelers_vote_on_kept_and_dropped_matches():
    found = {(c.kind, c.votes[:2]) for c in pii.candidates("ip 10.0.0.1 not 10.0.0.256, 4111111111111111 or 4111111111111112, +1 (826) 555-4081 190.137.223.20")}
    assert {("ip", "++"), ("ip", "+-"), ("card", "++"), ("card", "+-"), ("phone", "+-"), ("tel", "++")} <= found
    seen = pii.reliabilities([("ip", "++.+.", 200), ("ip", "+-...", 100), ("tel", "++...", 3), ("tel", "--..-", 40)])
    assert seen["ip", "++.+."] > 0.95 and seen["tel", "++..."] > 0.7 and seen["tel", "--..-"] < 0.1


def test_very_many_proposals_in_one_text():
    n = 100_000
    text = "a@b.co " + "tel (212) 555-0100 " * n
    start = time.process_time()
    found = pii.proposals(text, pii.base_spans(text))
    assert len(found) == n and found[0][:3] == ("tel", 11, 25)
    assert time.process_time() - start < 30  # linear: a second or two
