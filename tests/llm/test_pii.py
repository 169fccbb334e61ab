"""Personal data against Python's own regular expressions, with code-point offsets."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from waybill.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple]:
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            hit, digits = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in hit.split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


CASES = [
    "a@b.c%x@d.e", "x@y.z@w.v", "..@a.b.", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "01.002.3.255 256.1.1.1", "5--1234",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4", "41111111111111111111111111", "+1 (551) 555-0826.", "+1+2 345 678 90 12",
    "+1 222 333 4444 +49 30 1234567 8", "日本 😀 a@b.cd 😀 +1 (551) 555-0826", "79927398713 799273987130 0000 0000 0000",
    "1 " * 5_000, "7" * 20_000, "a" * 20_000 + "@", "1." * 5_000, "+" * 3_000, "+1" + " " * 20_000, "a@b" + ".c" * 4_000,
]


def spans_of(frame):
    return {r.doc_id: [(s.start, s.rank, s.end, s.kind) for s in r.pii_spans] for r in pii.find(frame).collect()}


def test_base_spans(table):
    rng = random.Random(4)
    noise = ["".join(rng.choice("01234567890 .-+()@ab") for _ in range(400)) for _ in range(150)]
    rows = list(enumerate([*CASES, *noise]))
    got = spans_of(table(rows))
    for i, text in rows:
        assert [s for s in got[i] if s[3] in pii.BASE] == base_spans(text), text[:80]


def test_added_kinds_need_checksum_or_context(table):
    rows = [(1, "pay to GB82 WEST 1234 5698 7654 32 now"), (2, "GB82WEST12345698765432"), (3, "GB83WEST12345698765432"),
            (4, "SSN: 078-05-1120"), (5, "part 078-05-1120")]
    got = spans_of(table(rows))
    assert {i: [s[3] for s in v] for i, v in got.items()} == {1: ["iban"], 2: ["iban"], 3: [], 4: ["ssn"], 5: []}


def test_context_adjusts_the_score(table):
    rows = [(1, "call +1 (551) 555-0826"), (2, "given +1 (551) 555-0826"), (3, "version 1.2.3.4")]
    scores = {r.doc_id: r.pii_spans[0].score for r in pii.find(table(rows)).collect()}
    assert scores[1] > scores[2] and scores[3] < 0.5


def test_redaction_and_odd_rows(table, odd):
    rows = [(100, "write a@b.cd or +1 (551) 555-0826!"), (101, "no data"), *odd]
    frame = table(rows)
    clean = pii.redact(pii.find(frame, into="spans"), spans_col="spans")
    got = {(r.doc_id, r.text) for r in clean.collect()}
    assert got == {(100, "write [EMAIL] or [PHONE]!"), *((i, t) for i, t in rows if i != 100)}
    assert clean.count() == len(rows) and set(frame.columns) <= set(clean.columns)
    assert pii.find(frame.limit(0)).collect() == []


def test_native(spark, table):
    plan = pii.find(table([(1, "a@b.cd")])).select(F.size("pii_spans"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
