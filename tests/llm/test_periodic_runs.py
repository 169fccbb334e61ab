"""Periodic runs against a search of every lag and place."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from waybill.llm import periodic_runs
from waybill.llm.queries import repeated_tails
from waybill.llm.tokens import mix


def every_run(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 4 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= 6)


def mixed(rng):
    """Random words with stretches of many periods put in, some of them nearly periodic themselves."""
    v = rng.choice([1, 2, 3, 5, 30, 1000])
    words = [rng.randrange(v) for _ in range(rng.choice([0, 1, 5, 20, 60, 200, 500]))]
    for _ in range(rng.randrange(4)):
        p = rng.choice([1, 2, 3, 7, 8, 9, 10, 15, 16, 17, 30, 33, 50, 64, 65, 90])
        block = [rng.randrange(v) for _ in range(p)]
        if p > 4 and rng.random() < 0.4:
            block = [block[0]] * (p - 1) + [block[-1]]
        if p > 8 and rng.random() < 0.3:
            block = (block[:3] * p)[:p - 1] + [7]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (block * 8)[:rng.randrange(3 * p, 6 * p + 2)]
    return words


def test_runs_are_those_of_a_full_search():
    rng = random.Random(1)
    for _ in range(60):
        texts = [mixed(rng) for _ in range(6)]
        found = periodic_runs.runs_of([mix(np.array(t, np.uint64)) for t in texts])
        for words, runs in zip(texts, found):
            assert [tuple(r) for r in runs.tolist()] == every_run(words)


def test_words_without_a_period_but_with_many_repeats():
    thue = [0]
    while len(thue) < 512:
        thue += [1 - x for x in thue]
    one, two = [0], [0, 1]
    while len(two) < 900:
        one, two = two, two + one
    texts = [thue * 4, two, [0] * 300, [0] * 150 + [1] + [0] * 150]
    found = periodic_runs.runs_of([mix(np.array(t, np.uint64)) for t in texts])
    for words, runs in zip(texts, found):
        assert [tuple(r) for r in runs.tolist()] == every_run(words)


def by_hand(ident, text):
    words = (text or "").encode().split()
    n, h = len(words), None if ident is None else zlib.crc32(str(ident).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = every_run(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_over_odd_rows(spark, table, prose, odd, tmp_path):
    rng = random.Random(3)
    rows = [r for r in odd if r[0] not in (8, 9)] + [(10, "Word word " * 40), (11, "a b c " * 4), (12, "w" * 300_000), (13, "long " * 3000)]
    rows += [(20 + i, prose(i, rng.randrange(1, 300), rng.choice([2, 50, 2000]))) for i in range(60)]
    rows += [(90, "x\x0by\x1cz q  " * 9), (91, "the same again and again " * 300)]
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    from waybill.llm.queries import QUERIES

    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted([(r["doc_id"], *(r[c] for c in columns)) for r in found.collect()], key=str)
    assert got == sorted([(i, *by_hand(i, t)) for i, t in rows], key=str)
    assert {t for c, t in found.dtypes if c in columns[:5] + ["doc_id"]} == {"bigint"}


def test_collapsed_text_and_empty_table(spark, table):
    docs = table([(1, "one two three " * 5 + "end"), (None, None)])
    rows = {r["doc_id"]: r for r in periodic_runs.find(docs).collect()}
    assert rows[1]["collapsed"] == "one two three end" and [tuple(r) for r in rows[1]["runs"]] == [(0, 15, 3)]
    assert rows[None]["collapsed"] == "" and rows[None]["runs"] == []
    assert periodic_runs.find(docs.where(F.lit(False))).count() == 0


def test_long_text_beside_short_ones():
    rng = np.random.default_rng(5)
    long = rng.integers(0, 3000, 400_000).astype(np.uint64)
    long[100_000:300_000] = np.resize(long[100_000:140_000], 200_000)
    found = periodic_runs.runs_of([long, *[rng.integers(0, 9, 50).astype(np.uint64) for _ in range(300)]])
    assert (100_000, 200_000, 40_000) in [tuple(r) for r in found[0].tolist()]


def test_tails_change_a_tenth():
    tail, period = repeated_tails(list(range(5000)) + [None], np.full(5001, 100))
    assert 400 < (tail < 100).sum() < 600 and tail[-1] == 100 and (period > 0).all()
