"""Links between documents, passages and vectors against comparing everything with everything."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waybill.llm import components as comps, decontaminate, filters, jaccard_join, paragraphs, sampling, vector_dups


def joined(nodes, pairs):
    """Least member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edited(text, seed, changes):
    rng = random.Random(seed)
    words = text.split(" ")
    for k in range(changes):
        words[rng.randrange(len(words))] = f"e{seed}x{k}"
    return " ".join(words)


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(table, odd, prose, width, percent):
    base = prose(1, 120)
    rows = [*odd, *((100 + i, prose(50 + i, 60)) for i in range(30))]
    # near copies around the threshold, copies, and a passage that many share
    rows += [(200 + i, edited(base, i, i % 6)) for i in range(60)]
    rows += [(300 + i, prose(7, 90)) for i in range(40)]
    rows += [(400 + i, prose(8, 40) + " " + prose(900 + i, 6)) for i in range(40)]
    rows += [(500 + i, " ".join(prose(9, 30).split(" ")[:n])) for i, n in enumerate(range(1, 30))]
    random.Random(3).shuffle(rows)
    got = jaccard_join.similar_documents(table(rows), width=width, percent=percent).collect()
    sets = {k: shingle_set(t, width) for k, (_, t) in enumerate(rows)}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    of = joined(list(sets), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[of[k]] = min(least.get(of[k], i), i)
    want = sorted(((i is None, i or 0), len(sets[k]), None if i is None else least[of[k]] if sets[k] else i) for k, (i, _) in enumerate(rows))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_join_of_nothing(table):
    assert jaccard_join.similar_documents(table([]).limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(5000, i) for i in range(1, 200)]
    wild = [(rng.randrange(6000, 6200), rng.randrange(6000, 6200)) for _ in range(120)]
    edges = chain + star + wild + chain
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in comps.components(frame).collect()}
    proper = [(a, b) for a, b in edges if a != b]
    assert got == joined({n for e in proper for n in e}, proper)
    assert comps.components(frame.limit(0)).collect() == []


def test_filter_passes_all_keys_and_few_others(spark):
    keys = [random.Random(i).getrandbits(64) - (1 << 63) for i in range(5_000)]
    words = filters.key_filter(spark.createDataFrame([(k,) for k in [*keys, None]], "k bigint"), "k")
    own = np.array(keys, np.int64).view(np.uint64)
    assert len(filters.passes(words, own)) == len(own)
    others = np.random.default_rng(1).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    assert len(filters.passes(words, others)) < 200


def test_bounded_choices(spark):
    rows = spark.range(10_000).selectExpr("id", "id % 50 c")
    assert abs(sampling.hashed_sample(rows, "id", 1_000).count() - 1_000) < 150
    assert sampling.hashed_sample(rows.limit(10), "id", 1_000).count() == 10
    counts = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(500)], "w int, c int")
    top = sampling.most_counted(counts, "c", 100).collect()
    assert 30 < len(top) <= 100 and min(r.c for r in top) > 5


def test_bounded_choices_of_null_and_repeated_ids(spark):
    # null and repeated ids are dealt by their texts, repeated rows come once
    hot = spark.range(10_000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end id", "cast(id as string) text")
    hot = hot.unionByName(spark.range(5_000).selectExpr("cast(null as bigint) id", "'same' text"))
    chosen = sampling.hashed_sample(hot, "id", 1_000, "text")
    assert abs(chosen.count() - 1_000) < 150 and 200 < chosen.where("id is null").count() < 500
    assert sampling.hashed_sample(hot, "id", 1_000, "text", 15_000).count() < 1_000


def brute_overlap(doc, item, share, least):
    """The longest aligned stretch with enough equal words, by trying all."""
    best = 0
    for shift in range(-len(item), len(doc)):
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        for a in range(low, high):
            if doc[a + shift] != item[a]:
                continue
            equal = 0
            for b in range(a, high):
                same = doc[b + shift] == item[b]
                equal += same
                if same and equal * 1000 >= round(share * 1000) * (b - a + 1):
                    best = max(best, b - a + 1)
    return best if best >= min(least, len(item)) else 0


def test_decontamination(spark, table, odd, prose):
    items = [(k, prose(700 + k, 25 + k)) for k in range(8)] + [(8, prose(720, 9)), (9, None), (10, ""), (None, prose(721, 30)), (0, prose(700, 25))]
    docs = [*odd, *((100 + k, prose(800 + k, 60)) for k in range(20))]
    for k, (_, t) in enumerate(items[:9]):
        words = t.split(" ")
        docs.append((200 + k, prose(30 + k, 30) + " " + t.upper() + " " + prose(60 + k, 30)))
        docs.append((300 + k, prose(31 + k, 10) + "\n" + edited(t, k, 3) + " tail"))
        docs.append((400 + k, " ".join(words[:14]) + " " + prose(90 + k, 20)))
        docs.append((500 + k, prose(33 + k, 5) + " " + " ".join(words[:8])))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("key", F.lit(1))
    found = decontaminate.overlaps(table(docs), bench)
    got = {(r.doc_id, r.item_id): r.n_words for r in found.collect()}
    low = lambda t: (t or "").lower().split()
    want = {}
    for i, t in docs:
        for k, item in items:
            n = brute_overlap(low(t), low(item), 0.8, 13) if item and len(low(t)) < 500 else 0
            if n:
                want[i, k] = max(want.get((i, k), 0), n)
    # an item of fewer words than a mask spans is never hit, and so few words may lie between the substitutions of a seed
    missed = {p for p in want if p not in got}
    assert all(got[p] == want[p] for p in got) and len(missed) <= 0.05 * len(want), missed
    assert {p for p in want if p[0] // 100 in (2, 4)} <= set(got)


def test_overlaps_by_joins_only(table, spark, prose, monkeypatch):
    docs = table([(1, prose(1, 40) + " " + prose(2, 30)), (2, prose(3, 50))])
    bench = spark.createDataFrame([(7, prose(2, 30))], "item_id bigint, text string")
    small = decontaminate.overlaps(docs, bench).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    assert decontaminate.overlaps(docs, bench).collect() == small and [r.doc_id for r in small] == [1]
    assert decontaminate.overlaps(docs, bench.limit(0)).collect() == []
    assert decontaminate.overlaps(docs.limit(0), bench).collect() == []


def test_paragraphs_find_every_long_repeat(table, odd, prose):
    rows = [*odd]
    for k in range(40):
        passage = prose(2000 + k, 50 + k % 7)
        for copy in range(2 + k % 3):
            rows.append((100 * (k + 1) + copy, prose(3000 + 10 * k + copy, 20 + 3 * copy) + " " + passage + " " + prose(4000 + 10 * k + copy, 25)))
    clean = [(90_000 + k, prose(5000 + k, 150)) for k in range(40)]
    found = paragraphs.repeated(table(rows + clean))
    got = found.collect()
    # the long text of one repeated word is in one row only
    assert {r.doc_id for r in got} == {i for i, _ in rows if i is not None and i >= 100}
    firsts = {}
    for r in got:
        firsts.setdefault(r.cluster, []).append(r)
    assert all(sum(r.kept for r in rs) == 1 and len(rs) > 1 for rs in firsts.values())
    removed = paragraphs.removals(found).collect()
    assert {r.doc_id for r in removed} == {r.doc_id for r in got if not r.kept}
    assert all(r.n_words >= 1 for r in removed)


def test_bits_of_similar_paragraphs_differ_in_few_places(prose):
    # word changes near the edges, so that similarities on both sides of the limit occur; repeated words make smaller sets
    texts = []
    for k in range(400):
        words = (prose(50_000 + k, 30) if k % 3 else " ".join(prose(50_000 + k, 6).split() * 5)).split()
        other = [*words]
        for at in range(k % 4):
            other[at if k % 2 else -1 - at] = f"new{k}x{at}"
        texts += [" ".join(words), " ".join(other)]
    found = paragraphs.Paragraphs(pa.array(texts))
    assert found.text.tolist() == list(range(len(texts)))
    bits = found.bits(np.arange(len(found.at)))
    seen = set()
    for k in range(0, len(texts), 2):
        x, y = (found.shingles[found.at[j]:found.at[j] + paragraphs._SIZE] for j in (k, k + 1))
        near = paragraphs.close(x, y)
        seen.add(near)
        assert not near or sum(int(b[k] ^ b[k + 1]).bit_count() for b in bits) <= paragraphs._ALONE
    assert seen == {True, False}


def test_paragraphs_near_copies(table, prose):
    passage = prose(1, 200)
    rows = [(i, prose(10 + i, 30) + " " + edited(passage, i, 4) + " " + prose(60 + i, 30)) for i in range(30)]
    assert {r.doc_id for r in paragraphs.repeated(table(rows)).collect()} == set(range(30))
    assert paragraphs.repeated(table([]).limit(0)).collect() == []


def test_paragraphs_moved_by_a_few_words_in_other_documents(table, prose):
    rows, wanted = [], set()
    for k in range(300):
        passage = prose(6000 + k, 36)
        pair = [(10 * k + c, prose(7000 + 10 * k + c, 40) + " " + passage + " " + prose(8000 + 10 * k + c, 40)) for c in (1, 2)]
        found = paragraphs.Paragraphs(pa.array([t for _, t in pair]))
        contents = [set(found.content[found.text == t].tolist()) for t in (0, 1)]
        bands = [set(found.bands[:, found.text == t].ravel().tolist()) for t in (0, 1)]
        runs = [[found.shingles[a:a + paragraphs._SIZE].tolist() for a in found.at[found.text == t]] for t in (0, 1)]
        near = [(x, y) for x in runs[0] for y in runs[1] if 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y})]
        moved = all(any(x[k:] == y[:-k] or y[k:] == x[:-k] for k in (1, 2)) for x, y in near)
        if near and moved and bands[0] & bands[1] and not contents[0] & contents[1]:
            rows += pair
            wanted |= {i for i, _ in pair}
    # neighbours in one text, or in a text and its copies, are no repeats of each other
    alone = [(50_000 + k, prose(20_000 + k, 400)) for k in range(20)]
    twice = [(60_000 + k, prose(30_000, 400)) for k in range(3)]
    got = paragraphs.repeated(table(rows + alone + twice)).collect()
    assert len(wanted) > 5 and len(wanted - {r.doc_id for r in got}) <= 0.1 * len(wanted)
    assert not {r.doc_id for r in got} & {i for i, _ in alone}
    clusters = {}
    for r in got:
        if r.doc_id >= 60_000:
            clusters.setdefault(r.cluster, []).append(r.start)
    assert clusters and all(len(s) == 3 and len(set(s)) == 1 for s in clusters.values())


def brute_vectors(rows, threshold):
    ok = {k: np.array(v, float) for k, (_, v, label) in enumerate(rows)
          if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {k: 0 for k in range(len(rows))}
    pairs = []
    for a, b in combinations(ok, 2):
        if rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]):
            cos = ok[a] @ ok[b] / (np.sqrt(ok[a] @ ok[a]) * np.sqrt(ok[b] @ ok[b]))
            if cos >= threshold:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    return links, joined(range(len(rows)), pairs)


@pytest.mark.parametrize("block", [2_048, 7])
def test_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(vector_dups, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(60):
        rows.append((k, rng.normal(0, 1, 16), k % 3))
    for k in range(60):  # about the threshold
        rows.append((100 + k, rows[k % 6][1] + rng.normal(0, 0.045, 16), k % 6 % 3))
    rows += [(200 + k, rows[0][1], 0) for k in range(15)] + [(300, rows[0][1] * 1e30, 0), (301, rows[0][1] * 1e-30, 0), (302, rows[0][1], 1)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, [float("inf")] * 16, 0),
             (405, [None] * 16, 0), (406, rows[0][1], None), (407, rows[0][1][:8], 0), (408, [-0.0, 1.0], 2), (409, [0.0, 1.0], 2), (None, rows[0][1], 0), (0, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3).withColumn("class", F.lit(1))
    got = vector_dups.links(frame).collect()
    links, of = brute_vectors(rows, 0.98)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[of[k]] = min(least.get(of[k], i), i)
    key = lambda i: (i is None, i or 0)
    want = sorted((key(i), links[k], None if i is None else least[of[k]]) for k, (i, _, _) in enumerate(rows))
    assert sorted((key(r.vec_id), r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vector_dups.links(frame.limit(0)).collect() == []
