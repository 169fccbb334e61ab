"""The trained models: accuracy on held-out texts, whole texts, and what is counted."""

from __future__ import annotations

import collections
import math
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waybill.llm import lm_scoring, quality, tokens, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def words(text):
    return (text or "").encode().lower().split()


def test_hashes_name_words():
    texts = ["The  cat\nsat", "", None, "A", "  x y  ", "ab" * 200_000 + " z", "q the CAT", "é\x0bÉ", "w " * 150_000]
    found = tokens.words_of(pa.array(texts), 5, check=True)
    spelled = [w for t in texts for w in words(t)]
    assert np.diff(found.offsets).tolist() == [len(words(t)) for t in texts]
    for keys in (found.hashes, found.checks):
        names = {}
        assert all(names.setdefault(w, h) == h for w, h in zip(spelled, keys.tolist()))
        assert len(set(names.values())) == len(names)
    first = {}
    assert all(first.setdefault(w[:5], h) == h for w, h in zip(spelled, found.prefixes.tolist()))
    assert [found.data[a:b].tobytes().lower() for a, b in zip(found.first, found.last)] == spelled


@pytest.mark.parametrize("short", [True, False])
def test_shingles(short):
    texts = ["a b c d e", "a b c d", "", "a b", "x a b c d", "a  b"]
    shingles, ends = tokens.shingles_of(tokens.words_of(pa.array(texts)), 4, short_as_one=short)
    lists = [shingles[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert [len(x) for x in lists] == [2, 1, 0, int(short), 2, int(short)]
    assert lists[0][0] == lists[1][0] == lists[4][1] and lists[3] == lists[5]


def test_language_model(spark, table, odd, monkeypatch):
    # texts that follow rules a word count cannot know
    rng = random.Random(1)
    rows = list(odd)
    for i in range(400):
        side = rng.choice(["ab", "xy"])
        rows.append((100 + i, " ".join(f"{side}{k % 7}" for k in range(rng.randrange(10, 60)))))
    rows += [(1000 + i, f"rare{i} ab0 ab1 never{i}") for i in range(40)]
    frame = table(rows)
    monkeypatch.setattr(lm_scoring, "KNOWN", 50)  # so that many words go through the join
    got = lm_scoring.score(frame, F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))).collect()
    learned = [t for i, t in rows if i is None or i % 5]
    c = collections.Counter(w for t in learned for w in [*words(t), None])
    total, distinct = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in rows:
        own = [*words(t), None]
        base = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in own)
        want[i, len(own), sum(c[w] > 0 for w in own), total, round(base, 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.doc_id is not None and 100 <= r.doc_id < 1000 and r.doc_id % 5 == 0]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_language_model_learns_from_every_training_document(table, monkeypatch):
    rows = [(i, f"a{i} b{i}") for i in range(200)] + [(7, f"more {i}") for i in range(100)] + [(None, "no id"), (300, None)]
    seen = []

    def round_(docs, vocab, model):
        seen.append(sorted((r.text or "") for r in docs.collect()))
        return model

    monkeypatch.setattr(lm_scoring, "_round", round_)
    lm_scoring.score(table(rows), F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))).count()
    want = sorted(t or "" for i, t in rows if i is None or i % 5)
    assert len(seen) == 1 + lm_scoring.ROUNDS and all(s == want for s in seen[1:])


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    head = np.zeros(lm_scoring.HEAD, np.int64)
    head[:50], head[-1] = rng.integers(1, 99, 50), 7
    tails = rng.integers(1, 50, (lm_scoring.TAIL, 3))
    norm = (tails.sum(axis=1) + 3 + 1).astype(float)
    classes = np.concatenate([head.reshape(-1, lm_scoring.WIDTH).sum(axis=1), tails.sum(axis=1)])
    vocab = lm_scoring.Vocabulary(0, 0, 7, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), norm, head, classes)
    model = lm_scoring.Model.fresh(vocab)
    before = [3, lm_scoring.HEAD + 5]

    def gain(symbol):
        # what one more word costs, without the end mark that follows it
        lanes = lm_scoring.Lanes(np.array([*before, symbol], np.int32), np.array([0, 3]), 1)
        states, _, _ = lm_scoring.run_state(model, lanes.source, lanes.opens, np.zeros((1, lm_scoring.HIDDEN), np.float32), False)
        x = states[2]
        group = symbol // lm_scoring.WIDTH if symbol < lm_scoring.HEAD else symbol - lm_scoring.HEAD + lm_scoring.HEAD // lm_scoring.WIDTH
        p = np.exp(lm_scoring._log_softmax(x @ model.to_class + model.class_bias))[0, group]
        if symbol < lm_scoring.HEAD:
            return p * np.exp(lm_scoring._log_softmax(x @ model.to_word[group] + model.word_bias[group]))[0, symbol % lm_scoring.WIDTH]
        k = symbol - lm_scoring.HEAD
        return p * ((tails[k] + 1).sum() + 1) / norm[k]

    assert abs(sum(gain(s) for s in range(lm_scoring.HEAD + lm_scoring.TAIL)) - 1) < 1e-3


def test_windows_and_lanes_do_not_change_a_score(monkeypatch):
    rng = np.random.default_rng(2)
    vocab = lm_scoring.Vocabulary(0, 0, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32),
                                  np.ones(lm_scoring.TAIL), np.ones(lm_scoring.HEAD, np.int64), np.ones(lm_scoring._CLASSES, np.int64))
    model = lm_scoring.Model.fresh(vocab)
    sizes = [0, 1, 5, 333, 40, 64, 0, 7]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    symbols = rng.integers(0, lm_scoring.HEAD + lm_scoring.TAIL, offsets[-1]).astype(np.int32)
    whole = lm_scoring.log_likelihood(model, vocab, symbols, offsets)
    for lanes, window in ((1, 1000), (3, 5), (256, 1)):
        monkeypatch.setattr(lm_scoring, "LANES", lanes)
        monkeypatch.setattr(lm_scoring, "WINDOW", window)
        assert np.allclose(lm_scoring.log_likelihood(model, vocab, symbols, offsets), whole, rtol=1e-4)


def few_words(counts):
    total = np.concatenate([counts, np.zeros(lm_scoring.HEAD + lm_scoring.TAIL - len(counts), np.int64)])
    head = total[:lm_scoring.HEAD]
    classes = np.concatenate([head.reshape(-1, lm_scoring.WIDTH).sum(axis=1), total[lm_scoring.HEAD:]])
    return lm_scoring.Vocabulary(0, 0, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32),
                                 np.ones(lm_scoring.TAIL), head, classes)


def test_lanes_are_filled_from_several_batches(monkeypatch):
    """A long text of each small batch must not run alone: it runs beside those of the other batches."""
    vocab = few_words(np.ones(9, np.int64))
    steps = []
    run_state = lm_scoring.run_state

    def counted(model, source, *rest):
        steps.append(source.shape)
        return run_state(model, source, *rest)

    monkeypatch.setattr(lm_scoring, "run_state", counted)
    monkeypatch.setattr(lm_scoring, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [["a b " * 200, "c", None, "d e"] for _ in range(30)]
    batches = [pa.record_batch([pa.array(t, pa.string())], names=["text"]) for t in texts]
    found = list(lm_scoring._replica(SimpleNamespace(value=vocab), SimpleNamespace(value=lm_scoring.Model.fresh(vocab)), 0)(iter(batches)))
    assert found[0].column("words")[0].as_py() == 30 * (401 + 2 + 1 + 3)
    assert len(steps) == -(-401 // lm_scoring.TRAIN_WINDOW) and max(n for _, n in steps) == 120


def test_lanes_of_one_long_text_take_no_more_than_its_words():
    sizes = [400_000] + [50] * 300
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.arange(offsets[-1]).astype(np.int32) % 1000
    tracemalloc.start()
    lanes = lm_scoring.Lanes(symbols, offsets, 256)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * offsets[-1]  # 256 lanes of the longest text take 1.3 GB
    met = np.concatenate([np.stack([doc[target >= 0], target[target >= 0]]) for _, target, _, doc in lanes.windows(4096)], axis=1)
    order = np.argsort(met[0], kind="stable")
    counts = np.bincount(met[0])
    assert counts.tolist() == [n + 1 for n in sizes]
    assert sorted(met[1][met[0] == 0].tolist()) == sorted([*symbols[:400_000].tolist(), lm_scoring._END])
    assert sorted(met[1][order].tolist()) == sorted([*symbols.tolist(), *[lm_scoring._END] * len(sizes)])


def test_recurrence_is_that_of_a_plain_loop():
    """Lanes with several documents each, their states and outputs, against one word after the other."""
    rng = np.random.default_rng(7)
    vocab = few_words(rng.integers(1, 50, lm_scoring.HEAD + lm_scoring.TAIL))
    model = lm_scoring.Model.fresh(vocab)
    sizes = [0, 3, 17, 1, 40, 0, 6]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    symbols = rng.integers(0, lm_scoring.HEAD + lm_scoring.TAIL, offsets[-1]).astype(np.int32)
    size, width, groups = lm_scoring.HIDDEN, lm_scoring.WIDTH, lm_scoring.HEAD // lm_scoring.WIDTH

    def plain(text):
        h, last, total = np.zeros(size), lm_scoring._END, 0.0
        for y in [*text, lm_scoring._END]:
            x, u = model.inputs[last].astype(float), h @ model.state
            z, r = (1 / (1 + np.exp(-(x + u)[k * size:(k + 1) * size])) for k in (0, 1))
            new = np.tanh(x[2 * size:] + r * u[2 * size:])
            h = z * h + (1 - z) * new
            group = y // width if y < lm_scoring.HEAD else groups + y - lm_scoring.HEAD
            total += lm_scoring._log_softmax((h @ model.to_class + model.class_bias)[None])[0, group]
            if y < lm_scoring.HEAD:
                total += lm_scoring._log_softmax((h @ model.to_word[group] + model.word_bias[group])[None])[0, y % width]
            last = y
        return total / math.log(10)

    want = [plain(symbols[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    assert np.allclose(lm_scoring.log_likelihood(model, vocab, symbols, offsets), want, rtol=1e-4)


def test_gradients_of_lanes_with_several_documents(monkeypatch):
    monkeypatch.setattr(lm_scoring, "RATE", 0.0)
    monkeypatch.setattr(lm_scoring, "TRAIN_LANES", 2)
    rng = np.random.default_rng(5)
    vocab = few_words(np.ones(lm_scoring.HEAD + lm_scoring.TAIL, np.int64))
    offsets = np.cumsum([0, 3, 0, 4, 2, 1])
    symbols = rng.integers(0, lm_scoring.HEAD + lm_scoring.TAIL, 10).astype(np.int32)
    trainer = lm_scoring.Trainer(lm_scoring.Model.fresh(vocab))
    before = [s.copy() for s in trainer.seen]
    trainer.learn(symbols, offsets)
    squares = [s - b for s, b in zip(trainer.seen, before)]

    def loss():
        return -lm_scoring.log_likelihood(trainer.model, vocab, symbols, offsets).sum() * math.log(10) / 64

    rows = symbols[[0, 4, 8]].astype(int) * 3 * lm_scoring.HIDDEN
    for k, places in ((0, [r + c for r in rows for c in (0, 30, 60)]), (1, rng.choice(24 * 72, 8, replace=False)), (2, rng.choice(24 * 96, 8, replace=False))):
        flat, square = trainer.model.parts()[k].reshape(-1), squares[k].reshape(-1)
        for at in places:
            old, step = flat[at], 0.02
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            slope = (up - loss()) / (2 * step)
            flat[at] = old
            assert abs(slope**2 - square[at]) < 0.1 * slope**2 + 2e-6


def test_gradients(monkeypatch):
    """Backpropagation against differences of the loss."""
    monkeypatch.setattr(lm_scoring, "RATE", 0.0)
    rng = np.random.default_rng(3)
    vocab = lm_scoring.Vocabulary(0, 0, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32),
                                  np.ones(lm_scoring.TAIL), np.ones(lm_scoring.HEAD, np.int64), np.ones(lm_scoring._CLASSES, np.int64))
    offsets = np.array([0, 6])
    symbols = rng.integers(0, lm_scoring.HEAD + lm_scoring.TAIL, 6).astype(np.int32)
    trainer = lm_scoring.Trainer(lm_scoring.Model.fresh(vocab))
    before = [s.copy() for s in trainer.seen]
    trainer.learn(symbols, offsets)
    squares = [s - b for s, b in zip(trainer.seen, before)]

    def loss(model):
        return -lm_scoring.log_likelihood(model, vocab, symbols, offsets)[0] * math.log(10) / 64

    for k in (1, 2, 3):
        flat = trainer.model.parts()[k].reshape(-1)
        for at in rng.choice(len(flat), 8, replace=False):
            old, step = flat[at], 0.02
            flat[at] = old + step
            up = loss(trainer.model)
            flat[at] = old - step
            down = loss(trainer.model)
            flat[at] = old
            slope = (up - down) / (2 * step)
            assert abs(slope**2 - squares[k].reshape(-1)[at]) < 0.1 * slope**2 + 2e-6


def toxic_texts(n, seed):
    rng = random.Random(seed)
    bad = ["scumx", "idiotx", "clownx"]
    rows, labels = [], []
    for i in range(n):
        text = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(text) // 15):
                text[rng.randrange(len(text))] = rng.choice(bad)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark, table, odd):
    rows, labels = toxic_texts(900, 1)
    labels += [(None, 1, 1), (5, 1, 0), (7, 1, None)]
    frame = table([*rows, *((10_000 + (i or 0), t) for i, t in odd), (None, "scumx idiotx clownx scumx")])
    model = toxicity.train(frame, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 3 != 1)
    got = toxicity.score(frame, model).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 1]
    right = sum((r.toxicity.score >= 0.7) == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert len(got) == frame.count() and all(0 <= r.toxicity.score <= 1 for r in got)
    assert next(r for r in got if r.doc_id is None).toxicity.toxic
    # a text's score does not depend on what is scored beside it
    alone = toxicity.score(frame.where("doc_id in (4, 8)"), model).collect()
    assert {r.doc_id: round(r.toxicity.score, 5) for r in alone} == {r.doc_id: round(r.toxicity.score, 5) for r in got if r.doc_id in (4, 8)}


def plain_score(net, ids, n_words):
    """Of one text, word by word."""
    word = net.embedding[ids[0]] + net.embedding[ids[1]]
    pooled = []
    for f in net.filters:
        at = [sum(word[i + j] @ f[j] for j in range(len(f))) for i in range(n_words + 1)]
        n = max(-(-n_words // toxicity.PIECE), 1)
        cuts = [*range(0, n * toxicity.PIECE, toxicity.PIECE), n_words + 1]
        pooled.append([np.maximum(np.max(at[a:b], axis=0), 0) for a, b in zip(cuts, cuts[1:])])
    features = np.concatenate([np.max(p, axis=0) for p in pooled] + [np.mean(p, axis=0) for p in pooled])
    return 1 / (1 + np.exp(-(features @ net.weights + net.bias)))


def wide_network(seed):
    net = toxicity.Network.fresh(seed)
    net.embedding, net.weights = net.embedding.astype(float), net.weights.astype(float)
    net.filters = [f.astype(float) for f in net.filters]
    return net


def test_toxicity_is_scored_as_word_by_word():
    rng = random.Random(4)
    sizes = [0, 1, 63, 64, 65, 128, 129, 300]
    ids, ends = toxicity.word_ids(pa.array([" ".join(f"v{rng.randrange(200)}" for _ in range(n)) for n in sizes]))
    net = wide_network(2)
    net.weights = np.random.default_rng(3).normal(0, 0.3, len(net.weights))
    got = net.score(ids, ends, net.tables())
    for n, a, b, score in zip(sizes, ends, ends[1:], got):
        assert score == pytest.approx(plain_score(net, ids[:, a:b], n), rel=1e-4)


def test_toxicity_gradients():
    rng = random.Random(4)
    ids, ends = toxicity.word_ids(pa.array([" ".join(f"v{rng.randrange(50)}" for _ in range(n)) for n in (3, 64, 200, 70)]))
    net = wide_network(2)
    labels, weight = np.array([0, 1, 1, 0]), np.array([0.1, 0.4, 0.2, 0.3])

    def loss():
        p = net.score(ids, ends, net.tables())
        return -(weight * np.where(labels > 0, np.log(p), np.log(1 - p))).sum()

    # responses are rounded to single precision, so steps are not too small
    grads, bias, rows, moves = toxicity.gradients(net, ids, ends, (labels, weight))
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, rows, moves)
    row = int(rows[np.abs(moves).sum(axis=1).argmax()])
    checks = [(net.filters[k], (j, 3, int(np.abs(grads[k][j, 3]).argmax())), grads[k]) for k, j in ((0, 0), (1, 1), (2, 4))]
    checks += [(net.weights, (0,), grads[-1]), (net.weights, (30,), grads[-1]), (net.embedding, (row, 2), embedding)]
    for values, at, grad in checks:
        kept, step, around = values[at], 1e-4, []
        for sign in (1, -1):
            values[at] = kept + sign * step
            around.append(loss())
        values[at] = kept
        assert (around[0] - around[1]) / (2 * step) == pytest.approx(grad[at], rel=0.02, abs=2e-4)
    net.bias += 1e-4
    high = loss()
    net.bias -= 2e-4
    assert (high - loss()) / 2e-4 == pytest.approx(bias, rel=0.02, abs=2e-4)


def test_toxicity_is_told_by_the_beginnings_of_words():
    # inflected forms that no fitted text holds, of one marked beginning
    rng = random.Random(9)

    def text(marked):
        out = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(40, 150))]
        for _ in range(5 * marked):
            out[rng.randrange(len(out))] = f"achli{rng.randrange(10**9)}"
        return " ".join(out)

    labels = np.array([i % 5 == 0 for i in range(600)], np.float32)
    ids, ends = toxicity.word_ids(pa.array([text(y > 0) for y in labels]))
    texts = [ids[:, a:b] for a, b in zip(ends, ends[1:])]
    net = toxicity.fit(texts[:400], labels[:400])
    scores = net.score(ids, ends, net.tables())[400:]
    assert ((scores >= 0.7) == (labels[400:] > 0)).mean() >= 0.97
    # scores of other folds tell as much
    own = toxicity.out_of_fold(texts[:400], labels[:400])
    assert ((own >= 0.7) == (labels[:400] > 0)).mean() >= 0.97


def test_a_language_of_few_texts_is_not_set_by_one():
    scores = np.concatenate([np.full(99, 0.1), [0.98]])
    assert toxicity.calibrate(scores, np.zeros(100), ["es"] * 100) == {None: toxicity.FLOOR, "es": toxicity.FLOOR}
    assert toxicity.calibrate(np.array([0.9]), np.zeros(1), ["es"]) == {None: toxicity.FLOOR}


def test_thresholds_by_language():
    rng = np.random.default_rng(1)
    scores = np.concatenate([rng.uniform(0, 0.5, 400), rng.uniform(0.6, 0.9, 400), [0.95] * 10])
    labels = np.concatenate([np.zeros(800), np.ones(10)])
    got = toxicity.calibrate(scores, labels, ["en"] * 400 + ["de"] * 400 + [None] * 10)
    assert got["en"] == toxicity.FLOOR and 0.85 < got["de"] <= 0.99 and None in got


def test_thresholds_cover_texts_beyond_the_sample(spark, table, monkeypatch):
    rows, labels = toxic_texts(900, 1)
    # clean texts that look toxic, in documents longer than the sample takes
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 2_000)
    rows += [(2_000 + i, "w1 scumx idiotx clownx " + f"w{i} " * 700) for i in range(60)]
    labels += [(2_000 + i, 1, 0) for i in range(60)]
    model = toxicity.train(table(rows), spark.createDataFrame(labels, LABELS), F.col("doc_id") >= 0)
    assert model.thresholds["en"] > 0.9
    # the fitted texts do not count, all others do
    known = spark.createDataFrame(labels, LABELS)
    none = spark.createDataFrame([], "doc_id bigint, text_hash bigint")
    found = toxicity.clean_scores(table(rows), known, F.col("doc_id") >= 0, "toxic", model.network, none).to_pydict()
    assert sum(found["n"]) == sum(x == 0 for _, _, x in labels) and set(found["lang"]) == {"en"}


def test_training_samples_are_bounded(spark, table):
    # one labelled id holds many rows
    rows = [(i, f"w{i} x") for i in range(100)] + [(3, f"w{i} y") for i in range(600)] + [(3, "w z")] * 300
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(100)], LABELS)
    assert toxicity.sample(table(rows), labels, F.lit(True), "toxic", 60, 1_000).count() < 160


def test_no_labels(spark, table):
    frame = table([(1, "a b"), (2, None)])
    for labels in (spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 1, 0)], LABELS)):
        model = toxicity.train(frame, labels, F.lit(True))
        assert all(not r.toxicity.toxic for r in toxicity.score(frame, model).collect())
        net = quality.train(frame, labels, F.lit(True))
        assert all(r.quality_score > 0.5 for r in quality.score(frame, net).collect())
    assert toxicity.score(frame.limit(0), model).collect() == [] and quality.score(frame.limit(0), net).collect() == []


def test_quality(spark, table, odd, prose):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(800):
        good = i % 3 > 0
        text = prose(i, rng.randrange(5, 150)).replace("w", rng.choice("abcd"))
        if not good:
            text = " ".join(w + "!!" if rng.random() < 0.8 else w for w in text.upper().split(" "))
        rows.append((i, text))
        labels.append((i, int(good), 0))
    frame = table([*rows, *((10_000 + (i or 0), t) for i, t in odd)])
    net = quality.train(frame, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 5 != 0)
    got = quality.score(frame, net).collect()
    held = [r for r in got if r.doc_id < 800 and r.doc_id % 5 == 0]
    assert sum((r.quality_score >= 0.3) == (r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    assert len(got) == frame.count() and all(0 <= r.quality_score <= 1 for r in got)


def test_every_byte_lies_in_a_chunk():
    for n in (0, 1, 63, 64, 65, 255, 256, 257, 1_000, 4_096):
        _, segments = quality.padded(pa.array(["x" * n, "y"]))
        first, last, chunks = quality.chunk_edges(segments)
        own = slice(chunks[0], chunks[1])
        covered = {s for a, b in zip(first[own], last[own]) for s in range(a, b + 1)}
        assert covered == set(range(segments[0], segments[1])) and (segments[1] - segments[0]) * quality.SEGMENT > n
