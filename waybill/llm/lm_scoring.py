"""Log-likelihood of whole documents under a gated recurrent language model.

Words are counted over all training documents. The ``HEAD`` - 1 most frequent words and the end mark are predicted one by one;
every other word falls in one of ``TAIL`` classes by its last two bytes. The output softmax is factored: classes first (the
head in classes of ``WIDTH`` words of similar frequency, and the tail's), then the word within its class: by a learned softmax
in the head, by add-one counts in the tail. Probabilities of all words, and of one unseen word per class, sum to one.

A gated recurrent unit runs over the words of a document from its first to its last; many documents run side by side, and the
state is carried from window to window, so long texts are scored whole; memory holds a number for each of their words. It is trained in numpy by truncated
backpropagation: a first model on a bounded sample (``WARM_DOCS`` documents), then, in ``ROUNDS`` rounds, one replica per
partition of all training documents; the replicas' weights are averaged by their numbers of words. Every training document
is counted and learned from.

The model, the counts of at most ``KNOWN`` frequent words and 64 class totals are broadcast. Words beyond them go through a
join with the table of all counts; each adds the same term to the model's score and to that of the base.

Null and empty texts consist of the end mark. Rows come back one to one, repeated rows included. Without training documents
all counts are 0.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .chunks import slices
from .sampling import hashed_sample, most_counted
from .tokens import words_of

HEAD, WIDTH, TAIL = 2048, 64, 64
HIDDEN = 24
KNOWN = 1 << 16
ROUNDS, WARM_DOCS = 1, 1_500
LANES, WINDOW = 256, 32
TRAIN_LANES, TRAIN_WINDOW = 128, 16
RATE = 0.08
_GROUPS = HEAD // WIDTH
_CLASSES = _GROUPS + TAIL
_END = HEAD - 1
_COUNTED = 1 << 21
_SLICE = 8 << 20
_CHUNK = 1 << 14
_TOKENS = 1 << 22  # words whose texts run side by side: batches are gathered up to it, or a few lanes hold the longest texts alone
_THREE = np.arange(3, dtype=np.int32)[:, None]  # gates
_GROUP_OF = np.concatenate([np.arange(HEAD) // WIDTH, _GROUPS + np.arange(TAIL)]).astype(np.uint8)


def tail_class(tails: np.ndarray) -> np.ndarray:
    return ((tails.astype(np.uint32) * np.uint32(40503)) >> np.uint32(7)).astype(np.int32) % TAIL


@dataclass(frozen=True)
class Vocabulary:
    total: int  # training words and end marks
    distinct: int
    end_count: int
    keys: np.ndarray  # of the known words, sorted
    counts: np.ndarray
    symbols: np.ndarray  # of the known words: place in the head, or HEAD + class
    class_norm: np.ndarray  # per tail class: count of its words, of its different words, and 1
    head_counts: np.ndarray
    class_counts: np.ndarray

    def symbols_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts' words: symbol, count (-1: not among the known words), hash; and where each text begins."""
        words = words_of(column)
        which, keys = pd.factorize(words.hashes)
        count = np.full(len(keys), -1, np.int64)
        symbol = np.zeros(len(keys), np.int32)
        if len(self.keys) and len(keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            met = self.keys[at] == keys
            count[met], symbol[met] = self.counts[at[met]], self.symbols[at[met]]
        symbol, count = symbol[which], count[which]
        rest = count < 0
        symbol[rest] = HEAD + tail_class(words.tails[rest])
        return symbol, count, words.hashes, words.offsets


def count_words(docs: DataFrame) -> DataFrame:
    """(word, class, c) over all texts, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, classes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(words.view(np.int64)), pa.array(classes), pa.array(counts)], names=["word", "class", "c"])

        for batch in slices(batches, "text", _SLICE):
            found = words_of(batch.column("text"))
            which, keys = pd.factorize(found.hashes)
            n = np.bincount(which, minlength=len(keys))
            kind = np.zeros(len(keys), np.int32)
            kind[which] = tail_class(found.tails)
            which, merged = pd.factorize(np.concatenate([words, keys]))
            total = np.zeros(len(merged), np.int64)
            np.add.at(total, which, np.concatenate([counts, n]))
            kinds = np.zeros(len(merged), np.int32)
            kinds[which] = np.concatenate([classes, kind])
            words, counts, classes = merged, total, kinds
            if len(words) > _COUNTED:
                yield out()
                words, counts, classes = words[:0], counts[:0], classes[:0]
        if len(words):
            yield out()

    parts = docs.select("text").mapInArrow(run, "word bigint, class int, c bigint")
    return written(parts.groupBy("word").agg(F.max("class").alias("class"), F.sum("c").alias("c")), "word-counts")


def vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    top = most_counted(counts, "c", KNOWN).toPandas().sort_values(["c", "word"], ascending=[False, True])
    keys = top["word"].to_numpy().view(np.uint64) if len(top) else np.zeros(0, np.uint64)
    c, kind = top["c"].to_numpy(np.int64), top["class"].to_numpy(np.int32)
    head = min(len(keys), HEAD - 1)
    symbols = HEAD + kind
    symbols[:head] = np.arange(head)
    totals = counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    words, different = np.zeros(TAIL, np.int64), np.zeros(TAIL, np.int64)
    for row in totals:
        words[row["class"]], different[row["class"]] = row["c"], row["n"]
    total, distinct = int(words.sum()) + documents, int(different.sum()) + (documents > 0)
    np.subtract.at(words, kind[:head], c[:head])
    np.subtract.at(different, kind[:head], 1)
    head_counts = np.zeros(HEAD, np.int64)
    head_counts[:head], head_counts[_END] = c[:head], documents
    order = np.argsort(keys)
    classes = np.concatenate([head_counts.reshape(_GROUPS, WIDTH).sum(axis=1), words])
    return Vocabulary(total, distinct, documents, keys[order], c[order], symbols[order], (words + different + 1).astype(np.float64), head_counts, classes)


@dataclass
class Model:
    """Weights; ``inputs`` holds the gates' share of each symbol, so a word's input is one row."""

    inputs: np.ndarray
    state: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    NAMES = ("inputs", "state", "to_class", "class_bias", "to_word", "word_bias")

    @classmethod
    def fresh(cls, vocab: Vocabulary, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        part = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        head = np.log(vocab.head_counts.reshape(_GROUPS, WIDTH) + 0.5)
        return cls(
            part(0.3, HEAD + TAIL, 3 * HIDDEN), part(0.2, HIDDEN, 3 * HIDDEN), part(0.1, HIDDEN, _CLASSES),
            np.log(vocab.class_counts + 1.0).astype(np.float32), part(0.1, _GROUPS, HIDDEN, WIDTH), head.astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def packed(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def unpacked(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Model(*out)


def _by_gate(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))


def _gate(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _bounded(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state, its values lying between -1 and 1, can take an output beyond what ``exp`` holds."""
    return bool((np.abs(weights).sum(axis=-2) + np.abs(bias)).max() < 80)


class Lanes:
    """Documents side by side: each lane holds documents one after the other, the lanes from longest to shortest.

    The lanes' words lie one lane after the other, behind an end mark each, and only windows of them are laid side by side.
    """

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray, lanes: int) -> None:
        sizes = np.diff(offsets) + 1  # and the end mark
        order = np.argsort(-sizes, kind="stable")
        n = max(1, min(lanes, len(sizes)))
        load = [(0, k) for k in range(n)]
        own: list[list[int]] = [[] for _ in range(n)]
        for i in order.tolist():
            length, k = heapq.heappop(load)
            own[k].append(i)
            heapq.heappush(load, (length + int(sizes[i]), k))
        lengths = np.array([sum(int(sizes[i]) for i in docs) for docs in own])
        rank = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[rank]
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.text = np.full(int(lengths.sum()) + n, _END, np.uint16)
        self.doc = np.zeros(len(self.text), np.int32)
        self.first = np.zeros(len(self.text), bool)  # the place before a document's first word
        for k, at in zip(rank.tolist(), self.starts.tolist()):
            for i in sorted(own[k]):  # as they came, long and short mixed
                to = at + int(sizes[i])
                self.text[at + 1:to] = symbols[offsets[i]:offsets[i + 1]]
                self.doc[at:to] = i
                self.first[at] = True
                at = to

    def window(self, at: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the lanes that are not at their end, steps as rows: symbol before, symbol (-1: none), opens a document, document."""
        n = int((self.lengths > at).sum())
        steps = np.arange(at, min(at + width, int(self.lengths[0])))[:, None]
        live = steps < self.lengths[:n]
        place = np.where(live, self.starts[:n] + steps, 0)
        target = np.where(live, self.text[place + live], np.int32(-1))
        return np.where(live, self.text[place], np.uint16(_END)), target, self.first[place] & live, self.doc[place]

    def windows(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, int(self.lengths[0]), width):
            yield self.window(at, width)

    @property
    def source(self) -> np.ndarray:
        return self.window(0, int(self.lengths[0]))[0]

    @property
    def opens(self) -> np.ndarray:
        return self.window(0, int(self.lengths[0]))[2]


def run_state(model: Model, source: np.ndarray, opens: np.ndarray, h: np.ndarray, keep: bool) -> tuple:
    """States after each step of a window, the last, and for backpropagation: states before, gates, their recurrent share."""
    steps, lanes = source.shape
    out = np.empty((steps + 1, lanes, HIDDEN), np.float32)
    out[0] = h
    gates = model.inputs.reshape(-1, HIDDEN).take(source[:, None].astype(np.int32) * 3 + _THREE, axis=0)
    state = _by_gate(model.state)
    shares = np.empty((steps if keep else 1, 3, lanes, HIDDEN), np.float32)
    some = opens.any(axis=1).tolist()
    part = np.empty((lanes, HIDDEN), np.float32)
    with np.errstate(over="ignore"):
        for t in range(steps):
            before, after, u = out[t], out[t + 1], shares[t if keep else 0]
            if some[t]:
                before = before * ~opens[t][:, None]
            both, new = gates[t, :2], gates[t, 2]
            np.matmul(before, state, out=u)
            both += u[:2]
            _gate(both)
            np.multiply(both[1], u[2], out=part)
            new += part
            np.tanh(new, out=new)
            np.subtract(before, new, out=after)
            after *= both[0]
            after += new
    before = None
    if keep:
        before = out[:-1].copy()
        before[opens] = 0
    return out[1:], out[-1], (before, gates, shares)


class Outputs:
    """Of a window's live words, in order of their class: states, and both softmaxes before they are normed."""

    def __init__(self, model: Model, states: np.ndarray, target: np.ndarray) -> None:
        self.live = np.flatnonzero(target.ravel() >= 0)
        y = target.ravel()[self.live]
        group = _GROUP_OF[y]
        order = np.argsort(group, kind="stable")
        self.live, self.y, self.group = self.live[order], y[order], group[order]
        self.x = states.reshape(-1, HIDDEN).take(self.live, axis=0)
        self.cuts = np.searchsorted(self.group, np.arange(_GROUPS + 1)).tolist()
        self.heads = self.cuts[-1]
        self.within = self.y[:self.heads] % WIDTH
        self.rows = np.arange(len(y))
        self.classes = self.x @ model.to_class
        self.classes += model.class_bias
        self.words = np.empty((self.heads, WIDTH), np.float32)
        for g in range(_GROUPS):
            own = slice(self.cuts[g], self.cuts[g + 1])
            if own.start < own.stop:
                np.matmul(self.x[own], model.to_word[g], out=self.words[own])
                self.words[own] += model.word_bias[g]
        if not _bounded(model.to_class, model.class_bias):
            self.classes -= self.classes.max(axis=1, keepdims=True)
        if not _bounded(model.to_word, model.word_bias):
            self.words -= self.words.max(axis=1, keepdims=True)

    def values(self) -> np.ndarray:
        """Log probabilities of the words, of tail words that of their class."""
        value = self._logs(self.classes, self.rows, self.group)
        value[:self.heads] += self._logs(self.words, self.rows[:self.heads], self.within)
        return value

    @staticmethod
    def _logs(x: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        own = x[rows, chosen].astype(np.float64)
        np.exp(x, out=x)
        return own - np.log(x @ np.ones(x.shape[1], np.float32))

    def errors(self, scale: np.float32) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both softmaxes' inputs."""
        for x, rows, chosen in ((self.classes, self.rows, self.group), (self.words, self.rows[:self.heads], self.within)):
            np.exp(x, out=x)
            x *= (scale / (x @ np.ones(x.shape[1], np.float32)))[:, None]
            x[rows, chosen] -= scale
        return self.classes, self.words


def log_likelihood(model: Model, vocab: Vocabulary, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's log10 probability, without the counts of its tail words."""
    lanes = Lanes(symbols, offsets, LANES)
    sums = np.zeros(len(offsets) - 1)
    h = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
    tail = -np.log(vocab.class_norm)
    for source, target, opens, doc in lanes.windows(WINDOW):
        states, h, _ = run_state(model, source, opens, h[:source.shape[1]], False)
        found = Outputs(model, states, target)
        value = found.values()
        value[found.heads:] += tail[found.y[found.heads:] - HEAD]
        np.add.at(sums, doc.ravel()[found.live], value)
    return sums / np.log(10)


class Trainer:
    """Truncated backpropagation with adaptive steps; lanes run side by side and carry their states on."""

    def __init__(self, model: Model) -> None:
        self.model = Model(*[p.copy() for p in model.parts()])
        self.seen = [np.full(p.shape, 0.02, np.float32) for p in model.parts()]
        self.spare = [np.empty((2, *p.shape), np.float32) for p in model.parts()[1:]]  # gradients and steps
        self.words = 0

    def learn(self, symbols: np.ndarray, offsets: np.ndarray) -> None:
        lanes = Lanes(symbols, offsets, TRAIN_LANES)
        h = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
        for source, target, opens, _ in lanes.windows(TRAIN_WINDOW):
            h = self.step(source, target, opens, h[:source.shape[1]])
        self.words += int(offsets[-1]) + len(offsets) - 1

    def step(self, source: np.ndarray, target: np.ndarray, opens: np.ndarray, h: np.ndarray) -> np.ndarray:
        m = self.model
        states, last, saved = run_state(m, source, opens, h, True)
        found = Outputs(m, states, target)
        to_state, to_class, class_bias, to_word, word_bias = grads = [g for g, _ in self.spare]
        x = found.x
        d, e = found.errors(np.float32(1 / 64))
        ones = np.ones(len(d), np.float32)
        dx = d @ m.to_class.T
        np.matmul(x.T, d, out=to_class)
        np.matmul(ones, d, out=class_bias)
        dx_words = np.empty((found.heads, HIDDEN), np.float32)
        for g in range(_GROUPS):
            own = slice(found.cuts[g], found.cuts[g + 1])
            if own.start < own.stop:
                errors = e[own]
                np.matmul(x[own].T, errors, out=to_word[g])
                np.matmul(ones[own], errors, out=word_bias[g])
                np.matmul(errors, m.to_word[g].T, out=dx_words[own])
            else:
                to_word[g], word_bias[g] = 0, 0
        dx[:found.heads] += dx_words
        d_states = np.zeros((source.size, HIDDEN), np.float32)
        d_states[found.live] = dx
        moved = self._back(d_states.reshape(*source.shape, HIDDEN), opens, saved, to_state)
        lanes = source.shape[1]
        flat = source.ravel()
        order = np.argsort(flat, kind="stable")
        met = flat[order]
        first = np.flatnonzero(np.concatenate([[True], met[1:] != met[:-1]]))
        rows = met[first]
        place = (order + order // lanes * (2 * lanes))[:, None] + np.arange(3) * lanes
        each = moved.reshape(-1, HIDDEN).take(place, axis=0).reshape(-1, 3 * HIDDEN)
        moved = np.add.reduceat(each, first, axis=0)
        np.clip(moved, -1, 1, out=moved)
        seen = self.seen[0][rows]
        seen += moved**2
        self.seen[0][rows] = seen
        moved *= RATE
        moved /= np.sqrt(seen)
        m.inputs[rows] -= moved
        for p, s, (g, step) in zip(m.parts()[1:], self.seen[1:], self.spare):
            np.clip(g, -1, 1, out=g)
            np.multiply(g, g, out=step)
            s += step
            np.sqrt(s, out=step)
            np.divide(g, step, out=step)
            step *= RATE
            p -= step
        return last

    def _back(self, dh: np.ndarray, opens: np.ndarray, saved: tuple, to_state: np.ndarray) -> np.ndarray:
        """Gradients of the gates' inputs, from those of the states, to which what flows back is added; that of ``state`` is set."""
        before, gates, shares = saved
        z, r, new = gates[:, 0], gates[:, 1], gates[:, 2]
        # all gradients of a step are its state's times what does not depend on it
        rest = 1 - z
        flow = np.empty_like(gates)
        by_z, by_r, by_new = flow[:, 0], flow[:, 1], flow[:, 2]
        np.subtract(before, new, out=by_z)
        by_z *= z
        by_z *= rest
        np.multiply(new, new, out=new)
        np.subtract(1, new, out=new)
        new *= rest
        np.multiply(new, r, out=by_new)
        np.subtract(1, r, out=by_r)
        by_r *= shares[:, 2]
        by_r *= by_new
        state = np.ascontiguousarray(_by_gate(self.model.state).transpose(0, 2, 1))
        some = opens.any(axis=1).tolist()
        back = shares[0]
        for t in range(len(dh) - 1, -1, -1):
            flow[t] *= dh[t]
            if t:
                np.matmul(flow[t], state, out=back)
                carried = z[t]
                carried *= dh[t]
                for part in back:
                    carried += part
                if some[t]:
                    carried *= ~opens[t][:, None]
                dh[t - 1] += carried
        cells = before.reshape(-1, HIDDEN).T
        for k in range(3):
            to_state[:, k * HIDDEN:(k + 1) * HIDDEN] = cells @ flow[:, k].reshape(-1, HIDDEN)
        np.multiply(new, dh, out=by_new)
        return flow


def _joined(texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of several batches, and where each text begins, as of one."""
    sizes = np.concatenate([np.diff(offsets) for _, offsets in texts])
    return np.concatenate([symbols for symbols, _ in texts]), np.concatenate([[0], np.cumsum(sizes)])


def _replica(vocab, weights, rounds_seed):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(weights.value)
        texts, held = [], 0
        for batch in slices(batches, "text", _SLICE):
            symbols, _, _, offsets = vocab.value.symbols_of(batch.column("text"))
            texts.append((symbols.astype(np.uint16), offsets))
            held += len(symbols) + batch.num_rows
            if held >= _TOKENS:
                trainer.learn(*_joined(texts))
                texts, held = [], 0
        if texts:
            trainer.learn(*_joined(texts))
        if trainer.words:
            flat = trainer.model.packed().astype(np.float64) * trainer.words
            cuts = range(0, len(flat), _CHUNK)
            branch = TaskContext.get().partitionId() % 64
            yield pa.record_batch([
                pa.array(range(len(cuts)), pa.int32()), pa.array([branch] * len(cuts), pa.int32()),
                pa.array([trainer.words] * len(cuts), pa.int64()), pa.array([flat[a:a + _CHUNK].tobytes() for a in cuts], pa.binary()),
            ], names=["chunk", "branch", "words", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table["sums"])
    return pa.table({
        "chunk": table["chunk"][:1], "branch": table["branch"][:1], "words": pa.array([sum(table["words"].to_pylist())], pa.int64()),
        "sums": pa.array([total.tobytes()], pa.binary()),
    })


def _round(docs: DataFrame, vocab, model: Model) -> Model:  # noqa: ANN001
    """One replica per partition, averaged; the averages are added up in two steps."""
    kinds = "chunk int, branch int, words bigint, sums binary"
    weights = docs.sparkSession.sparkContext.broadcast(model)
    parts = docs.select("text").mapInArrow(_replica(vocab, weights, 0), kinds)
    added = parts.groupBy("chunk", "branch").applyInArrow(_added, kinds).groupBy("chunk").applyInArrow(_added, kinds)
    rows = sorted(added.collect(), key=lambda r: r.chunk)
    if not rows:
        return model
    flat = np.concatenate([np.frombuffer(bytes(r.sums), np.float64) / r.words for r in rows])
    return model.unpacked(flat)


def score(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; ``learn``, of the id, chooses training rows."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    kind = texts.schema[id_col].dataType.simpleString()
    training = texts.where(learn)
    counts = count_words(training)
    documents = training.count()
    vocab_here = vocabulary(counts, documents)
    vocab = spark.sparkContext.broadcast(vocab_here)
    model = Model.fresh(vocab_here)
    model = _round(hashed_sample(training, id_col, WARM_DOCS, "text", documents).coalesce(1), vocab, model)
    for _ in range(ROUNDS):
        model = _round(training, vocab, model)
    final = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        norm = np.log10(v.total + v.distinct + 1)
        row = TaskContext.get().partitionId() << 40
        texts, columns, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            values = log_likelihood(final.value, v, *_joined(texts))
            at = 0
            for *front, value, rest in columns:
                value += values[at:at + len(value)]
                at += len(value)
                yield pa.record_batch([*front, pa.array(value), rest], names=["row", id_col, "n_tokens", "n_known", "base_score", "score", "rest"])

        for batch in slices(batches, "text", _SLICE):
            symbols, count, hashes, offsets = v.symbols_of(batch.column("text"))
            n = batch.num_rows
            own = np.repeat(np.arange(n), np.diff(offsets))
            tokens = np.diff(offsets) + 1
            met = count >= 0
            base = np.bincount(own[met], np.log10(count[met] + 1.0), n) + np.log10(v.end_count + 1.0) - tokens * norm
            known = np.bincount(own[met], minlength=n) + (v.end_count > 0)
            # known words of the tail: their counts are at hand
            near = met & (symbols >= HEAD)
            value = np.bincount(own[near], np.log10(count[near] + 1.0), n).astype(np.float64)
            far = np.flatnonzero(~met)
            cuts = np.searchsorted(far, offsets).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes[far].view(np.int64)))
            ids = batch.column(id_col).take(pa.array(np.arange(n)))  # a copy, so that the batch with its texts can go
            columns.append((pa.array(row + np.arange(n)), ids, pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), value, rest))
            texts.append((symbols.astype(np.uint16), offsets))
            row += n
            held += len(symbols) + n
            if held >= _TOKENS:
                yield from out()
                texts, columns, held = [], [], 0
        if texts:
            yield from out()

    schema = f"row bigint, `{id_col}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double, rest array<bigint>"
    near = written(texts.mapInArrow(run, schema), "scored")
    far = near.select("row", F.explode("rest").alias("word")).join(counts.select("word", "c"), "word")
    more = far.groupBy("row").agg(F.count("*").alias("met"), F.sum(F.log10(F.col("c") + 1)).alias("more"))
    joined = near.drop("rest").join(more, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        id_col, "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(vocab_here.total).cast("bigint").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
