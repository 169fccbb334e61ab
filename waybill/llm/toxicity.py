"""Toxicity of whole texts by a convolutional network over hashed words.

A word is the sum of two embeddings, of its hash and of that of its first bytes; buckets that fewer than ``LEAST_TEXTS`` fitted
texts hold are blank, as nothing general can be learned of them. Filters of several widths slide over the words. Each filter's
maximum, at least zero, is taken in every piece of ``PIECE`` words; the greatest of a text's pieces and their mean (whether a
text holds such words at all, and how densely) feed a logistic unit. Trained in numpy by adaptive gradients on a bounded sample
of labelled texts (``SAMPLE_ROWS`` of each label, of at most ``SAMPLE_CHARS`` characters, those of smallest hash of id and text);
in each step a share of the words is known by their first bytes only. A trained filter acts on a word as one row of a table, so
scoring is gathers and maxima.

Thresholds are calibrated by language on every clean text that may be learned from, of any length, by a network that was not
fitted to it: texts of the sample by one of ``FOLDS`` networks fitted to the other folds, all others by the network itself. Each
language gets the least threshold from ``FLOOR`` up at which no more than ``FALSE_RATE`` of its clean texts, or one, are
rejected. The language chooses a threshold; it is no input of the score. Languages of fewer than ``LEAST_OF_LANGUAGE`` such
texts, and null, take the threshold of all.

Null and empty texts are scored as a text without words. Labels that are null, or whose id is null, are not learned from;
an id labelled more than once counts once, by its greater label. Rows come back one to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import written
from .chunks import numbered, slices
from .filters import key_filter, passes
from .sampling import hashed_sample
from .tokens import words_of

WORD_BUCKETS, PREFIX_BUCKETS = 1 << 15, 1 << 14
PREFIX_BYTES = 5
WIDTHS = (1, 2, 6)
FILTERS, DIMENSIONS = 8, 12
PIECE = 64  # words of which a filter's maximum is taken
LEAST_TEXTS, WORD_DROPOUT, FOLDS = 3, 0.5, 3
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 30_000
FLOOR, FALSE_RATE, LEAST_OF_LANGUAGE = 0.7, 0.002, 50
STEPS = 10_000  # of the histogram of scores
SLICE = 1 << 19
_PAD = WORD_BUCKETS + PREFIX_BUCKETS
_GAP = max(WIDTHS)


def word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two rows of embedding indices, of all texts' words with ``_GAP`` blanks after each text, and where each begins."""
    words = words_of(column, PREFIX_BYTES)
    sizes = np.diff(words.offsets)
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + _GAP, out=ends[1:])
    ids = np.full((2, int(ends[-1])), _PAD, np.int32)
    place = np.arange(len(words.hashes)) + np.repeat(np.arange(len(sizes)) * _GAP, sizes)
    ids[0, place] = (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int32)
    ids[1, place] = (words.prefixes % np.uint64(PREFIX_BUCKETS)).astype(np.int32) + WORD_BUCKETS
    return ids, ends


def pieces_of(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of each text begin and end, and the first piece of each text.

    A filter begins at a word, or at the first blank after the last: it never reaches the next text.
    """
    sizes = np.maximum(-(-(np.diff(ends) - _GAP) // PIECE), 1)
    first = np.cumsum(sizes) - sizes
    start = np.repeat(ends[:-1] - first * PIECE, sizes) + np.arange(sizes.sum()) * PIECE
    stop = start + PIECE
    stop[first + sizes - 1] = ends[1:] - _GAP + 1
    return start, stop, first


@dataclass
class Network:
    embedding: np.ndarray  # one row per bucket, and a last one of zeros
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    weights: np.ndarray  # of the greatest and of the mean of the pieces
    bias: float

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (_PAD + 1, DIMENSIONS)).astype(np.float32)
        embedding[_PAD] = 0
        filters = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(embedding, filters, np.tile(rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 2), -1.0)

    def responses(self, ids: np.ndarray) -> np.ndarray:
        x = self.embedding[ids[0]] + self.embedding[ids[1]]
        out = np.zeros((len(x), FILTERS * len(self.filters)), np.float32)
        for k, f in enumerate(self.filters):
            every, own = x @ np.concatenate(list(f), axis=1), out[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(len(f)):
                own[:len(x) - j] += every[j:, j * FILTERS:(j + 1) * FILTERS]
        return out

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embedding @ f[j] for j in range(len(f))] for f in self.filters]

    def score(self, ids: np.ndarray, ends: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        start, stop, first = pieces_of(ends)
        inside = np.stack([start, stop], axis=1).ravel()
        greatest, mean = [], []
        for per_place in tables:
            r = per_place[0][ids[0]] + per_place[0][ids[1]]
            for j in range(1, len(per_place)):
                r[:-j] += per_place[j][ids[0, j:]]
                r[:-j] += per_place[j][ids[1, j:]]
            # an empty stretch, between pieces that meet, gives its first value and is passed over
            tops = np.maximum(np.maximum.reduceat(r, inside, axis=0)[::2], 0)
            greatest.append(np.maximum.reduceat(tops, first, axis=0))
            mean.append(np.add.reduceat(tops, first, axis=0) / np.diff(first, append=len(start))[:, None].astype(np.float32))
        logit = np.concatenate([*greatest, *mean], axis=1) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))


def fit(
    texts: list[np.ndarray], labels: np.ndarray, *, epochs: int = 12, batch: int = 64, rate: float = 0.07, seed: int = 5,
    dropout: float = WORD_DROPOUT,
) -> Network:
    """``texts`` holds the two rows of indices of each text, blanks included."""
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    held = np.zeros(_PAD + 1, np.int64)
    for t in texts:
        held[np.unique(t)] += 1
    blank = held < LEAST_TEXTS
    blank[_PAD] = True
    net.embedding[blank] = 0
    params = [net.embedding, *net.filters, net.weights]
    seen = [np.full_like(p, 1e-2) for p in params]
    bias_seen = 1e-2
    share = max(labels.mean(), 1e-3) if len(labels) else 0.5
    weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1 - share, 1e-3))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            ids = np.concatenate([texts[i] for i in chosen], axis=1)
            ids[0, rng.random(ids.shape[1]) < dropout] = _PAD
            ends = np.cumsum([0, *(texts[i].shape[1] for i in chosen)])
            grads, bias_grad, rows, moves = gradients(net, ids, ends, (labels[chosen], weight[chosen] / len(chosen)))
            touched, inverse = np.unique(rows, return_inverse=True)
            total = np.stack([np.bincount(inverse, m, len(touched)) for m in moves.T], axis=1).astype(np.float32)
            total[blank[touched]] = 0
            seen[0][touched] += total**2
            net.embedding[touched] -= rate * total / np.sqrt(seen[0][touched])
            for x, s, d in zip(params[1:], seen[1:], grads):
                s += d**2
                x -= rate * d / np.sqrt(s)
            bias_seen += bias_grad**2
            net.bias -= rate * bias_grad / np.sqrt(bias_seen)
    return net


def gradients(
    net: Network, ids: np.ndarray, ends: np.ndarray, wanted: tuple[np.ndarray, np.ndarray],
) -> tuple[list[np.ndarray], float, np.ndarray, np.ndarray]:
    """Of the weighted log loss: by filters and weights, by the bias, and rows of the embedding with what each is moved by."""
    labels, weight = wanted
    r = net.responses(ids)
    start, stop, first = pieces_of(ends)
    owner = np.repeat(np.arange(len(labels)), np.diff(first, append=len(start)))
    n = np.bincount(owner)[:, None].astype(np.float32)
    inside = np.minimum(start[:, None] + np.arange(PIECE + 1)[None], stop[:, None] - 1)
    peak = r[inside].argmax(axis=1) + start[:, None]
    top = np.take_along_axis(r, peak, axis=0)
    tops = np.maximum(top, 0)
    greatest = np.maximum.reduceat(tops, first, axis=0)
    f = np.concatenate([greatest, np.add.reduceat(tops, first, axis=0) / n], axis=1)
    p = 1 / (1 + np.exp(-np.clip(f @ net.weights + net.bias, -30, 30)))
    g = ((p - labels) * weight).astype(np.float32)
    half = tops.shape[1]
    # pieces that share the greatest share its gradient
    ties = tops == greatest[owner]
    of_greatest = g[:, None] * net.weights[None, :half] / np.add.reduceat(ties, first, axis=0, dtype=np.float32)
    of_mean = g[:, None] * net.weights[None, half:] / n
    back = (of_mean[owner] + of_greatest[owner] * ties) * (top > 0)
    grads = [np.zeros_like(x) for x in net.filters] + [f.T @ g]
    rows, parts = [], []
    for k, filt in enumerate(net.filters):
        own = slice(k * FILTERS, (k + 1) * FILTERS)
        at_k, g_k = peak[:, own], back[:, own]
        live = g_k != 0
        for j in range(len(filt)):
            both = ids[:, np.minimum(at_k + j, ids.shape[1] - 1)]  # 2 x pieces x filters
            x = net.embedding[both[0]] + net.embedding[both[1]]
            grads[k][j] = np.einsum("tf,tfd->df", g_k, x)
            step = (g_k[:, :, None] * filt[j].T[None])[live]
            rows += [both[0][live], both[1][live]]
            parts += [step, step]
    return grads, float(g.sum()), np.concatenate(rows), np.concatenate(parts)


@dataclass(frozen=True)
class Model:
    network: Network
    thresholds: dict[str | None, float]  # by language; None: any other


def sample(docs: DataFrame, labels: DataFrame, learn: Column, label: str, rows: int, chars: int) -> DataFrame:
    """(id, text, lang, text_hash, label): about ``rows`` labelled rows of each label at most, those of smallest hash."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    known = known.where(learn)
    texts = docs.where(F.length("text") <= chars).select("doc_id", "text", "lang", F.xxhash64("text").alias("text_hash"))
    parts = [hashed_sample(known.where(F.col("label") == x), "doc_id", rows) for x in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # an id may have many rows
    chosen = written(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
    parts = [hashed_sample(chosen.where(F.col("label") == x), "doc_id", rows, "text") for x in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """``learn`` says, of ``doc_id``, whose labels may be learned from."""
    found = sample(docs, labels, learn, label, rows, SAMPLE_CHARS).toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    y = found["label"].to_numpy().astype(np.float32)
    texts = []
    for part in slices(iter(found.select(["text"]).combine_chunks().to_batches()), "text", SLICE):
        ids, ends = word_ids(part.column("text"))
        texts += [ids[:, a:b] for a, b in zip(ends, ends[1:])]
    found = found.select(["doc_id", "text_hash", "lang"])  # the driver keeps no text while it fits
    if not len(y) or y.min() == y.max():
        net = Network.fresh()
        net.weights[:] = 0
        net.bias = 3.0 if len(y) and y.max() > 0 else -3.0
        return Model(net, {None: FLOOR})
    net = fit(texts, y)
    own = out_of_fold(texts, y)
    fitted = docs.sparkSession.createDataFrame(found.select(["doc_id", "text_hash"]))
    own = found.select(["lang"]).append_column("score", pa.array(own, pa.float64())).filter(pa.array(y == 0))
    clean = clean_scores(docs, labels, learn, label, net, fitted, docs.sparkSession.createDataFrame(own))
    return Model(net, calibrate(clean["score"].to_numpy(), np.zeros(len(clean)), clean["lang"].to_pylist(), clean["n"].to_numpy()))


def out_of_fold(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The score of each text by a network that was fitted to the texts of the other folds."""
    fold = np.arange(len(texts)) % FOLDS
    out = np.zeros(len(texts))
    for k in range(FOLDS):
        net = fit([t for t, f in zip(texts, fold) if f != k], labels[fold != k])
        tables, own = net.tables(), np.flatnonzero(fold == k)
        for at in range(0, len(own), 64):
            part = [texts[i] for i in own[at:at + 64]]
            out[own[at:at + 64]] = net.score(np.concatenate(part, axis=1), np.cumsum([0, *(t.shape[1] for t in part)]), tables)
    return out


def clean_scores(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str, net: Network, fitted: DataFrame, own: DataFrame | None = None,
) -> pa.Table:
    """(lang, score, n): a histogram of the scores of all clean texts that may be learned from, but for those ``fitted``.

    ``own`` (lang, score) is counted with them: scores of the fitted clean texts by other networks. Scores below ``FLOOR`` are one step; of each step the greatest score is given. Languages of few such texts are null.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    known = known.where(learn).where("label = 0").select("doc_id")
    key = F.xxhash64(F.col("doc_id").cast("string")).alias("key")
    rows = docs.where(learn).where("doc_id is not null").select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash"))
    rows = rows.join(F.broadcast(fitted), ["doc_id", "text_hash"], "left_anti").select("doc_id", "lang", "text", key)
    # most texts without a label are not read in Python; the join below decides
    shared = docs.sparkSession.sparkContext.broadcast((net, key_filter(known.select(key), "key")))

    def labelled(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(np.sort(passes(wanted, batch.column("key").to_numpy().view(np.uint64)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wanted = shared.value
        tables = own.tables()
        for batch in slices(labelled(batches, wanted), "text", SLICE):
            ids, ends = word_ids(batch.column("text"))
            scores = pa.array(own.score(ids, ends, tables), pa.float64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("lang"), scores], names=["doc_id", "lang", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    step = F.floor(F.greatest("score", F.lit(FLOOR)) * STEPS).alias("step")
    # rows of one id come together before the labels are joined
    scored = rows.mapInArrow(run, f"doc_id {kind}, lang string, score double")
    scored = scored.groupBy("doc_id", "lang", step).agg(F.count("*").alias("n"), F.max("score").alias("score"))
    counted = scored.join(known, "doc_id").select("lang", "step", "n", "score")
    if own is not None:
        counted = counted.unionByName(own.select("lang", step, F.lit(1).cast("bigint").alias("n"), "score"))
    steps = written(counted.groupBy("lang", "step").agg(F.sum("n").alias("n"), F.max("score").alias("score")), "clean-scores")
    often = steps.groupBy("lang").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_OF_LANGUAGE).select("lang", F.lit(True).alias("often"))
    of = F.when(F.col("often"), F.col("lang")).alias("lang")
    counted = steps.join(often, "lang", "left").groupBy(of, "step").agg(F.max("score").alias("score"), F.sum("n").alias("n"))
    return counted.select("lang", "score", "n").toArrow()


def calibrate(scores: np.ndarray, labels: np.ndarray, languages: list, counts: np.ndarray | None = None) -> dict[str | None, float]:
    """Each score stands for ``counts`` texts, or one."""
    counts = np.ones(len(scores), np.int64) if counts is None else counts

    def least(own: np.ndarray) -> float:
        if not own.any():
            return FLOOR
        order = np.flatnonzero(own)[np.argsort(-scores[own], kind="stable")]
        above = np.cumsum(counts[order])
        beyond = scores[order][above > np.ceil(FALSE_RATE * above[-1])]
        return max(FLOOR, float(np.nextafter(beyond[0], 2))) if len(beyond) else FLOOR

    languages = np.array(languages, dtype=object)
    out: dict[str | None, float] = {None: least(labels == 0)}
    for lang in {x for x in languages if x is not None}:
        clean = (languages == lang) & (labels == 0)
        if counts[clean].sum() >= LEAST_OF_LANGUAGE:
            out[lang] = min(least(clean), 0.99)
    out[None] = min(out[None], 0.99)
    return out


def score(docs: DataFrame, model: Model, *, text_col: str = "text", lang_col: str = "lang", into: str = "toxicity") -> DataFrame:
    """The rows with a column struct<score, threshold, toxic>."""
    spark = docs.sparkSession
    net = spark.sparkContext.broadcast(model.network)
    rows, names = numbered(docs)
    text = names[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = net.value
        tables = own.tables()
        for batch in slices(batches, text, SLICE):
            ids, ends = word_ids(batch.column(text))
            yield batch.append_column("score", pa.array(own.score(ids, ends, tables), pa.float64()))

    scored = rows.mapInArrow(run, StructType([*rows.schema, StructField("score", DoubleType())]))
    known = {k: float(t) for k, t in sorted((k, t) for k, t in model.thresholds.items() if k is not None)}
    threshold = F.lit(float(model.thresholds[None]))
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        threshold = F.coalesce(F.try_element_at(table, F.col(names[lang_col])), threshold)
    result = F.struct(F.col("score"), threshold.alias("threshold"), (F.col("score") >= threshold).alias("toxic"))
    return scored.select(*[F.col(n).alias(c) for c, n in names.items() if c != into], result.alias(into))
