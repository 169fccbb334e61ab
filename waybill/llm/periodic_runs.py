"""Stretches of words that repeat with a period, found from minimizers at several scales.

A run is a stretch of words of smallest period q and at least 4 q (and ``LEAST``) words that no neighbouring word extends.

* Periods of up to ``SHORT`` words are found by direct scans: word i against word i + q.
* Longer ones by scale: at window w, for periods from 2 w + 1 to 4 w. A minimizer is the sequence of w words of least hash in a window
  of w sequences. Inside a run, windows one period apart hold the same words, so their minimizers are equal and lie q apart. Pairs
  of equal minimizers at such a distance are the seeds; each is extended to both sides as far as words one distance apart agree.
* Sequences of w words that repeat with a period of w / 4 or less are no minimizers: they lie in a run that a smaller scale has
  found. The others occur at most 16 times within 4 w words, so seeds are few whatever the text. A run of a longer period cannot
  consist of such sequences alone, as neighbouring ones would share their period.

Seeds are extended by binary search over prefix sums of hashes, and the runs are then compared word by word. Every stretch is found
with its smallest period, as that has a scan or scale of its own. All texts of a batch are searched together, long ones first, with a
word of its own after each, so that no run leaves its text; a scale looks at those texts only that are long enough for it.

Words are ``[^\\x20\\x09-\\x0D]+`` with case. Null and empty texts have no words and no runs. Every row gives one row, repeated ones and
null ids too; other columns are ignored. Memory grows with the longest text, about 100 bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .chunks import slices
from .paragraphs import sliding_min
from .tokens import mix, words_of

LEAST = 6  # words in a run
TIMES = 4  # periods in a run
SHORT = 8  # periods that are scanned for
_NONE = np.uint64((1 << 64) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 16  # words put together at once

Tails = Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Sequence:
    """Words of all texts one after another, and which parts of them agree."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        powers = np.full(len(words) + 1, _BASE, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.powers[:-1], out=self.sums[1:])

    def _agree(self, at: np.ndarray, lag: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from ``at`` on have the hash of those ``lag`` further."""
        s = self.sums
        return (s[at + n] - s[at]) * self.powers[lag] == s[at + lag + n] - s[at + lag]

    def stretch(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the stretches around ``at`` in which words ``lag`` apart agree."""
        ahead = self._longest(lambda n: self._agree(at, lag, n), len(self.words) - at - lag)
        back = self._longest(lambda n: self._agree(at - n, lag, n), at)
        return at - back, at + lag + ahead

    @staticmethod
    def _longest(fits: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = fits(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, np.maximum(mid - 1, low))
        return low

    def exact(self, at: int, lag: int) -> tuple[int, int]:
        """The same for one place, word by word."""
        x, ahead, back, step = self.words, 0, 0, 64
        while at + lag + ahead < len(x):
            same = x[at + ahead:at + ahead + step][:len(x) - at - lag - ahead] == x[at + lag + ahead:at + lag + ahead + step]
            if not same.all():
                ahead += int(np.argmin(same))
                break
            ahead, step = ahead + len(same), 2 * step
        step = 64
        while back < at:
            n = min(step, at - back)
            same = (x[at - back - n:at - back] == x[at + lag - back - n:at + lag - back])[::-1]
            if not same.all():
                back += int(np.argmin(same))
                break
            back, step = back + n, 2 * step
        return at - back, at + lag + ahead


def _scanned(words: np.ndarray, lag: int) -> np.ndarray:
    """(begin, end, lag) of all stretches of at least ``TIMES`` lags."""
    same = np.flatnonzero(words[:-lag] == words[lag:])
    if not len(same):
        return np.zeros((0, 3), np.int64)
    new = np.flatnonzero(np.diff(same) > 1)
    first, last = same[np.concatenate([[0], new + 1])], same[np.concatenate([new, [len(same) - 1]])]
    long = last - first + 1 >= (TIMES - 1) * lag
    return np.stack([first[long], last[long] + 1 + lag, np.full(long.sum(), lag)], axis=1)


def _seeds(grams: np.ndarray, known: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal minimizers from 2 w + 1 to 4 w apart."""
    order = mix(grams)
    # what lies within a run of a short period
    inside = known[(known[:, 2] <= w // 4) & (known[:, 1] - known[:, 0] >= w) & (known[:, 0] < len(grams))]
    if len(inside):
        depth = np.zeros(len(grams) + 1, np.int64)
        np.add.at(depth, inside[:, 0], 1)
        np.add.at(depth, np.minimum(inside[:, 1] - w + 1, len(grams)), -1)
        order[np.cumsum(depth[:-1]) > 0] = _NONE
    if len(order) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = sliding_min(order, w)
    around = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    chosen = np.flatnonzero((~sliding_min(~around, w) == order) & (order != _NONE))
    chosen = chosen[np.argsort(grams[chosen], kind="stable")]
    key, places, distances = grams[chosen], [], []
    for step in range(1, len(chosen)):
        apart = chosen[step:] - chosen[:-step]
        near = (key[step:] == key[:-step]) & (apart <= 4 * w)
        if not near.any():
            break
        near &= apart > 2 * w
        places.append(chosen[:-step][near])
        distances.append(apart[near])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(places), join(distances)


def _smallest(found: np.ndarray) -> np.ndarray:
    """Of the same stretch found with several periods, the smallest."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[first]


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs (start, length, period) of each text, given as hashes of its words; by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    marks = mix(np.arange(1, len(texts) + 1, dtype=np.uint64) ^ np.uint64(0xA0761D6478BD642F))
    words = np.concatenate([p for k, i in enumerate(order) for p in (texts[i], marks[k:k + 1])] or [np.zeros(0, np.uint64)])
    ends = np.cumsum(sizes[order] + 1)
    long_enough = lambda n: int(ends[k - 1]) if (k := int((sizes >= n).sum())) else 0
    all_known = np.zeros((0, 3), np.int64)
    for lag in range(1, SHORT + 1):
        n = long_enough(TIMES * lag)
        if n > lag:
            all_known = np.concatenate([all_known, _scanned(words[:n], lag)])
    w, grams, seq = SHORT // 2, None, None
    while (n := long_enough(TIMES * (2 * w + 1))) > 0:
        if grams is None:
            seq = Sequence(words[:n])
            grams, have = words[:n], 1
        while have < w:  # of twice as many words
            grams = mix(grams[:-have] * _BASE + grams[have:])
            have *= 2
        grams = grams[:max(n - w + 1, 0)]
        at, lag = _seeds(grams, all_known, w)
        if len(at):
            begin, end = seq.stretch(at, lag)
            long = end - begin >= TIMES * lag
            found, first = np.unique(np.stack([begin, end, lag], axis=1)[long], axis=0, return_index=True)
            exact = []
            for (b, e, q), seed in zip(found.tolist(), at[long][first].tolist()):
                # equal sums are not yet equal words
                if not np.array_equal(words[b:e - q], words[b + q:e]):
                    b, e = seq.exact(seed, q)
                if e - b >= TIMES * q:
                    exact.append((b, e, q))
            if exact:
                all_known = np.concatenate([all_known, np.array(exact, np.int64)])
        w *= 2
    found = _smallest(all_known)
    found = found[found[:, 1] - found[:, 0] >= LEAST]
    starts = np.concatenate([[0], ends])
    owner = np.searchsorted(ends, found[:, 0], side="right")
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    for k in np.unique(owner):
        mine = found[owner == k] if len(found) < 1000 else found[np.searchsorted(owner, k):np.searchsorted(owner, k, side="right")]
        rows = np.stack([mine[:, 0] - starts[k], mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1)
        out[order[k]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return out


def kept_parts(n: int, runs: np.ndarray) -> Iterator[tuple[int, int]]:
    """The stretches of words that no run holds after its first period."""
    at = 0
    for start, stop in sorted((s + q, s + length) for s, length, q in runs.tolist()):
        if start > at:
            yield at, start
        at = max(at, stop)
    if at < n:
        yield at, n


def _sources(parts: Iterator[tuple[int, int]], tail: int, period: int) -> Iterator[tuple[int, int]]:
    """Where the words of the parts stand in the text, if those from ``tail`` on repeat with a period."""
    for at, stop in parts:
        while at < stop:
            if at < tail:
                to, place = min(stop, tail), at
            else:
                off = (at - tail) % period
                to, place = min(stop, at + period - off), tail + off
            for a in range(place, place + to - at, _PIECE):
                yield a, min(place + to - at, a + _PIECE)
            at = to


def find(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", collapsed: str = "text", tails: Tails | None = None,
) -> DataFrame:
    """Per row: id, n_words, runs (start, length, period: by start, then period) and collapsed.

    ``collapsed`` holds the words that no run holds after its first period, joined by one space: as text or, with "sha256", its hash.
    ``tails`` takes the ids and numbers of words of a batch and returns for each text a place and a period: the words from that place
    on count as repeats of the first of them (a place at the end changes nothing).
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    digest = collapsed == "sha256"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch.column("text"), fold=False)
            sizes = np.diff(words.offsets)
            if tails is None:
                tail, period = sizes, np.ones_like(sizes)
            else:
                tail, period = tails(batch.column("id").to_pylist(), sizes)
            texts = []
            for i, at in enumerate(words.offsets[:-1]):
                own = words.hashes[at:at + sizes[i]]
                if tail[i] < sizes[i]:
                    own = own.copy()
                    own[tail[i]:] = np.resize(own[tail[i]:tail[i] + period[i]], sizes[i] - tail[i])
                texts.append(own)
            found = runs_of(texts)
            left, flat = [], []
            for i, at in enumerate(words.offsets[:-1]):
                state, parts, sep = hashlib.sha256(), [], b""
                for a, b in _sources(kept_parts(int(sizes[i]), found[i]), int(tail[i]), int(period[i])):
                    piece = sep + b" ".join(words.data[words.first[at + a]:words.last[at + b - 1]].tobytes().split())
                    state.update(piece) if digest else parts.append(piece)
                    sep = b" "
                left.append(state.hexdigest() if digest else b"".join(parts).decode())
                flat.append(found[i])
            ends = np.concatenate([[0], np.cumsum([len(f) for f in flat])]).astype(np.int32)
            values = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
            runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(values[:, k])) for k in range(3)], ["start", "length", "period"])
            yield pa.record_batch(
                [batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), runs), pa.array(left, pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    schema = f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def longest(runs: str) -> Column:
    """The run of greatest length; of several the first, of these the one of smallest period; null without any."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
