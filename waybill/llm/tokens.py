"""Words of whole texts as 64-bit hashes, whole batches at a time.

A word is a run of bytes other than ASCII white space; A-Z counts as a-z. Its hash is a polynomial in a fixed odd number
modulo 2^64, taken from prefix sums over the bytes, so no word becomes a Python object. Equal words have equal hashes on
every machine; different words share one with probability of about 2^-64 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18
_MASK = (1 << 64) - 1

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_AS_IS = _VALUE.copy()
_VALUE[65:91] += np.uint64(32)


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BASE), _powers(_INVERSE)
_OTHER = 0xC2B2AE3D27D4EB4F  # of the second hash
_POWERS2, _INVERSES2 = _powers(_OTHER), _powers(pow(_OTHER, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; null is empty."""
    texts = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


@dataclass(frozen=True)
class Words:
    hashes: np.ndarray  # uint64, of all texts' words in order
    prefixes: np.ndarray | None  # uint64, of the words' first bytes
    tails: np.ndarray  # uint16, of the words' last two bytes
    offsets: np.ndarray  # int64: text i has the words offsets[i] to offsets[i + 1]
    data: np.ndarray  # the bytes of all texts
    first: np.ndarray  # int64, where each word begins in them
    last: np.ndarray  # int64, and ends
    checks: np.ndarray | None = None  # uint64, a second hash


def _long_hash(word: np.ndarray, base: int = _BASE, value: np.ndarray = _VALUE) -> int:
    powers = _POWERS if base == _BASE else _POWERS2
    total, at = 0, 0
    while at < len(word):
        part = value[word[at:at + _BLOCK]]
        total += int((part * powers[:len(part)]).sum(dtype=np.uint64)) * pow(base, at, 1 << 64)
        at += _BLOCK
    return total & _MASK


def words_of(column: pa.Array, prefix: int = 0, *, check: bool = False, fold: bool = True) -> Words:
    """The words of all texts; without ``fold``, A-Z and a-z differ."""
    value = _VALUE if fold else _AS_IS
    data, ends = bytes_of(column)
    n = len(data)
    hashes, prefixes, tails, starts, stops, checks = [], [], [], [], [], []
    at = 0
    while at < n:
        to = min(at + _BLOCK, n)
        if to < n:
            # back to the last place between words
            white = np.flatnonzero(_WHITE[data[at:to]])
            cut = at + int(white[-1]) + 1 if len(white) else at
            begin = int(ends[np.searchsorted(ends, to, side="right") - 1])
            cut = max(cut, begin)
            if cut <= at:  # one word longer than a block
                stop = int(ends[np.searchsorted(ends, at, side="right")])
                nxt = at
                while nxt < stop and not _WHITE[data[nxt:nxt + _BLOCK]].any():
                    nxt = min(stop, nxt + _BLOCK)
                if nxt < stop:
                    nxt += int(np.flatnonzero(_WHITE[data[nxt:nxt + _BLOCK]])[0])
                    nxt = min(nxt, stop)
                word = data[at:nxt]
                hashes.append(np.array([_long_hash(word, value=value)], np.uint64))
                prefixes.append(np.array([_long_hash(word[:prefix], value=value)], np.uint64))
                tails.append(np.array([int(word[-1]) * 256 + int(word[-2])], np.uint16))
                starts.append(np.array([at], np.int64))
                stops.append(np.array([nxt], np.int64))
                if check:
                    checks.append(np.array([_long_hash(word, _OTHER, value)], np.uint64))
                at = nxt
                continue
            to = cut
        part = data[at:to]
        white = _WHITE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[0] = edge[-1] = True
        inner = ends[np.searchsorted(ends, at, side="right"):np.searchsorted(ends, to, side="left")] - at
        edge[inner] = True
        dark = ~white
        opens = dark.copy()
        opens[1:] &= white[:-1] | edge[1:-1]
        closes = dark
        closes[:-1] &= white[1:] | edge[1:-1]
        first = np.flatnonzero(opens)
        last = np.flatnonzero(closes) + 1
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(value[part] * _POWERS[:len(part)], out=sums[1:])
        back = _INVERSES[first]
        hashes.append((sums[last] - sums[first]) * back)
        if prefix:
            prefixes.append((sums[np.minimum(first + prefix, last)] - sums[first]) * back)
        before = np.where(last - first > 1, part[last - 2], 0)
        tails.append(part[last - 1].astype(np.uint16) * np.uint16(256) + before.astype(np.uint16))
        starts.append(first + at)
        stops.append(last + at)
        if check:
            np.cumsum(value[part] * _POWERS2[:len(part)], out=sums[1:])
            checks.append((sums[last] - sums[first]) * _INVERSES2[first])
        at = to
    flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    begin = flat(starts, np.int64)
    return Words(
        mix(flat(hashes, np.uint64)), mix(flat(prefixes, np.uint64)) if prefix else None, flat(tails, np.uint16),
        np.searchsorted(begin, ends).astype(np.int64), data, begin, flat(stops, np.int64),
        flat(checks, np.uint64) if check else None,
    )


def shingles_of(words: Words, width: int, *, short_as_one: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and where each text's begin; repeated ones are kept.

    A text of fewer words has none or, with ``short_as_one``, its whole sequence as one.
    """
    h, offsets = words.hashes, words.offsets
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - width + 1, 0)
    out_ends = np.zeros(len(offsets), np.int64)
    short = short_as_one & (sizes > 0) & (sizes < width)
    np.cumsum(np.where(short, 1, counts), out=out_ends[1:])
    out = np.zeros(int(out_ends[-1]), np.uint64)
    full = len(h) - width + 1
    if full > 0:
        acc = np.zeros(full, np.uint64)
        for j in range(width):
            acc = mix(acc * np.uint64(_BASE) + h[j:j + full] + np.uint64(j + 1))
        # runs that stay within their text
        left = np.repeat(offsets[1:] - width, sizes)[:full] if len(sizes) else np.zeros(0, np.int64)
        inside = np.arange(full) <= left
        place = np.ones(len(out), bool)
        place[out_ends[:-1][short]] = False
        out[place] = acc[inside]
    for i in np.flatnonzero(short):
        acc = np.zeros(1, np.uint64)
        for j, x in enumerate(h[offsets[i]:offsets[i + 1]]):
            acc = mix(acc * np.uint64(_BASE) + x + np.uint64(j + 1))
        out[out_ends[i]] = mix(acc ^ np.uint64(sizes[i]))[0]
    return out, out_ends
