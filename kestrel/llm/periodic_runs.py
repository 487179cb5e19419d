"""Periodic run detection (12): block convolution at dyadic scales.

A run is a maximal stretch of words in which words ``q`` apart are equal, ``q``
its smallest period. At scale ``h`` (1, 2, 4, ...) the words are cut into half
blocks of ``h`` symbols; a block is two neighbouring half blocks, so blocks of
``2 h`` symbols start at every multiple of ``h``. One number-theoretic
transform per half block gives, exactly and for every block at once, the sums
of squared differences between the block and its copies ``d`` symbols further
on, ``h <= d <= 2 h``. A zero is an occurrence without mismatch and its
distance the seed of a run, which is then extended word by word on both sides.

Why no run is lost: a run of period ``q`` with ``h < q <= 2 h`` and length of at
least ``4 q`` holds a whole block together with its copy ``q`` further on. The block
covers a full period, so ``q`` is the only distance in ``(h, 2 h]`` at which it
occurs; a block with several distances lies in a run of smaller period, found
at that period's own scale. The first exact distance of every block is thus enough.

Symbols are word numbers hashed to a range so small that no sum reaches the
modulus: sums are exact integers, equal words always agree, and the rare zero
of unlike words is dropped when the words themselves are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

MIN_LENGTH = 6      # words of a run at least
MIN_EXPONENT = 4    # length of a run in periods at least; the scales need 4 or more
MODULUS = 2013265921    # prime, 15 * 2**27 + 1: transforms of up to 2**27 points
GENERATOR = 31      # of the multiplicative group
BATCH = 1 << 16     # transform points handled at once
_P = np.uint64(MODULUS)

RUNS = "array<struct<start:long,length:long,period:long>>"
SCHEMA = f"id long, n_words long, runs {RUNS}, collapsed string"


class Transform:
    """Forward (natural to bit-reversed order) and inverse transforms of ``n`` points, one per column."""

    def __init__(self, n: int):
        root = pow(GENERATOR, (MODULUS - 1) // n, MODULUS)
        self.n = n
        self.down = self._stages(root)
        self.up = self._stages(pow(root, -1, MODULUS))[::-1]
        self.scale = np.uint64(pow(n, -1, MODULUS))
        bits = n.bit_length() - 1
        frequency = np.zeros(n, dtype=np.int64)
        for b in range(bits):
            frequency |= ((np.arange(n) >> b) & 1) << (bits - 1 - b)
        # bit reversal is its own inverse: the position of frequency f is frequency[f]
        self.negated = frequency[(n - frequency) % n]

    def _stages(self, root: int) -> list[np.ndarray]:
        out, half = [], self.n // 2
        while half:
            w = np.ones(1, dtype=np.uint64)     # powers 0 .. half - 1 of the root, by doubling
            while len(w) < half:
                w = np.concatenate([w, w * np.uint64(pow(root, len(w), MODULUS)) % _P])
            out.append(w[:, None])
            root, half = root * root % MODULUS, half // 2
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        for w in self.down:
            pairs = x.reshape(-1, 2, len(w), x.shape[1])
            a, b = pairs[:, 0], pairs[:, 1]
            low = _once(a + b)
            pairs[:, 1] = _reduce((a + _P - b) * w)
            pairs[:, 0] = low
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        for w in self.up:
            pairs = x.reshape(-1, 2, len(w), x.shape[1])
            a, b = pairs[:, 0], _reduce(pairs[:, 1] * w)
            high = _once(a + _P - b)
            pairs[:, 0] = _once(a + b)
            pairs[:, 1] = high
        return _reduce(x * self.scale)


def _once(x: np.ndarray) -> np.ndarray:
    """Values below twice the modulus, reduced (unsigned wrap-around makes the smaller one right)."""
    return np.minimum(x, x - _P)


def _reduce(x: np.ndarray) -> np.ndarray:
    q = x // _P
    q *= _P
    x -= q
    return x


_transforms: dict[int, Transform] = {}


def _transform(n: int) -> Transform:
    if n not in _transforms:
        _transforms[n] = Transform(n)
    return _transforms[n]


def lag_products(x: np.ndarray, h: int) -> np.ndarray:
    """``out[l, i] = sum(x[i h + j] * x[i h + j + h + l] for j < h)`` for ``0 <= l <= h``.

    ``x`` holds whole half blocks; the last two of them have no window, so
    there are two columns less. Sums are modulo ``MODULUS``.
    """
    t = _transform(2 * h)
    n = len(x) // h
    blocks = np.zeros((2 * h, n), dtype=np.uint64)
    blocks[:h] = x.reshape(n, h).T
    spectrum = t.forward(blocks)
    # a window is two half blocks; shifting by half the transform turns the sign of odd frequencies, which are the second half here
    window = np.empty((2 * h, n - 2), dtype=np.uint64)
    window[:h] = _once(spectrum[:h, 1:-1] + spectrum[:h, 2:])
    window[h:] = _once(spectrum[h:, 1:-1] + _P - spectrum[h:, 2:])
    return t.inverse(_reduce(window * spectrum[t.negated, :-2]))[: h + 1]


def seeds(codes: np.ndarray, stop: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks of scale ``h`` that recur without mismatch at a distance of ``h`` (scale 1) or ``h + 1`` to ``2 h``.

    ``stop[i]`` ends the text of symbol ``i``; a block and its copy lie in one text.
    One distance, the smallest exact one, per block.
    """
    values = min(1 << 15, int(((MODULUS - 1) // (2 * h)) ** 0.5))
    symbols = tv.mix(codes.astype(np.uint64)) % np.uint64(values)
    n = -(-len(codes) // h) + 3
    padded = np.zeros(n * h, dtype=np.uint64)
    padded[: len(codes)] = symbols
    squares = np.zeros(n * h + 2 * h + 1, dtype=np.uint64)
    np.cumsum(padded * padded, out=squares[1: n * h + 1])
    squares[n * h + 1:] = squares[n * h]
    energy = (squares[2 * h:] - squares[: -2 * h])[: n * h].reshape(n, h)    # of the 2 h symbols from each place on
    starts, distances = [], []
    width = max(4, BATCH // (2 * h))
    low = 0 if h == 1 else 1
    for a in range(0, n - 3, width):
        b = min(a + width, n - 3)
        g = lag_products(padded[a * h: (b + 3) * h], h)
        product = _once(g[:, :-1] + g[:, 1:])       # of a block: of its two half blocks
        product = _once(product + product)
        both = np.empty((h + 1, b - a), dtype=np.uint64)
        both[:h] = energy[a + 1: b + 1].T
        both[h] = energy[a + 2: b + 2, 0]
        both += energy[a:b, 0][None, :]
        zero = (product == _once(both))[low:]       # the sum of squares less twice the products; it lies below the modulus
        hit = np.flatnonzero(zero.any(axis=0))
        while len(hit):
            first = zero[:, hit].argmax(axis=0)
            s, d = (hit + a) * h, first + low + h
            inside = s + 2 * h + d <= stop[np.minimum(s, len(stop) - 1)]
            hit, first, s, d = hit[inside], first[inside], s[inside], d[inside]
            same = np.zeros(len(s), dtype=bool)
            for i in range(0, len(s), max(1, BATCH // (2 * h))):
                part = slice(i, i + max(1, BATCH // (2 * h)))
                place = s[part, None] + np.arange(2 * h)
                same[part] = (codes[place] == codes[place + d[part, None]]).all(axis=1)
            starts.append(s[same])
            distances.append(d[same])
            zero[first[~same], hit[~same]] = False
            hit = hit[~same]
            hit = hit[zero[:, hit].any(axis=0)]
    z = np.zeros(0, dtype=np.int64)
    return np.concatenate([z, *starts]), np.concatenate([z, *distances])


def _extended(codes: np.ndarray, at: np.ndarray, d: np.ndarray, bound: np.ndarray, step: int, reach: int) -> np.ndarray:
    """Move ``at`` by ``step`` as long as ``codes[at] == codes[at + d]`` and the bound isn't reached."""
    at, live = at.copy(), np.arange(len(at))
    while len(live):
        nxt = []
        rows = max(1, BATCH // reach)
        for i in range(0, len(live), rows):
            k = live[i: i + rows]
            place = at[k, None] + step * np.arange(reach)
            open_ = place * step < bound[k, None] * step
            place = np.where(open_, place, at[k, None])
            other = np.minimum(place + d[k, None], len(codes) - 1)
            good = open_ & (codes[np.minimum(place, len(codes) - 1)] == codes[other])
            run = np.where(good.all(axis=1), reach, good.argmin(axis=1))
            at[k] += step * run
            nxt.append(k[run == reach])
        live = np.concatenate(nxt)
    return at


def find_runs(codes: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of the texts ``codes[offsets[t]:offsets[t + 1]]``, in that order."""
    if min_exponent < 4:
        raise ValueError("the scales find runs of exponent 4 or more")
    sizes = np.diff(offsets)
    found, h = [], 1
    texts = np.flatnonzero(sizes >= min_length)
    while len(texts):
        n = sizes[texts]
        ends = np.cumsum(n)
        begins = ends - n
        if len(texts) == len(sizes):
            now = codes
        else:
            now = codes[np.repeat(offsets[texts] - begins, n) + np.arange(ends[-1])]
        s, d = seeds(now, np.repeat(ends, n), h)
        if len(s):
            order = np.lexsort((s, d))
            s, d = s[order], d[order]
            t = np.searchsorted(ends, s, side="right")
            # blocks of one distance that overlap or touch lie in one run
            new = np.ones(len(s), dtype=bool)
            new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] - s[:-1] > 2 * h)
            last = np.append(np.flatnonzero(new)[1:], len(s)) - 1
            first, d, t, stop = s[new], d[new], t[new], s[last] + 2 * h
            start = _extended(now, first - 1, d, begins[t] - 1, -1, h) + 1
            end = _extended(now, stop, d, ends[t] - d, 1, h) + d
            length = end - start
            long = length >= np.maximum(min_length, min_exponent * d)
            found.append(np.stack([texts[t], start - begins[t], length, d], axis=1)[long])
        h *= 2
        texts = texts[n >= min_exponent * (h + 1)]
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # a stretch found with a multiple of its period as well has the smallest one first
    return rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))] if len(rows) else rows


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow array; ``data`` holds nothing but white space between them."""
    letters = data[~tv.is_space(data)]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def _batches(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in tv.chunks(batch.column(1)):
            doc, starts, ends = tv.word_spans(data, offsets)
            words = word_array(data, starts, ends)
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
            counts = np.bincount(doc, minlength=b - a).astype(np.int64)
            base = np.concatenate(([0], np.cumsum(counts)))
            runs = find_runs(codes, base, min_length, min_exponent)
            text, start, length, period = runs.T
            cover = np.zeros(len(codes) + 1, dtype=np.int32)
            np.add.at(cover, base[text] + start + period, 1)
            np.add.at(cover, base[text] + start + length, -1)
            kept = np.cumsum(cover)[:-1] == 0
            left = np.concatenate(([0], np.cumsum(np.bincount(doc[kept], minlength=b - a))))
            lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
            collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            per = np.searchsorted(text, np.arange(b - a + 1))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(per, pa.int32()), items), collapsed],
                ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per document: ``id, n_words, runs`` and ``collapsed``, its text without the repeated words.

    ``runs`` lists every run of at least ``min_length`` words and
    ``min_exponent`` periods (4 or more) by start, then period; numbers count
    words ``[^\\x20\\x09-\\x0D]+`` from 0. ``collapsed`` joins by one space the
    words that no run holds after its first period.

    Edge cases: null and empty texts have no words, no run and an empty
    ``collapsed``; null and repeated ids keep their rows; a text is never
    split or cut, a very long one is handled in batches of transforms (its word numbers
    must fit a task); two runs may overlap or share a start (shorter first);
    other columns, whatever their names, are not read; an empty table gives none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _batches(it, min_length, min_exponent), SCHEMA)
