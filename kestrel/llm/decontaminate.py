"""Benchmark decontamination (3): q-gram lemma filter and banded alignment.

An item of ``n`` characters that occurs in a document with at most ``k`` edits
shares at least ``n - q + 1 - q*k`` of its q-grams with the place, all on
diagonals (document position minus item position) that differ by at most ``k``.
Hits are counted in overlapping bands of ``2 (k + 1)`` diagonals, each ``k + 1``
apart, so one band holds them all. Bands that reach the bound are aligned by a
banded edit distance; what needs at most ``k`` edits is a leak.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import row_key, text_of

Q = 8
MAX_EDIT_RATE = 0.05      # edits per character of an item
INDEX_BYTES = 32 << 20    # benchmark text that one pass over the documents holds; more is done in blocks
_STEP = 0x100000001B3


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with every white-space run as one blank and none at the ends, and their offsets.

    ``data`` is UTF-8 (lower-cased by the caller).
    """
    space = tv.is_space(data)
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first blank of a run stays ...
    doc_start = offsets[:-1][np.diff(offsets) > 0]
    keep[doc_start] = ~space[doc_start]  # ... but none at a document's start
    kept = np.concatenate(([0], np.cumsum(keep)))[offsets]
    flat = np.where(space, np.uint8(32), data)[keep]
    points = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum((flat & 0xC0) != 0x80)))[kept]
    return points, starts


def qgrams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the ``q`` characters (a power of two) from every position; the last ``q - 1`` are no q-grams."""
    h, have, factor = points.astype(np.uint64), 1, np.uint64(_STEP)
    with np.errstate(over="ignore"):
        while have < q:
            h = h[:-have] * factor + h[have:] if len(h) > have else h[:0]
            factor, have = factor * factor, have * 2
        return tv.mix(h)


def edits_allowed(n: int, q: int = Q, rate: float = MAX_EDIT_RATE) -> int:
    """Edit budget of an item of ``n`` characters, lowered until the q-gram bound is at least one."""
    return max(0, min(int(rate * n), (n - q) // q))


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, width: int, limit: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into a part of ``text``, and that part's end.

    Item position ``i`` may meet text positions ``i + low`` to ``i + low +
    width - 1`` only. Start and end in the text are free inside the band.
    """
    big = limit + 1
    lanes = np.arange(width)
    row = np.zeros(width, dtype=np.int64)  # before the first character every start is free
    row[(lanes + low < 0) | (lanes + low > len(text))] = big
    padded = np.concatenate((text.astype(np.int64), [-1]))
    for i, ch in enumerate(item):
        at = lanes + low + i  # text position that the character would meet
        ok = (at >= 0) & (at < len(text))
        same = padded[np.where(ok, at, len(text))] == int(ch)
        nxt = np.where(ok, row + ~same, big)                  # match or substitution ends one further: same lane
        nxt[:-1] = np.minimum(nxt[:-1], row[1:] + 1)          # item character left out: one lane down
        nxt = np.minimum.accumulate(nxt - lanes) + lanes      # text characters left out
        end = at + 1
        nxt[(end < 0) | (end > len(text))] = big
        row = np.minimum(nxt, big)
        if row.min() > limit:
            return big, -1
    best = int(row.argmin())
    return int(row[best]), best + low + len(item)


def _diagonal_match(item: np.ndarray, text: np.ndarray, low: int, width: int) -> int:
    """First diagonal of the band on which the whole item stands unchanged (an alignment without edits), or -1."""
    for d in range(max(0, low), min(low + width, len(text) - len(item) + 1)):
        if text[d] == item[0] and np.array_equal(text[d: d + len(item)], item):
            return d
    return -1


class Index:
    """q-gram index of one block of distinct normalised items (a bounded block, broadcast to the tasks)."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, rate: float):
        self.q, self.ids, self.points, self.budget = q, [], [], []
        gram, owner, pos = [], [], []
        for item_id, text in items:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            points, _ = normalise(data, np.array([0, len(data)]))
            points = points[: len(points) - 1] if len(points) and points[-1] == 32 else points
            if len(points) < q:
                continue
            g = qgrams(points, q)
            gram.append(g)
            owner.append(np.full(len(g), len(self.ids)))
            pos.append(np.arange(len(g)))
            self.ids.append(item_id)
            self.points.append(points)
            self.budget.append(edits_allowed(len(points), q, rate))
        n = np.array([len(p) for p in self.points], dtype=np.int64)
        self.budgets = np.array(self.budget, dtype=np.int64)
        self.bound = np.maximum(1, n - q + 1 - q * self.budgets)
        self.size = n
        if self.ids:
            gram, owner, pos = (np.concatenate(x) for x in (gram, owner, pos))
            order = np.argsort(gram, kind="stable")
            self.gram, first = np.unique(gram[order], return_index=True)
            self.first = np.append(first, len(gram))
            self.owner, self.pos = owner[order], pos[order]
            self.bits = np.zeros(1 << 22, dtype=bool)
            self.bits[self.gram >> np.uint64(42)] = True
            # by size class (powers of two): hits that a leak has at least, and the length that holds them
            kind = np.log2(n).astype(int)
            self.classes = [(int(self.bound[kind == c].min()), int((n + self.budgets)[kind == c].max())) for c in np.unique(kind)]

    def _dense(self, at: np.ndarray, n: int) -> np.ndarray:
        """Which positions lie in a stretch that begins with a hit and has as many hits as a leak of some size class."""
        count = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n))))
        edge = np.zeros(n + 1, dtype=np.int64)
        for least, reach in self.classes:
            stop = np.minimum(at + reach, n)
            full = count[stop] - count[at] >= least
            edge[at[full]] += 1  # positions are distinct, the stops are not
            edge -= np.bincount(stop[full], minlength=n + 1)
        return np.cumsum(edge)[at] > 0

    def search(self, points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Yield (document, item, start, end, edits) of the best alignment of each leaked item."""
        if not self.ids or len(points) < self.q:
            return
        g = qgrams(points, self.q)
        maybe = np.flatnonzero(self.bits[g >> np.uint64(42)])
        doc = np.searchsorted(starts, maybe, side="right") - 1
        maybe = maybe[maybe + self.q <= starts[doc + 1]]
        maybe = maybe[self._dense(maybe, len(points))]
        slot = np.minimum(np.searchsorted(self.gram, g[maybe]), len(self.gram) - 1)
        hit = self.gram[slot] == g[maybe]
        maybe, slot = maybe[hit], slot[hit]
        times = self.first[slot + 1] - self.first[slot]
        at = np.repeat(maybe, times)
        post = np.repeat(self.first[slot], times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        item = self.owner[post]
        doc = np.searchsorted(starts, at, side="right") - 1
        step = self.budgets[item] + 1
        diagonal = at - starts[doc] - self.pos[post] + self.size[item]  # never below zero
        band = diagonal // step
        # each hit counts in its band and in the one that begins a step before
        key_doc, key_item = np.concatenate((doc, doc)), np.concatenate((item, item))
        key_band = np.concatenate((band, band - 1))
        order = np.lexsort((key_band, key_item, key_doc))
        d, i, b = key_doc[order], key_item[order], key_band[order]
        if not len(d):
            return
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(d)))
        head = head[n >= self.bound[i[head]]]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for h in head:
            dd, ii, bb = int(d[h]), int(i[h]), int(b[h])
            k = self.budget[ii]
            size = int(self.size[ii])
            low = bb * (k + 1) - size - k
            text = points[starts[dd]: starts[dd + 1]]
            begin = max(0, low)
            if (dd, ii) in found and found[dd, ii][2] == 0:
                continue  # nothing is better than an exact copy
            piece = text[begin: max(begin, low + 2 * (k + 1) + 2 * k + size + 1)]
            exact = _diagonal_match(self.points[ii], text, low + k, 2 * (k + 1))
            if exact >= 0:
                found[dd, ii] = (exact, exact + size, 0)
                continue
            edits, end = banded_distance(self.points[ii], piece, low - begin, 2 * (k + 1) + 2 * k + 1, k)
            if edits <= k:
                best = found.get((dd, ii))
                if best is None or (edits, end + begin) < (best[2], best[1]):
                    found[dd, ii] = (max(0, end + begin - size), end + begin, edits)
        for (dd, ii), (s, e, edits) in sorted(found.items()):
            yield dd, ii, s, e, edits


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", q: int = Q, max_edit_rate: float = MAX_EDIT_RATE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document row and leaked item: ``id, rk, item_id, start, end, edits, item_chars``.

    Texts are compared in lower case with white-space runs as one blank;
    ``end`` is the end of the best alignment in the normalised document and
    ``start`` that end less the item's length. Items with equal normalised
    texts count once, by their smallest id. Items below ``q`` characters are
    too short to name a passage and are left out, as are null ones. Null or
    empty documents leak nothing; repeated rows give repeated results; empty
    tables give an empty result.

    The index of at most ``index_bytes`` of benchmark text is broadcast; a
    larger benchmark is split into blocks by a hash of the text, one pass over
    the documents each, so the broadcast never grows with the data.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("rk"), text_of(text_col).alias("text"))
    schema = "id long, rk long, item_id long, start long, end long, edits int, item_chars int"
    parts = [src.mapInArrow(_searcher(index), schema) for index in _indexes(benchmark, item_col, item_text, q, max_edit_rate, index_bytes)]
    return reduce(DataFrame.unionByName, parts)


def _indexes(benchmark: DataFrame, item_col: str, item_text: str, q: int, rate: float, index_bytes: int) -> list:
    """Broadcast indexes of the benchmark's blocks (one block unless it exceeds ``index_bytes``)."""
    def lower(batches):     # the routine that lowers the documents, as languages differ in it (final sigma, dotted i)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.utf8_lower(batch.column(1))], names=["item", "t"])

    items = (benchmark.select(F.col(item_col).cast("long").alias("item"),
                              F.trim(F.regexp_replace(text_of(item_text), r"[\x20\x09-\x0D]+", " ")).alias("t"))
             .mapInArrow(lower, "item long, t string").groupBy("t").agg(F.min("item").alias("item")).where(F.length("t") >= q))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // index_bytes))
    out = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).orderBy("t").collect()  # about index_bytes
        out.append(benchmark.sparkSession.sparkContext.broadcast(
            cloudpickle.dumps(Index([(r["item"], r["t"]) for r in rows], q, rate))))  # with its class, see the package
    return out


def _searcher(index):
    def run(batches):
        ix = pickle.loads(index.value)
        for batch in batches:
            rows = []
            for a, b, data, off in tv.chunks(batch.column("text"), lower=True):
                points, starts = normalise(data, off)
                rows += [(a + d, i, s, e, x) for d, i, s, e, x in ix.search(points, starts)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("rk").take(at), pa.array([ix.ids[r[1]] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[4] for r in rows], pa.int32()), pa.array([int(ix.size[r[1]]) for r in rows], pa.int32())],
                names=["id", "rk", "item_id", "start", "end", "edits", "item_chars"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", q: int = Q, max_edit_rate: float = MAX_EDIT_RATE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item (columns unchanged; null texts stay).

    The filter runs where the rows are: no join and no shuffle.
    """
    at = docs.columns.index(text_col)
    for index in _indexes(benchmark, item_col, item_text, q, max_edit_rate, index_bytes):
        docs = docs.mapInArrow(_filter(index, at), docs.schema)
    return docs


def _filter(index, at: int):
    def run(batches):
        ix = pickle.loads(index.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for a, _, data, off in tv.chunks(batch.column(at), lower=True):
                for doc, *_rest in ix.search(*normalise(data, off)):
                    keep[a + doc] = False
            yield batch.filter(pa.array(keep))

    return run
