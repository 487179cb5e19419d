"""Vectorised text primitives for Arrow batches (numpy over the UTF-8 buffers).

Everything here works on a *chunk*: the concatenated UTF-8 bytes of some
documents plus their offsets. Chunks are cut at document borders and hold about
``CHUNK_BYTES`` bytes and at most ``CHUNK_ROWS`` documents, so the working memory of a task does not depend on how
many rows an Arrow batch has; one document is never split, so its length bounds
the chunk from below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 4096

_MUL = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse up to exponent ``n``."""
    global _pow, _inv
    if len(_pow) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            p = np.full(size, _MUL)
            p[0] = 1
            q = np.full(size, _INV)
            q[0] = 1
            _pow, _inv = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from mixed 64-bit values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``values[start:end]`` from one prefix sum of a polynomial."""
    p, q = _tables(len(values))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * p[: len(values)], out=sums[1:])
        out = (sums[ends] - sums[starts]) * q[starts]
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chunks(texts: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, last row + 1, bytes, offsets)`` over an Arrow string column.

    Nulls count as empty texts. ``offsets`` has one entry more than rows and
    starts at 0.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.utf8_lower(texts)
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + chunk_bytes, side="right")) - 1)
        b = min(b, a + CHUNK_ROWS)
        yield a, b, raw[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each word, start, end) for words ``[^\\x20\\x09-\\x0D]+``."""
    return spans(~is_space(data), offsets)


def spans(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each word, start, end) where ``word`` flags the bytes of words."""
    if not len(word):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(word))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return doc, starts, ends


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document of each word, 64-bit hash of each word)."""
    doc, starts, ends = word_spans(data, offsets)
    return doc, span_hashes(data, starts, ends)


def shingles(doc: np.ndarray, word_hash: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document of each shingle, its hash): runs of ``width`` words inside a document.

    A document of fewer words has one shingle of all its words, an empty one none.
    """
    counts = np.bincount(doc, minlength=n_docs) if len(doc) else np.zeros(n_docs, dtype=np.int64)
    base = np.concatenate(([0], np.cumsum(counts)))
    per_doc = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(n_docs), per_doc)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    starts = base[owner] + rank
    ends = np.minimum(starts + width, base[owner + 1])
    return owner, span_hashes(word_hash, starts, ends)
