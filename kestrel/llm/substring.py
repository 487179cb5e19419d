"""Substring dedup (4): content-defined chunks with a gear rolling hash.

The gear hash of a byte position depends on the last 16 bytes only. A position
ends a chunk where its hash is the strict maximum within ``RADIUS`` positions to
either side, so cuts depend on nearby content alone: an insertion moves the
cuts around it and no others. Chunks are deduplicated by digest; a run of
neighbouring repeated chunks is a repeated passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import fresh, row_key, staged, text_of

RADIUS = 28          # least distance of two cuts; chunks have 57 bytes on average
MAX_CHUNK = 160      # a longer stretch without a cut repeats itself and is cut by its period, else at this length
MIN_WORDS = 20       # words in whole repeated chunks that make a passage; a passage of 50 words holds more

# gear table: one pseudo-random 16-bit value per byte
_GEAR = (tv.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling gear hash (16 bits, so a window of 16 bytes) at every byte, by doubling."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint16(step) if len(h) > step else 0
        h = nxt
    return h


def _window_max(x: np.ndarray, width: int) -> np.ndarray:
    """out[i] = max(x[i : i + width]), cut at the end."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if len(out) > step:
            out[:-step] = np.maximum(out[:-step], out[step:])
        have += step
    return out


def cut_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """End positions of all chunks of the documents in one buffer, document ends included."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    h = gear(data).astype(np.int32) + 1
    pad = np.zeros(RADIUS + 1, dtype=np.int32)
    ahead = _window_max(np.concatenate((h[1:], pad)), RADIUS)[:n]
    behind = _window_max(np.concatenate((pad[1:], h)), RADIUS)[:n]
    cand = (h > ahead) & (h > behind)
    pos = np.flatnonzero(cand) + 1
    doc = np.searchsorted(offsets, pos - 1, side="right") - 1
    # what is compared, the gear window included, lies inside the document
    inside = (pos - 1 - offsets[doc] >= RADIUS + 15) & (offsets[doc + 1] - pos >= RADIUS)
    ends = np.unique(np.concatenate((pos[inside], offsets[1:][np.diff(offsets) > 0])))
    starts = np.concatenate(([0], ends[:-1]))
    long = np.flatnonzero(ends - starts > MAX_CHUNK)
    if len(long):
        ends = np.unique(np.concatenate([ends, *(_periodic_cuts(h, starts[i], ends[i]) for i in long)]))
        starts = np.concatenate(([0], ends[:-1]))
        long = np.flatnonzero(ends - starts > MAX_CHUNK)
        ends = np.unique(np.concatenate([ends, *(np.arange(starts[i] + MAX_CHUNK, ends[i], MAX_CHUNK) for i in long)]))
    return ends


def _periodic_cuts(h: np.ndarray, start: int, end: int) -> np.ndarray:
    """Cuts after the greatest hash of a stretch, more than ``RADIUS`` apart.

    A text that repeats a short unit has ties instead of strict maxima; its cuts
    then depend on the unit, not on where the stretch begins.
    """
    inner = h[start + 15: end]
    top = start + 15 + np.flatnonzero(inner == inner.max()) + 1
    out, at = [], start - RADIUS
    while True:
        i = int(np.searchsorted(top, at + RADIUS, side="right"))
        if i == len(top) or top[i] >= end:
            return np.array(out, dtype=np.int64)
        at = int(top[i])
        out.append(at)


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, rk, digest, start, size, words`` of every chunk (byte positions in the UTF-8 text)."""

    def run(batches):
        for batch in batches:
            ids, rks = batch.column("id"), batch.column("rk")
            for a, b, data, off in tv.chunks(batch.column("text")):
                ends = cut_points(data, off)
                starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                doc = np.searchsorted(off, starts, side="right") - 1
                word = ~tv.is_space(data)
                word[1:] &= ~word[:-1]  # word starts; a word cut by a border counts where it starts
                count = np.concatenate(([0], np.cumsum(word)))
                take = pa.array(a + doc)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), rks.take(take), pa.array(tv.span_hashes(data, starts, ends).view(np.int64)),
                     pa.array((starts - off[doc]).astype(np.int64)), pa.array((ends - starts).astype(np.int32)),
                     pa.array((count[ends] - count[starts]).astype(np.int32))],
                    names=["id", "rk", "digest", "start", "size", "words"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("rk"), text_of(text_col).alias("text"))
    return src.mapInArrow(run, "id long, rk long, digest long, start long, size int, words int")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that occur earlier: ``id, rk, start, end, words, first_id``.

    The first occurrence of a chunk is the one with the smallest (id, row key,
    position), null ids last; it stays. Neighbouring chunks of one text that
    are not first form a run; runs of at least ``min_words`` words are passages
    (bytes ``start`` to ``end`` of the UTF-8 text, whole characters).
    ``first_id`` is the id that holds the first occurrence of the run's first
    chunk (the same id when a text repeats itself).

    Rows equal in id and text are one text; null and empty texts have no
    passage; an empty table gives an empty result.
    """
    chunks = staged(chunk_table(docs, id_col, text_col), "chunks")
    # rows first by id; the partial aggregate folds a hot chunk inside each map task
    dups = (chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
            .where("n > 1").drop("n"))
    occ = staged(chunks.join(dups, "digest"), "repeated")
    at_first = occ.where(F.col("id").eqNullSafe(F.col("first_id")))
    rk = at_first.groupBy("digest").agg(F.min("rk").alias("first_rk"))
    start = (at_first.join(rk, "digest").where("rk = first_rk").groupBy("digest")
             .agg(F.min("first_rk").alias("first_rk"), F.min("start").alias("first_start")))
    later = (occ.join(start, "digest")
             .where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("rk") == F.col("first_rk"))
                      & (F.col("start") == F.col("first_start"))))
             .select("id", "rk", "start", "size", "words", "first_id").dropDuplicates(["id", "rk", "start"]))
    w = Window.partitionBy("id", "rk").orderBy("start")  # one text's chunks: bounded by the text itself
    before = F.lag(F.col("start") + F.col("size")).over(w)
    runs = (later.withColumn("gap", F.when(before == F.col("start"), 0).otherwise(1))
            .withColumn("run", F.sum("gap").over(w)))
    return (runs.groupBy("id", "rk", "run")
            .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"),
                 F.sum("words").alias("words"), F.min_by("first_id", "start").alias("first_id"))
            .where(F.col("words") >= min_words).drop("run"))


def _trim(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the byte spans; a character cut by a border goes with its span's outside."""
    out, at = [], 0
    for s, e in sorted(spans):
        while s < len(text) and (text[s] & 0xC0) == 0x80:
            s += 1
        while e < len(text) and (text[e] & 0xC0) == 0x80:
            e += 1
        out.append(text[at:s])
        at = max(at, e)
    out.append(text[at:])
    return b"".join(out)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut out but its first occurrence.

    Same columns and rows as ``docs``; only ``text_col`` changes (see
    ``repeated_spans``). A text that held nothing else becomes empty.
    """
    spans = staged(repeated_spans(docs, id_col, text_col, min_words), "spans")
    rk, cut = fresh(docs, "_rk"), fresh(docs, "_cut")
    per_doc = spans.groupBy(F.col("rk").alias(rk)).agg(F.collect_set(F.struct("start", "end")).alias(cut))  # spans of one text

    @F.pandas_udf("string")
    def trimmed(text, spans):
        return text.combine(spans, lambda t, s: _trim(t.encode(), [(x["start"], x["end"]) for x in s]).decode())

    joined = docs.withColumn(rk, row_key(id_col, text_col)).join(per_doc, rk, "left")
    # two branches, so that only texts with a passage go through Python
    same = joined.where(F.col(cut).isNull()).select(*docs.columns)
    less = joined.where(F.col(cut).isNotNull()).withColumn(text_col, trimmed(F.col(text_col), F.col(cut))).select(*docs.columns)
    return same.unionByName(less)
