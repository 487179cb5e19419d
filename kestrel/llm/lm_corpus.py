"""LM scoring (8) of a whole corpus by its own models: counts are asked for and answered in blocks.

Same models and scores as ``lm_score.train`` with ``lm_score.score_documents`` on one
corpus, without a row per word pair. The texts are tokenised once into chunks
(about ``CHUNK_BYTES`` of text each): distinct word keys in order and the
documents as numbers of these. A chunk asks for the counts of its distinct
keys: per range of the key space (part) it sends one block of sorted keys, as
compressed differences, with its own counts. The part's task adds up all chunks' counts and
answers every block with the totals in the block's order, about a byte a key. Words come
first, so that a chunk knows which of its words the vocabulary lacks; then
pairs of tokens; then every chunk scores its documents by itself.

A key occurs once per chunk however frequent it is, so no part is hot; parts
hold about ``PART_KEYS`` asked keys, a task one part or one chunk at a time.
All tables grow with the corpus and none is gathered but the 16 shape classes and the totals.
The chunks are stored bucketed by their number, so answers are joined to them without moving them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import staged, staging_path, text_of
from .lm_score import ADD, EDGE, MIN_COUNT, SHAPES, WEIGHT, _pair_key, word_keys

CHUNK_BYTES = 5 << 20
PART_KEYS = 2_000_000

ASK = "part int, chunk long, keys binary, b binary, t binary"
ANSWER = "chunk long, part int, b binary, t binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width])
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    planes = np.zeros((8, n), dtype=np.uint8)
    if n:
        planes[:width] = np.frombuffer(pa.decompress(raw[9:], decompressed_size=n * width, codec="zstd", asbytes=True), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``chunk, ids, sizes, keys, tokens``: the documents' ids and token counts, the chunk's distinct word keys, most frequent first, all tokens as their numbers."""

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, data, off in tv.chunks(batch.column("text"), lower=True, chunk_bytes=CHUNK_BYTES):
                doc, key = word_keys(data, off)
                keys, tokens, n = np.unique(key, return_inverse=True, return_counts=True)
                order = np.argsort(-n, kind="stable")     # small numbers for frequent words take less room
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                keys, tokens = keys[order], rank[tokens]
                sizes = np.bincount(doc, minlength=b - a)
                ids = batch.column("id").slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([pack(sizes)]), pa.array([keys.tobytes()]),
                     pa.array([pack(tokens)])], ["chunk", "ids", "sizes", "keys", "tokens"])
                chunk += 1

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = src.mapInArrow(run, "chunk long, ids array<long>, sizes binary, keys binary, tokens binary")
    name, n = f"lm_chunks_{uuid.uuid4().hex}", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(n, "chunk").sortBy("chunk").option("path", staging_path(docs.sparkSession, name)).saveAsTable(name)
    return docs.sparkSession.table(name)


def _chunk(r: dict):
    """Sorted distinct keys, all tokens as numbers of these, the documents' sizes."""
    keys = np.frombuffer(r["keys"], dtype=np.uint64)
    order = np.argsort(keys)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return keys[order], rank[unpack(r["tokens"]).astype(np.int64)], unpack(r["sizes"]).astype(np.int64)


def _blocks(chunk: int, keys: np.ndarray, b: np.ndarray, t: np.ndarray, bits: int) -> pa.RecordBatch:
    """The ask of one chunk: sorted ``keys`` with its counts, cut into ``2**bits`` ranges of the key space."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cut = np.flatnonzero(np.diff(part)) + 1
    pieces = [(part[i], i, j) for i, j in zip([0, *cut], [*cut, len(keys)]) if j > i]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, *_ in pieces], pa.int32()), pa.array([chunk] * len(pieces), pa.int64()), pa.array([pack_keys(keys[i:j]) for _, i, j in pieces], pa.binary()),
         pa.array([pack(b[i:j]) for _, i, j in pieces], pa.binary()), pa.array([pack(t[i:j]) for _, i, j in pieces], pa.binary())],
        ["part", "chunk", "keys", "b", "t"])


def _counts(tokens: np.ndarray, sizes: np.ndarray, target: list[int] | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each of ``n`` numbers occurs in all documents and in the target ones."""
    mine = np.zeros(len(sizes), dtype=bool)
    mine[target or []] = True
    return np.bincount(tokens, minlength=n), np.bincount(tokens[np.repeat(mine, sizes)], minlength=n)


def _ask_words(bits: int):
    def run(batches):
        for batch in batches:
            for r in _rows(batch):
                keys, tokens, sizes = _chunk(r)
                yield _blocks(r["chunk"], keys, *_counts(tokens, sizes, r["target"], len(keys)), bits)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row after the other, so that only one is held as Python objects."""
    for i in range(batch.num_rows):
        yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of sorted batches, all those of one key at a time."""
    held: list[dict] = []
    for batch in batches:
        for r in _rows(batch):
            if held and held[0][key] != r[key]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _totals(batches):
    """Per part: every block answered with the totals of its keys; a row of chunk null has the part's own sums."""
    for rows in _groups(batches, "part"):
        keys = [unpack_keys(r["keys"]) for r in rows]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        b, t = (np.bincount(at, weights=np.concatenate([unpack(r[c]) for r in rows]).astype(np.float64), minlength=len(distinct)).astype(np.uint64) for c in "bt")
        ends = np.cumsum([len(k) for k in keys])
        part, chunks = rows[0]["part"], [r["chunk"] for r in rows]
        bs, ts = ([pack(x[at[e - len(k): e]]) for k, e in zip(keys, ends)] for x in (b, t))
        # for words: totals of all, the vocabulary's size, and what the rarer words of each shape add up to
        rare = (b < MIN_COUNT) & (distinct != EDGE)
        shape = (distinct[rare] & np.uint64(15)).astype(np.int64)
        sums = [int(b.sum()), int(t.sum()), int((~rare & (distinct != EDGE)).sum())]
        by_shape = [np.bincount(shape, weights=x[rare].astype(np.float64), minlength=SHAPES).astype(np.uint64) for x in (b, t)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*chunks, None], pa.int64()), pa.array([part] * (len(rows) + 1), pa.int32()),
             pa.array([*bs, pack(np.concatenate([np.array(sums, dtype=np.uint64), *by_shape]))], pa.binary()), pa.array([*ts, None], pa.binary())],
            ["chunk", "part", "b", "t"])


def _answered(asks: DataFrame, n_parts: int) -> DataFrame:
    """Totals for every block, a task handling one part after the other."""
    return asks.repartition(n_parts, "part").sortWithinPartitions("part", "chunk").mapInArrow(_totals, ANSWER)


def _with(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """The chunks with their answers, an array in the order of parts; the answers are dealt to the chunks' buckets."""
    mine = answers.where("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "b", "t"))).alias(name))
    return chunks.join(mine.hint("merge"), "chunk")


def _read_chunk(r: dict, classes: tuple[np.ndarray, np.ndarray]):
    """``sizes``, per token of the chunk its word's number, and per distinct word (token, ub, ut)."""
    keys, tokens, sizes = _chunk(r)
    ub, ut = (np.concatenate([unpack(x[c]) for x in r["words"]]) for c in "bt")
    rare = (ub < MIN_COUNT) & (keys != EDGE)
    shape = (keys & np.uint64(15)).astype(np.int64)
    token = np.where(rare, shape.astype(np.uint64) + np.uint64(1), keys)
    return sizes, tokens, token, np.where(rare, classes[0][shape], ub), np.where(rare, classes[1][shape], ut)


def _pairs(tokens: np.ndarray, sizes: np.ndarray, token: np.ndarray):
    """Distinct pair keys of the chunk and, per token, the number of its pair and the word before it (-1: the opening edge)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = np.cumsum(sizes) - sizes
    before[starts] = -1
    first = np.where(before < 0, np.uint64(EDGE), token[before])
    keys, at = np.unique(_pair_key(first, token[tokens]), return_inverse=True)
    return keys, at, before


def _ask_pairs(bits: int, classes):
    def run(batches):
        for r in (r for batch in batches for r in _rows(batch)):
            sizes, tokens, token, _, _ = _read_chunk(r, classes)
            keys, at, _ = _pairs(tokens, sizes, token)
            yield _blocks(r["chunk"], keys, *_counts(at, sizes, r["target"], len(keys)), bits)

    return run


def _score(classes, nb: int, nt: int, types: int):
    def run(batches):
        for r in (r for batch in batches for r in _rows(batch)):
            sizes, tokens, token, ub, ut = _read_chunk(r, classes)
            _, at, before = _pairs(tokens, sizes, token)
            pb, pt = (np.concatenate([unpack(x[c]) for x in r["pairs"]])[at].astype(np.float64) for c in "bt")
            # the opening edge is as frequent as the closing one, which ends every document and has the smallest key
            context = np.maximum(before, 0)

            def loss(pair, n, total):
                alone = (n[tokens] + ADD) / (total + ADD * types)
                of = n[context]
                big = np.divide(pair, of, out=alone.copy(), where=of > 0)
                return -np.log(WEIGHT * big + (1 - WEIGHT) * alone)

            lt, lb = loss(pt, ut.astype(np.float64), nt), loss(pb, ub.astype(np.float64), nb)
            starts = np.cumsum(sizes) - sizes
            st, sb = np.add.reduceat(lt, starts) / sizes, np.add.reduceat(lb, starts) / sizes
            yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(sizes), pa.array(st), pa.array(sb), pa.array(st - sb)],
                                             ["id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def score_corpus(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, target_loss, background_loss, score`` of every row of ``docs``.

    The target model counts the rows whose id is in ``target_ids`` (its first
    column), the background model all rows. Losses are means per token; below zero the score reads like the target.

    Edge cases: the closing edge is a token, so a null or empty text has one; a
    null id is in no target; rows that repeat are counted and returned as often; repeated
    target ids count once; without targets the target losses are those of an even distribution over
    the vocabulary; texts are never cut (one text is within a chunk whatever its length); an empty table gives none; other columns aren't read.
    """
    spark = docs.sparkSession
    chunks = chunk_table(docs, id_col, text_col)
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    # only ids travel to the target's ids, not texts; a list of at most CHUNK_ROWS numbers per chunk comes back
    flagged = (chunks.select("chunk", F.posexplode("ids").alias("pos", "id")).join(ids, "id", "left_semi")
               .groupBy("chunk").agg(F.collect_list("pos").alias("target")))
    flagged = chunks.join(staged(flagged, "lm-targets").hint("merge"), "chunk", "left")
    n_chunks, n_bytes = chunks.agg(F.count(F.lit(1)), F.sum(F.octet_length("tokens"))).first()
    if not n_chunks:
        return spark.createDataFrame([], "id long, n_tokens long, target_loss double, background_loss double, score double")
    # a token takes a byte or more of its chunk: at most so many keys are asked for
    bits = max(4, int(2 * n_bytes // PART_KEYS).bit_length())
    n_parts = min(1 << bits, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 4))
    words = staged(_answered(flagged.select("chunk", "sizes", "keys", "tokens", "target").mapInArrow(_ask_words(bits), ASK), n_parts), "lm-words")
    sums = sum(unpack(r["b"]).astype(np.int64) for r in words.where("chunk IS NULL").select("b").toLocalIterator())
    nb, nt, vocabulary = (int(x) for x in sums[:3])
    classes = (sums[3: 3 + SHAPES].astype(np.uint64), sums[3 + SHAPES:].astype(np.uint64))
    asks = _with(flagged, words, "words").select("chunk", "sizes", "keys", "tokens", "target", "words").mapInArrow(_ask_pairs(bits, classes), ASK)
    answered = _with(_with(chunks, words, "words"), _answered(asks, n_parts), "pairs")
    return answered.select("ids", "sizes", "keys", "tokens", "words", "pairs").mapInArrow(
        _score(classes, nb, nt, vocabulary + 1 + SHAPES), "id long, n_tokens long, target_loss double, background_loss double, score double")
