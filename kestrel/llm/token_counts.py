"""Token counts (7): separator scan over flat token files without an index.

``write_token_files`` tokenises the documents of each task into one flat file:
all tokens in order, an end-of-document identifier after each document, stored
as fixed-size blocks of 16- or 32-bit numbers. No offsets are kept. The scan
finds the identifiers of each block with one vectorised comparison; a prefix
scan over the blocks' summaries gives each block its first document's ordinal
and the tokens that this document already had in the blocks before.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staging_path, text_of

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
EOD = 50_256               # free in that vocabulary
BLOCK_TOKENS = 1 << 16


# The white space of the vocabulary's pattern. Its matcher can't take back long runs of it, so these are cut out first.
BLANKS = re.compile("[\\t-\\r \\x85\\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


@cache
def _encodings(path: str):
    """The tokenizer, and the same one without its pattern: the whole input is one piece."""
    import tiktoken

    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # the pattern that belongs to the vocabulary
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tuple(tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for name, p in (("own", pattern), ("piece", r"[\s\S]+")))


def _encoding(path: str):
    """The tokenizer itself."""
    return _encodings(path)[0]


def encode(text: str, path: str = TOKENIZER) -> list[int]:
    """The text's tokens, also where it holds runs of white space of any length.

    The pattern takes such a run as one piece, less its last character if
    a word follows; nothing else reaches into it, so the parts are encoded on their own.
    """
    enc, piece = _encodings(path)
    out, at = [], 0
    for m in BLANKS.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        out += enc.encode_ordinary(text[at: m.start()])
        out += piece.encode_ordinary(text[m.start(): end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, eod: int = EOD,
                      block_tokens: int = BLOCK_TOKENS, path: str | None = None) -> str:
    """Write flat token files and return their folder.

    Rows: ``kind = 'block'`` with ``file_id, position`` (block number) and
    ``tokens`` (little-endian numbers); ``kind = 'doc'`` with ``file_id,
    position`` (ordinal of the document in its file) and ``doc_id`` (may be
    null). A null or empty text is a document of no tokens. The identifier is no
    token of the vocabulary, so no text yields it.
    """
    path = path or staging_path(docs.sparkSession, "tokens")
    width = np.dtype("<u2") if eod < 1 << 16 else np.dtype("<u4")

    def run(batches):
        file_id, ordinal, block, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def out(kind, position, ids, tokens):
            n = len(position)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n), pa.array([file_id] * n, pa.int32()), pa.array(position, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(tokens, pa.binary())], names=["kind", "file_id", "position", "doc_id", "tokens"])

        for batch in batches:
            ids = batch.column("id")
            yield out("doc", range(ordinal, ordinal + len(ids)), ids, [None] * len(ids))
            ordinal += len(ids)
            for text in batch.column("text"):
                held.append(np.array([*encode(text.as_py(), tokenizer), eod], dtype=width))
                size += len(held[-1])
                if size >= 8 * block_tokens:
                    flat = np.concatenate(held)
                    full = size // block_tokens
                    yield out("block", range(block, block + full), [None] * full,
                              [flat[i * block_tokens: (i + 1) * block_tokens].tobytes() for i in range(full)])
                    block, held = block + full, [flat[full * block_tokens:]]
                    size = len(held[0])
        if size:
            flat = np.concatenate(held)
            cut = range(0, size, block_tokens)
            yield out("block", range(block, block + len(cut)), [None] * len(cut), [flat[i: i + block_tokens].tobytes() for i in cut])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = src.mapInArrow(run, "kind string, file_id int, position long, doc_id long, tokens binary")
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return path


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = "file_id int, position long, doc_id long, tokens binary, kind string"
    return spark.read.schema(schema).parquet(path).where(F.col("kind") == kind)


def scan_separators(blocks: DataFrame, eod: int = EOD) -> DataFrame:
    """Per block: ``file_id, position, size, seps, lengths, tail``.

    ``lengths`` are the tokens before each separator since the last one or the
    block's start, ``tail`` those after the last separator.
    """
    width = np.dtype("<u2") if eod < 1 << 16 else np.dtype("<u4")

    def run(batches):
        for batch in batches:
            size, seps, lengths, tail = [], [], [], []
            for raw in batch.column("tokens"):
                t = np.frombuffer(raw.as_buffer(), dtype=width)
                at = np.flatnonzero(t == eod)
                size.append(len(t)), seps.append(len(at))
                lengths.append(np.diff(at, prepend=-1) - 1)
                tail.append(len(t) - (int(at[-1]) + 1 if len(at) else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_id"), batch.column("position"), pa.array(size, pa.int64()), pa.array(seps, pa.int64()),
                 pa.array(lengths, pa.list_(pa.int64())), pa.array(tail, pa.int64())],
                names=["file_id", "position", "size", "seps", "lengths", "tail"])

    return blocks.select("file_id", "position", "tokens").mapInArrow(
        run, "file_id int, position long, size long, seps long, lengths array<long>, tail long")


def stitch(scanned: DataFrame) -> DataFrame:
    """Prefix scan over a file's blocks: ``file_id, ordinal, n_tokens`` of every document.

    The tokens carried into a block are those since the last separator before
    it: the tail of the last block that has one and all tokens of the blocks
    between, from running sums and a running maximum.
    """
    w = Window.partitionBy("file_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)  # one row per block of a file
    s = scanned.withColumn("start", F.coalesce(F.sum("size").over(w), F.lit(0)))
    s = s.withColumn("after", F.when(F.col("seps") > 0, F.col("start") + F.col("size") - F.col("tail")))  # just past the last separator
    s = s.select("file_id", "lengths", F.coalesce(F.sum("seps").over(w), F.lit(0)).alias("first"),
                 (F.col("start") - F.coalesce(F.max("after").over(w), F.lit(0))).alias("carry"))
    e = s.select("file_id", "first", "carry", F.posexplode("lengths").alias("i", "n"))
    return e.select("file_id", (F.col("first") + F.col("i")).alias("ordinal"),
                    (F.col("n") + F.when(F.col("i") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, eod: int = EOD,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, n_tokens, file_id, ordinal`` of every row, counted from the flat files.

    Null and empty texts have 0 tokens; repeated rows and null ids keep a row
    each; an empty table gives an empty result; other columns are ignored.
    """
    path = write_token_files(docs, id_col, text_col, tokenizer, eod, block_tokens)
    counts = stitch(scan_separators(_read(docs.sparkSession, path, "block"), eod))
    names = _read(docs.sparkSession, path, "doc").select("file_id", F.col("position").alias("ordinal"), "doc_id")
    return names.join(counts, ["file_id", "ordinal"]).select("doc_id", "n_tokens", "file_id", "ordinal")
