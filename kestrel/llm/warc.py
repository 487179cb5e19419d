"""WARC (10): archives written and read back as a chunked record table.

Payloads longer than ``SEGMENT_BYTES`` are split into continuation records, so
no record, row or buffer holds a whole oversized payload. Spark's text writer
makes the files (a record is a value, the blank lines after it the line
separator) and its text reader streams them back line by line; a small state
machine turns the lines into rows of record identifier and chunk number with a
running SHA-1.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staging_path

REVISIT_BYTES = 1000        # least payload that a revisit record may stand for
SEGMENT_BYTES = 1 << 20     # payload bytes of one record
CHUNK_BYTES = 1 << 16       # payload bytes of one row of the record table
DATE = "2024-01-01T00:00:00Z"   # WARC-Date of records without one


def plan_records(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None = None) -> DataFrame:
    """``id, url, payload, sha1, size, refers_to`` (null for a response) of every row.

    Of equal payloads of at least ``REVISIT_BYTES`` bytes the largest id is the
    response; rows that tie for it are all responses. Null ids come below all
    others. A null payload is empty.
    """
    src = (pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
                        F.regexp_replace(F.coalesce(F.col(url_col) if url_col else F.lit(None).cast("string"), F.lit("")), r"[\r\n]", "").alias("url"))
           .withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")}))
    heads = (src.where(F.col("size") >= REVISIT_BYTES).groupBy("sha1", "size")
             .agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = src.join(heads, ["sha1", "size"], "left")
    return joined.withColumn("refers_to", F.when(F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head")), F.col("head"))).drop("head")


def _uuid(*cols: Column) -> Column:
    h = F.md5(F.concat_ws("/", *cols))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write one response or revisit record per row of ``plan_records``, gzip files of WARC/1.1.

    Record identifiers derive from id and payload; repeated rows repeat them.
    ``Page-ID`` is an extension field. The HTTP header of a revisit tells the
    payload's length.
    """
    lines = lambda *xs: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    id_text = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    one = records.withColumns({
        "rid": _uuid(id_text, F.col("sha1")),
        "http": lines("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("size").cast("string"), "\r\n\r\n"),
        "parts": F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / segment_bytes))).cast("int"),
    })
    # the segments of a payload follow each other in one task and so in one file
    seg = one.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    piece = F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(
        F.col("payload").substr((F.col("part") - 1) * segment_bytes + 1, F.lit(segment_bytes)))
    seg = seg.withColumn("piece", piece)
    head = lambda name, value: lines(f"{name}: ", value, "\r\n")
    block_size = F.octet_length("piece") + F.when(F.col("part") == 1, F.octet_length("http")).otherwise(0)
    first = lines(
        head("WARC-Type", F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")),
        head("WARC-Record-ID", F.col("rid")), head("WARC-Date", F.lit(DATE)),
        head("WARC-Target-URI", F.col("url")), head("Page-ID", id_text),
        head("WARC-Payload-Digest", lines("sha1:", F.col("sha1"))),
        F.when(F.col("refers_to").isNotNull(),
               lines("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n",
                     "WARC-Refers-To: ", _uuid(F.col("refers_to").cast("string"), F.col("sha1")),
                     "\r\nRefers-To-Page-ID: ", F.col("refers_to").cast("string"), "\r\n")).otherwise(""),
        F.when(F.col("parts") > 1, "WARC-Segment-Number: 1\r\n").otherwise(""),
        "Content-Type: application/http; msgtype=response\r\n")
    more = lines(head("WARC-Type", F.lit("continuation")), head("WARC-Record-ID", _uuid(F.col("rid"), F.col("part").cast("string"))),
                 head("WARC-Date", F.lit(DATE)), head("WARC-Segment-Origin-ID", F.col("rid")),
                 head("WARC-Segment-Number", F.col("part").cast("string")),
                 F.when(F.col("part") == F.col("parts"), head("WARC-Segment-Total-Length", (F.col("size") + F.octet_length("http")).cast("string"))).otherwise(""))
    header = lines("WARC/1.1\r\n", F.when(F.col("part") == 1, first).otherwise(more), head("Content-Length", block_size.cast("string")), "\r\n",
                   F.when(F.col("part") == 1, F.col("http")).otherwise(""))
    value = F.concat(header.cast("binary"), F.col("piece")).cast("string").alias("value")
    seg.select(value).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


class _Reader:
    """State machine over the lines of one archive file; emits rows of the record table."""

    COLUMNS = ("file", "record_id", "record_no", "chunk_no", "record_type", "uri", "page_id", "refers_to", "digest", "http_length",
               "data", "size", "running_sha1", "last")

    def __init__(self, file: str, chunk_bytes: int, with_data: bool):
        self.file, self.chunk_bytes, self.with_data = file, chunk_bytes, with_data
        self.record_no, self.rows = -1, []
        self.open = None       # the logical record that payload bytes go to
        self.header = None     # header lines of the record that begins, or None between records
        self.left = 0          # bytes of the block still to come
        self.http = None       # bytes of the HTTP header so far, or None when past it

    def feed(self, line: bytes) -> None:
        """One line with its line end."""
        while line:
            if self.left:
                take, line = line[: self.left], line[self.left:]
                self.left -= len(take)
                self._block(take)
            elif self.header is None:
                if not line.strip():
                    return
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{self.file}: no record begins with {line[:40]!r}")
                self.header, line = {}, b""
            elif line == b"\r\n" or line == b"\n":
                self._begin()
                line = b""
            else:
                name, _, value = line.decode("utf-8").partition(":")
                self.header[name.strip().lower()] = value.strip()
                line = b""

    def _begin(self) -> None:
        h, self.header = self.header, None
        self.left = int(h.get("content-length", "0"))
        kind = h.get("warc-type", "")
        if kind != "continuation":
            self._close()
            self.record_no += 1
            self.open = {"record_id": h.get("warc-record-id"), "record_type": kind, "uri": h.get("warc-target-uri"),
                         "page_id": _number(h.get("page-id")), "refers_to": _number(h.get("refers-to-page-id")), "digest": h.get("warc-payload-digest"), "http_length": None,
                         "chunk_no": 0, "sha1": hashlib.sha1(), "held": bytearray()}
            self.http = bytearray() if "application/http" in h.get("content-type", "") else None
        elif self.open is None or h.get("warc-segment-origin-id") != self.open["record_id"]:
            raise ValueError(f"{self.file}: a continuation doesn't follow its record")

    def _block(self, data: bytes) -> None:
        if self.http is not None:
            self.http += data
            if self.http.endswith(b"\r\n\r\n"):
                for row in bytes(self.http).split(b"\r\n"):
                    if row.lower().startswith(b"content-length:"):
                        self.open["http_length"] = int(row.split(b":")[1])
                self.http = None
            return
        o = self.open
        o["sha1"].update(data)
        o["held"] += data
        while len(o["held"]) > self.chunk_bytes:
            self._row(bytes(o["held"][: self.chunk_bytes]), False)
            del o["held"][: self.chunk_bytes]

    def _row(self, data: bytes, last: bool) -> None:
        o = self.open
        self.rows.append((self.file, o["record_id"], self.record_no, o["chunk_no"], o["record_type"], o["uri"], o["page_id"], o["refers_to"], o["digest"],
                          o["http_length"], data if self.with_data else None, len(data), o["sha1"].hexdigest() if last else None, last))
        o["chunk_no"] += 1

    def _close(self) -> None:
        if self.open is not None:
            self._row(bytes(self.open["held"]), True)
            self.open = None

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
                 pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(self.COLUMNS))


RECORD_TABLE = ("file string, record_id string, record_no long, chunk_no int, record_type string, uri string, page_id long, refers_to long, digest string, "
                "http_length long, data binary, size long, running_sha1 string, last boolean")


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of all archives (``.gz``) below ``path``.

    One row per record and chunk of at most ``chunk_bytes`` payload bytes:
    ``file, record_id, record_no`` (in its file), ``chunk_no, record_type, uri,
    page_id, refers_to, digest`` (as written), ``http_length, data, size,
    running_sha1`` (of the whole payload, on the last chunk) and ``last``. An
    empty payload has one empty chunk. Gzip files aren't split, so one task sees
    a file's lines in order; memory holds a line and a chunk. ``with_data``
    false leaves the bytes out.
    """

    def run(batches):
        reader = None
        for batch in batches:
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                if reader is None or reader.file != file:
                    if reader is not None:
                        reader._close()
                        yield reader.take()
                    reader = _Reader(file, chunk_bytes, with_data)
                reader.feed(line.as_py() + b"\n")
                if len(reader.rows) >= 256:
                    yield reader.take()
        if reader is not None:
            reader._close()
            yield reader.take()

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(run, RECORD_TABLE)


def archive_pages(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
                  path: str | None = None) -> DataFrame:
    """Write every row as a WARC record, read the archives back, and describe each record.

    ``id, payload_bytes, payload_digest, record_type, refers_to, file,
    record_no, chunks``. For a response the bytes and the SHA-1 are counted
    from what was read; a revisit holds no payload, so they are those that its
    headers tell. Empty tables give an empty result; null payloads are empty;
    null ids stay null; repeated rows are records of their own.
    """
    spark = pages.sparkSession
    path = path or staging_path(spark, "warc")
    write_archives(plan_records(pages, id_col, payload_col, url_col), path)
    table = read_archives(spark, path, with_data=False)
    revisit = F.col("record_type") == "revisit"
    ends = table.where("last")  # sizes of earlier chunks are full
    return ends.select(
        F.col("page_id").alias("id"),
        F.when(revisit, F.col("http_length")).otherwise(F.col("chunk_no") * CHUNK_BYTES + F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.substring("digest", 6, 40)).otherwise(F.col("running_sha1")).alias("payload_digest"),
        "record_type", "refers_to", "file", "record_no", (F.col("chunk_no") + 1).alias("chunks"))
