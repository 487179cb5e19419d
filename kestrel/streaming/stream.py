"""Structured Streaming jobs.

The batch jobs poll; here new landing files are picked up by a file-source
stream whose progress lives in a checkpoint folder on shared storage, so a
restarted (or failed) run resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.constants import WINDOW_RECORD_CEILING
from ..operators import cdc
from ..session import scratch_root
from ..sinks import publish


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """A stream's checkpoint folder under the session's shared ``spark.checkpoint.dir``."""
    return f"{scratch_root(spark)}/streams/{name}"


def landing_stream(spark: SparkSession, source_dir: str, schema, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over a landing folder (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    return reader.load(source_dir)


def stream_landing(spark: SparkSession, source_dir: str, schema, target_dir: str, checkpoint_dir: str | None = None,
                   fmt: str = "parquet") -> StreamingQuery:
    """Copy every new landing file into the target table once.

    The file sink plus checkpoint is exactly-once: a rerun with no new files
    adds nothing; a run that died mid-way resumes from its last batch.
    ``trigger(availableNow)`` processes what is there and stops.
    """
    df = landing_stream(spark, source_dir, schema, fmt)
    ckpt = checkpoint_dir or default_checkpoint(spark, "landing")
    return (df.writeStream.format("parquet").option("path", target_dir)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start())


EVENT_SCHEMA = "safetyreportid string, ingredient_term string, receivedate date"


def stream_cdc(spark: SparkSession, source_dir: str, schema, table_path: str, checkpoint_dir: str | None = None,
               fmt: str = "parquet", max_files_per_trigger: int | None = 1000, buckets: int = publish.DEFAULT_BUCKETS) -> StreamingQuery:
    """R2: every micro-batch of incoming reports goes through CD1/CD2 and is published (K8).

    The table is bucketed by report id: a batch, of many landing files,
    reads and rewrites only the buckets of its ids (a table published without buckets is laid out once).
    Idempotent by batch id: the commit marker records the batch; a replayed
    batch (the stream died after publishing, before checkpointing) is
    skipped, so no change is applied twice. Rows are validated with
    the adverse-events rules while they are written.
    """

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        store = publish.CommitLog(spark, table_path)
        found = store.snapshot()
        if found is not None and found.batch_id is not None and found.batch_id >= batch_id:
            return
        batch = batch.persist()     # read once for the touched buckets and for the merge
        try:
            def merge(stored: DataFrame) -> DataFrame:
                return cdc.cdc_apply(stored, cdc.cdc_classify(stored, batch)).select("safetyreportid", "ingredient_term", "receivedate")

            known = batch.where(F.col("safetyreportid").isNotNull() & (F.col("safetyreportid") != ""))
            change = publish.merge_by_key(store, "", known, "safetyreportid", merge, EVENT_SCHEMA, buckets, "adverse_events")
            if not store.commit({"": change}, batch_id=batch_id):
                raise RuntimeError(f"publish of batch {batch_id} failed; the batch will be retried")
        finally:
            batch.unpersist()

    df = landing_stream(spark, source_dir, schema, fmt, max_files_per_trigger)
    ckpt = checkpoint_dir or default_checkpoint(spark, "cdc")
    return (df.writeStream.foreachBatch(apply_batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): reinterpret wall-clock time as UTC."""
    dtype = df.schema[ts].dataType.typeName()
    return df.withColumn(ts, F.col(ts).cast("timestamp")) if dtype == "timestamp_ntz" else df


def stream_dedupe(df: DataFrame, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """First sighting of each report id, with duplicates arriving up to ``delay`` late.

    State per id is dropped once the watermark passes, so state stays
    bounded by the ids seen within ``delay``.
    """
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_window_counts(df: DataFrame, ts: str, key: str, duration: str = "1 day", delay: str = "1 hour",
                         ceiling: int = WINDOW_RECORD_CEILING) -> DataFrame:
    """Tumbling event-time counts per key with the paging-ceiling flag (batch twin: event_windows)."""
    e = event_time(df, ts).withWatermark(ts, delay)
    counts = e.groupBy(F.window(ts, duration).alias("w"), key).agg(F.count(F.lit(1)).alias("n_events"))
    return counts.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "n_events", (F.col("n_events") > ceiling).alias("over_ceiling"))
