"""Publish protocol (K1, K7, K8, DQ5) and streaming jobs."""
import datetime
import os

from pyspark.sql import functions as F

from kestrel.operators import cdc
from kestrel.plans.fixtures import Views
from kestrel.plans.q_load import stored_typed
from kestrel.sinks import publish
from kestrel.streaming import stream
from kestrel.operators.windows import event_windows

from .conftest import SF001


def _abstract_rows(spark):
    return spark.createDataFrame([("1", "retinol", 10), ("2", "retinol", 20), ("3", "arbutin", 9000)],
                                 "pmid string, ingredient_term string, abstract_length long")


def test_atomic_publish_commits_and_rolls_back(spark, scratch):
    path = os.path.join(scratch, "pubmed_evidence")
    df = _abstract_rows(spark)
    assert publish.atomic_publish(df, path, table="pubmed_evidence")
    assert publish.current_version(spark, path) == 1
    before = publish.read_current(spark, path).count()

    def boom():
        raise RuntimeError("simulated failure after the data write")

    bigger = df.unionByName(spark.createDataFrame([("4", "ceramide", 5)], df.schema))
    assert not publish.atomic_publish(bigger, path, table="pubmed_evidence", before_commit=boom)
    assert publish.current_version(spark, path) == 1          # failure left the table as it was
    assert publish.row_parity(spark, path, before)            # DQ5
    assert publish.atomic_publish(bigger, path, table="pubmed_evidence")   # retry reuses the number
    assert publish.current_version(spark, path) == 2
    assert publish.read_current(spark, path).count() == 4


def test_publish_rejects_failed_validation(spark, scratch):
    path = os.path.join(scratch, "pubmed_evidence")
    bad = spark.createDataFrame([(None, "retinol", 10)], "pmid string, ingredient_term string, abstract_length long")
    assert not publish.atomic_publish(bad, path, table="pubmed_evidence")
    assert publish.current_version(spark, path) is None
    missing = spark.createDataFrame([("1",)], "safetyreportid string")   # receivedate missing -> schema FAILED
    assert not publish.atomic_publish(missing, os.path.join(scratch, "ae"), table="adverse_events")


def test_full_load_replaces_and_drops_null_keys(spark, scratch):
    path = os.path.join(scratch, "cosing_staging")
    df = spark.createDataFrame([("A", "allowed"), (None, "banned")], "inci_name string, regulatory_status string")
    assert publish.full_load(df, path, "inci_name")
    assert publish.full_load(df.limit(1), path, "inci_name")
    assert [r.inci_name for r in publish.read_current(spark, path).collect()] == ["A"]


def test_write_report_csv(spark, scratch):
    out = os.path.join(scratch, "report")
    publish.write_report(spark.createDataFrame([("skin", 3)], "term string, count long"), out)
    parts = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0])) as fh:
        assert fh.read().splitlines() == ["term,count", "skin,3"]


def _land_events(spark, landing, n_files=3):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for i in range(n_files):
        ev.filter(F.col("event_id") % n_files == i).coalesce(1).write.parquet(os.path.join(landing, f"part{i}"))
    return ev


def test_stream_landing_exactly_once(spark, scratch):
    landing, target, ckpt = (os.path.join(scratch, x) for x in ("landing", "target", "ckpt"))
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.filter("event_id % 2 = 0").write.parquet(os.path.join(landing, "a"))
    schema = ev.schema
    src = os.path.join(landing, "*")
    stream.stream_landing(spark, src, schema, target, ckpt).awaitTermination()
    n1 = spark.read.parquet(target).count()
    stream.stream_landing(spark, src, schema, target, ckpt).awaitTermination()   # rerun adds nothing
    assert spark.read.parquet(target).count() == n1
    ev.filter("event_id % 2 = 1").write.parquet(os.path.join(landing, "b"))
    stream.stream_landing(spark, src, schema, target, ckpt).awaitTermination()   # only the new file
    assert spark.read.parquet(target).count() == ev.count()


def test_stream_cdc_equals_batch(spark, scratch):
    v = Views(spark, SF001)
    table, landing, ckpt = (os.path.join(scratch, x) for x in ("adverse_events", "landing", "ckpt"))
    stored = stored_typed(v)
    assert publish.atomic_publish(stored, table)
    inc = v.incoming()
    # two landing files, the second strictly later in sequence than the first
    cut = inc.select(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY seq)")).first()[0]
    inc.filter(F.col("seq") <= cut).coalesce(1).write.parquet(os.path.join(landing, "f1"))
    inc.filter(F.col("seq") > cut).coalesce(1).write.parquet(os.path.join(landing, "f2"))
    q = stream.stream_cdc(spark, os.path.join(landing, "*"), inc.schema, table, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    got = publish.read_current(spark, table)
    want = cdc.cdc_apply(stored, cdc.cdc_classify(stored, inc)).drop("last_change_seq")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert publish.current_version(spark, table) == 3        # one publish per micro-batch
    # a rerun finds no new files and publishes nothing
    stream.stream_cdc(spark, os.path.join(landing, "*"), inc.schema, table, ckpt).awaitTermination()
    assert publish.current_version(spark, table) == 3


def test_stream_dedupe_and_window_counts_match_batch(spark, scratch):
    landing = os.path.join(scratch, "landing")
    ev = _land_events(spark, landing)
    src = stream.landing_stream(spark, os.path.join(landing, "*"), ev.schema, max_files_per_trigger=1)
    reports = src.withColumn("rid", F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0))
    dq = (stream.stream_dedupe(reports, "rid", "ts", "30 days").writeStream.format("memory")
          .queryName("dedupe_out").outputMode("append").trigger(availableNow=True).start())
    dq.awaitTermination()
    want = ev.select((F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)).alias("rid")) \
             .distinct().count()
    assert spark.table("dedupe_out").select("rid").distinct().count() == want
    assert spark.table("dedupe_out").count() == want
    wq = (stream.stream_window_counts(src, "ts", "event_type", "1 day").writeStream.format("memory")
          .queryName("windows_out").outputMode("complete").trigger(availableNow=True).start())
    wq.awaitTermination()
    got = spark.table("windows_out").select("event_type", F.col("window_start").cast("timestamp_ntz"), "n_events")
    batch = event_windows(ev, "ts", "event_type").select("event_type", "window_start", "n_events")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_window_counts_append_mode_emits_closed_windows(spark, scratch):
    landing = os.path.join(scratch, "landing")
    ev = _land_events(spark, landing)
    src = stream.landing_stream(spark, os.path.join(landing, "*"), ev.schema)
    q = (stream.stream_window_counts(src, "ts", "event_type", "1 day", delay="1 hour").writeStream
         .format("memory").queryName("windows_append").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("windows_append").select("event_type", F.col("window_start").cast("timestamp_ntz"), "n_events")
    batch = event_windows(ev, "ts", "event_type").select("event_type", "window_start", "n_events", "window_end")
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(max_ts - datetime.timedelta(hours=1)))
    # every window that closed before the final watermark is emitted once, with the batch count
    assert got.exceptAll(closed.drop("window_end")).count() == 0
    assert closed.drop("window_end").exceptAll(got).count() == 0
    assert got.count() < batch.count()          # the still-open last windows are not emitted in append mode
