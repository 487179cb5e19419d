"""End to end: landing report files -> clean -> incremental load -> publish -> CDC -> publish."""
import json
import os

from pyspark.sql import functions as F

from kestrel.operators import cdc, clean, load
from kestrel.sinks import publish
from kestrel.sources import files


def _land(directory, name, records):
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, name), "w") as fh:
        json.dump(records, fh)


def test_reports_pipeline(spark, scratch):
    landing = os.path.join(scratch, "raw")
    table = os.path.join(scratch, "adverse_events")
    _land(landing, "openfda_retinol_2024-01-10.json", [
        {"safetyreportid": "100", "receivedate": "20240102", "patient": {"sex": 2}},
        {"safetyreportid": "101", "receivedate": "20240103"},
        {"safetyreportid": "101", "receivedate": "20240104"},          # duplicate id: first one kept
        {"safetyreportid": "102", "receivedate": "29990101"},          # future: dropped
    ])
    _land(landing, "openfda_vitamin_c_2024-01-10.json", [{"safetyreportid": "200", "receivedate": "20240105"}])

    raw = files.read_reports(spark, landing)
    # explicit first-wins order: landing file, then position in the file
    parsed = clean.plausible_dates(raw, "receivedate", "2024-01-25", "receivedate_parsed")
    batch = parsed.select("source_file", "record_pos", "safetyreportid", "ingredient_term",
                          F.col("receivedate_parsed").alias("receivedate"))
    empty = spark.createDataFrame([], "safetyreportid string, ingredient_term string, receivedate date")
    first = load.incremental_by_date(empty, batch, "safetyreportid", "receivedate", None,
                                     ["source_file", "record_pos"])
    assert publish.atomic_publish(first, table, table="adverse_events")
    stored = publish.read_current(spark, table)
    got = {r.safetyreportid: (r.ingredient_term, str(r.receivedate)) for r in stored.collect()}
    assert got == {"100": ("retinol", "2024-01-02"), "101": ("retinol", "2024-01-03"),
                   "200": ("vitamin c", "2024-01-05")}

    # a second landing: one amendment, one unchanged record, one new report
    cdc_dir = os.path.join(scratch, "raw2")
    _land(cdc_dir, "openfda_retinol_2024-01-20.json", [
        {"safetyreportid": "100", "receivedate": "20240102", "receiptdate": "20240111"},
        {"safetyreportid": "101", "receivedate": "20240103"},
        {"safetyreportid": "300", "receivedate": "20240112"},
    ])
    inc = files.read_reports(spark, cdc_dir).withColumn("seq", F.col("record_pos"))   # one file: position orders
    classified = cdc.cdc_classify(stored, inc.select("seq", "safetyreportid", "ingredient_term", "receivedate",
                                                     "receiptdate"))
    counts = {r.change: r.n for r in cdc.cdc_counts(classified).collect()}
    assert counts == {"insert": 1, "update": 1, "noop": 1}
    nxt = cdc.cdc_apply(stored, classified).drop("last_change_seq")
    assert publish.atomic_publish(nxt, table, table="adverse_events")
    final = {r.safetyreportid: str(r.receivedate) for r in publish.read_current(spark, table).collect()}
    assert final == {"100": "2024-01-11", "101": "2024-01-03", "200": "2024-01-05", "300": "2024-01-12"}
    # the same batch again: everything is a no-op now (typed, null-safe comparison)
    again = cdc.cdc_classify(publish.read_current(spark, table),
                             inc.select("seq", "safetyreportid", "ingredient_term", "receivedate", "receiptdate"))
    assert {r.change for r in again.collect()} == {"noop"}
