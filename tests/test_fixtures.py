"""The domain views hold every source row unchanged; dirty rows come on top."""
from pyspark.sql import functions as F

from kestrel.operators.dedupe import first_n_per_group
from kestrel.plans.fixtures import Views

from .conftest import SF001


def test_views_hold_every_source_row(spark):
    v = Views(spark, SF001)
    assert v.registry().count() == v.table("part").count()

    docs = v.table("documents").select(F.col("doc_id").cast("string").alias("pmid"), F.col("source").alias("ingredient_term"),
                                       F.col("text").alias("abstract"))
    assert docs.exceptAll(v.abstracts()).isEmpty()
    extra = v.abstracts().exceptAll(docs)
    assert extra.count() > 0 and extra.where("trim(abstract) <> ''").isEmpty()

    orders = v.table("orders").select("o_orderkey")
    labels = v.labels_text()
    assert orders.exceptAll(labels.select("product_code")).isEmpty()
    assert labels.where("product_code >= 0 and trim(label_text) = ''").isEmpty()

    events = v.table("events").select(F.col("event_id").alias("seq"), F.col("props").alias("raw_payload"))
    real = v.reports().where("seq >= 0")
    assert events.exceptAll(real.select("seq", "raw_payload")).isEmpty()
    assert real.where("safetyreportid = '' or receivedate = 'garbage'").isEmpty()
    assert v.reports().where("safetyreportid = ''").count() > 0
    assert v.reports().where("receivedate = 'garbage'").count() > 0
    assert v.reports().groupBy("seq").count().where("count > 1").isEmpty()


def test_facts_reach_all_parts(spark):
    v = Views(spark, SF001)
    n_parts, n_events = v.table("part").count(), v.table("events").count()
    assert v.safety().select("cosing_ref_no").distinct().count() == min(n_parts, n_events)


def test_first_n_is_the_same_under_any_partitioning(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") % 7).alias("o"), "id")
    for n in (900, 1500):
        got = [sorted(r["id"] for r in first_n_per_group(rows.repartition(p), "g", "o", n).collect()) for p in (1, 5)]
        want = sorted(i for _, i in sorted((i % 7, i) for i in range(3000))[:n])
        assert got == [want, want]
