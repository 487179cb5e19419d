"""Commits by touched partitions, several tables at once, one pass of the plan, expiry; streaming into buckets; Bloom narrowing."""
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from kestrel.operators import cdc, keys, load
from kestrel.plans.fixtures import Views
from kestrel.plans.q_load import stored_typed
from kestrel.sinks import publish
from kestrel.sinks.publish import Change, CommitLog
from kestrel.streaming import stream

from .conftest import SF001

ROW = "k string, v long"


def rows(spark, pairs):
    return spark.createDataFrame(pairs, ROW)


def files_below(root):
    """Path -> (size, time) of every data file of a table folder."""
    found = {}
    for folder, _, names in os.walk(root):
        if "_commits" not in folder:
            found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def upsert(batch):
    return lambda stored: load.replace_upsert(stored, batch.withColumn("seq", F.lit(1)), "k", "seq")


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_small_batch_rewrites_only_its_buckets(spark, scratch):
    store = CommitLog(spark, scratch)
    base = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert store.commit({"t": publish.merge_by_key(store, "t", base, "k", lambda s: base, ROW, buckets=64)})
    before, first = files_below(scratch), store.snapshot("t")
    assert publish.stored_buckets(first) == 64 and first.n_rows == 2000
    batch = rows(spark, [(str(i), -i) for i in range(1, 20)] + [("new", 7)])        # 1 % of the keys
    touched = publish.touched_buckets(batch, "k", 64)
    assert len(touched) < 20
    change = publish.merge_by_key(store, "t", batch, "k", upsert(batch), ROW, buckets=5)   # the table's own layout counts
    assert store.commit({"t": change})
    now = store.snapshot("t")
    assert {p for p, f in now.folders if "_version=2" in f} == set(touched)
    assert {f for p, f in now.folders if p not in touched} == {f for p, f in first.folders if p not in touched}
    assert all(files_below(scratch)[f] == t for f, t in before.items())        # no old file changed
    written = set(files_below(scratch)) - set(before)
    assert {f.split("_bucket=")[1].split("/")[0] for f in written} == {t.split("=")[1] for t in touched}
    want = {str(i): i for i in range(2000)} | {str(i): -i for i in range(1, 20)} | {"new": 7}
    assert dict(content(store.read("t"))) == want
    assert store.read("t").columns == ["k", "v"]
    assert set(dict(content(store.read("t", touched)))) == {k for k in want if publish_bucket(spark, k) in touched}


def publish_bucket(spark, key, cache={}):
    if not cache:
        got = spark.range(2000).select(F.col("id").cast("string").alias("k")).unionByName(rows(spark, [("new", 0)]).select("k"))
        cache.update({r.k: f"_bucket={r.b}" for r in got.select("k", publish.bucket_of("k", 64).alias("b")).collect()})
    return cache[key]


def test_a_failed_merge_leaves_the_table(spark, scratch):
    store = CommitLog(spark, scratch)
    base = rows(spark, [(str(i), i) for i in range(50)])
    assert store.commit({"t": publish.merge_by_key(store, "t", base, "k", lambda s: base, ROW, buckets=8)})
    before, batch = content(store.read("t")), rows(spark, [("3", -3)])

    def boom():
        raise RuntimeError("simulated failure between data and marker")

    assert not store.commit({"t": publish.merge_by_key(store, "t", batch, "k", upsert(batch), ROW)}, before_commit=boom)
    assert content(store.read("t")) == before and store.last_version() == 1
    assert not any("_version=2" in f for f in files_below(scratch))              # what was written is gone
    # rows outside the touched partitions are no merge
    stray = publish.bucketed(base, "k", 8, "merge", touched=publish.touched_buckets(batch, "k", 8))
    assert not store.commit({"t": stray}) and content(store.read("t")) == before
    assert store.commit({"t": publish.merge_by_key(store, "t", batch, "k", upsert(batch), ROW)})
    assert dict(content(store.read("t")))["3"] == -3
    # a bucket that loses all its rows leaves the manifest
    gone = publish.merge_by_key(store, "t", batch, "k", lambda s: s.where("k <> '3'"), ROW)
    assert store.commit({"t": gone}) and "3" not in dict(content(store.read("t"))) and store.read("t").count() == 49


def test_inserts_add_folders_and_compaction_joins_them(spark, scratch):
    store = CommitLog(spark, scratch)
    for n in range(4):
        batch = rows(spark, [(str(i), n) for i in range(n * 5, n * 5 + 8)])
        change = publish.insert_by_key(store, "t", batch, "k", lambda stored, b=batch: load.new_rows(stored, b, "k", ["v"]), ROW, buckets=2)
        before = files_below(scratch)
        assert store.commit({"t": change})
        assert all(files_below(scratch)[f] == t for f, t in before.items())
    want = {}
    for n in range(4):
        want = {**{str(i): n for i in range(n * 5, n * 5 + 8)}, **want}         # existing rows win
    assert dict(content(store.read("t"))) == want and store.snapshot("t").n_rows == len(want)
    assert len(store.snapshot("t").folders) > 2
    assert publish.compact(store, "t", "k", most=1) and not publish.compact(store, "t", "k", most=1)
    assert len(store.snapshot("t").folders) == 2 and dict(content(store.read("t"))) == want


def test_tables_change_together_or_not_at_all(spark, scratch):
    store = CommitLog(spark, scratch)
    data, marks = rows(spark, [("a", 1)]), rows(spark, [("wm", 1)])
    assert store.commit({"data": Change(data), "marks": Change(marks)})

    def boom():
        raise RuntimeError("simulated")

    assert not store.commit({"data": Change(rows(spark, [("b", 2)])), "marks": Change(rows(spark, [("wm", 2)]))}, before_commit=boom)
    assert content(store.read("data")) == [("a", 1)] and content(store.read("marks")) == [("wm", 1)]
    # a failed rule of one table stops the others too
    bad = spark.createDataFrame([(None, "x", 1)], "pmid string, ingredient_term string, abstract_length long")
    assert not store.commit({"marks": Change(rows(spark, [("wm", 3)])), "pubmed_evidence": Change(bad, rules="pubmed_evidence")})
    assert content(store.read("marks")) == [("wm", 1)] and store.snapshot("pubmed_evidence") is None
    with pytest.raises(FileNotFoundError):
        store.read("pubmed_evidence")
    assert store.commit({"marks": Change(rows(spark, [("wm", 4)]))})             # a commit of one leaves the other at its version
    assert (store.snapshot("data").version, store.snapshot("marks").version) == (1, 2)
    assert store.commit({"data": Change(data.limit(0)), "odd": Change(data.withColumn("v", F.lit("x y/z")), partition_by=["v"])})
    assert store.read("data").count() == 0 and store.read("data").columns == ["k", "v"]
    assert content(store.read("odd")) == [("a", "x y/z")]


def test_expiry_keeps_what_the_last_commits_list(spark, scratch):
    store = CommitLog(spark, scratch)
    base = rows(spark, [(str(i), i) for i in range(40)])
    assert store.commit({"t": publish.merge_by_key(store, "t", base, "k", lambda s: base, ROW, buckets=4), "u": Change(base)})
    for n in range(5):
        batch = rows(spark, [(str(n), -1)])
        assert store.commit({"t": publish.merge_by_key(store, "t", batch, "k", upsert(batch), ROW)})
    want = content(store.read("t"))
    n_files = len(files_below(scratch))
    assert store.expire(keep=2) > 0 and store.expire(keep=2) == 0
    assert content(store.read("t")) == want and store.read("u").count() == 40 and len(files_below(scratch)) < n_files
    batch = rows(spark, [("9", -9)])
    assert store.commit({"t": publish.merge_by_key(store, "t", batch, "k", upsert(batch), ROW)})
    assert dict(content(store.read("t")))["9"] == -9


def test_the_plan_runs_once_per_publish(scratch):
    """The event log of a publish with rules shows one execution of the plan: every input row is read once."""
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import functions as F
from kestrel.session import build_session
from kestrel.sinks import publish
spark = build_session("local[2]", shuffle_partitions=2, extra_conf={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{scratch}/log",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}})
spark.range(5000).select(F.col("id").cast("string").alias("pmid"), F.lit("x").alias("ingredient_term"), F.lit(9).cast("long").alias("abstract_length")) \\
     .write.parquet("{scratch}/in")
spark.sparkContext.setJobDescription("publish")
assert publish.atomic_publish(spark.read.parquet("{scratch}/in"), "{scratch}/t", table="pubmed_evidence")
spark.stop()
"""
    os.makedirs(os.path.join(scratch, "log"))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    (log,) = os.listdir(os.path.join(scratch, "log"))
    read, stages = 0, {}
    with open(os.path.join(scratch, "log", log)) as fh:
        for line in fh:
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageSubmitted":
                stages[e["Stage Info"]["Stage ID"]] = e["Properties"].get("spark.job.description")
            elif e["Event"] == "SparkListenerTaskEnd" and stages.get(e["Stage ID"]) == "publish":
                read += e["Task Metrics"]["Input Metrics"]["Records Read"]
    assert read == 5000


def test_stream_cdc_rewrites_touched_buckets_only(spark, scratch):
    v = Views(spark, SF001)
    table, landing, ckpt = (os.path.join(scratch, x) for x in ("adverse_events", "landing", "ckpt"))
    stored, inc = stored_typed(v), v.incoming()
    store = CommitLog(spark, table)
    assert store.commit({"": publish.merge_by_key(store, "", stored, "safetyreportid", lambda s: stored, stream.EVENT_SCHEMA, buckets=64)})
    some = inc.where(F.col("safetyreportid").isin([r[0] for r in inc.select("safetyreportid").where(
        "safetyreportid IS NOT NULL AND safetyreportid <> ''").distinct().orderBy("safetyreportid").limit(5).collect()]))
    for i in range(4):       # several landing files, one batch
        some.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == i).coalesce(1).write.parquet(os.path.join(landing, f"f{i}"))
    before = store.snapshot()
    untouched = files_below(table)
    stream.stream_cdc(spark, os.path.join(landing, "*"), inc.schema, table, ckpt).awaitTermination()
    now = store.snapshot()
    touched = set(publish.touched_buckets(some, "safetyreportid", 64))
    assert now.version == 2 and len(touched) <= 5
    assert {p for p, f in now.folders if "_version=2" in f} <= touched
    assert {f for p, f in now.folders if p not in touched} == {f for p, f in before.folders if p not in touched}
    assert all(files_below(table)[f] == t for f, t in untouched.items())
    want = cdc.cdc_apply(stored, cdc.cdc_classify(stored, some)).drop("last_change_seq")
    got = store.read()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # the same files replayed from a lost checkpoint carry a batch id that is already committed
    stream.stream_cdc(spark, os.path.join(landing, "*"), inc.schema, table, os.path.join(scratch, "lost")).awaitTermination()
    assert store.snapshot() == now


def test_bloom_filter_bounds_what_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(load, "BROADCAST_KEYS", 100)
    table = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    batch = spark.range(0, 60_000, 120).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).unionByName(
        spark.range(300).select(F.concat(F.lit("other"), F.col("id").cast("string")).alias("k")))
    n = batch.count()
    maybe = load.maybe_in(table, batch, "k", n)
    assert 500 <= maybe.count() <= 500 + 60_000 * 0.02                   # no key lost, few others pass
    assert maybe.join(batch, "k", "left_semi").count() == 500
    for expected in (None, n):
        assert content(load.keys_in(table, batch, "k", expected)) == content(table.where("v % 120 = 0"))
    assert load.keys_in(table, batch.limit(0), "k", 1000).count() == 0
    plan = load.keys_in(table, batch, "k", n)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "scalar-subquery" in plan or "Subquery" in plan
    # fewer words than keys: less selective, still complete
    monkeypatch.setattr(load, "BLOOM_MAX_WORDS", 4)
    assert load.keys_in(table, batch, "k", n).count() == 500


def test_bloom_narrowed_loads_equal_plain_ones(spark):
    v = Views(spark, SF001)
    stored, inc = stored_typed(v), v.incoming()
    plain = cdc.cdc_classify(stored, inc)
    narrowed = cdc.cdc_classify(stored, inc, expected_keys=10 ** 6)
    assert plain.exceptAll(narrowed).count() == 0 and narrowed.exceptAll(plain).count() == 0
    a, b = cdc.cdc_apply(stored, plain), cdc.cdc_apply(stored, plain, expected_keys=10 ** 6)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_key_map_numbers_only_unseen_members(spark):
    first = spark.createDataFrame([(f"m{i}",) for i in range(100)] + [(None,), ("m1",)], "m string")
    empty = spark.createDataFrame([], "key long, m string")
    one = keys.new_members(first, empty, "m", "key")
    assert sorted(r.key for r in one.collect()) == list(range(1, 101))
    assert content(one) == content(keys.new_members(first.repartition(7), empty, "m", "key"))       # any evaluation gives the same numbers
    known = spark.createDataFrame(one.collect(), "key long, m string")
    second = keys.new_members(spark.createDataFrame([("m5",), ("a",), ("zz",), ("a",)], "m string"), known, "m", "key").collect()
    assert sorted(r.key for r in second) == [101, 102] and {r.m for r in second} == {"a", "zz"}
    assert keys.new_members(first, known, "m", "key").count() == 0
