import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions import json_fns, text
from kestrel.functions.dates import unify_dates
from kestrel.operators import cdc, clean, dedupe, eda, features, keys, load, quality, scoring, windows
from kestrel.plans import star

from .conftest import SF01


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_py_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t  Niacinamide  \n",), (None,), ("  ",)], "s string")
    out = [r[0] for r in df.select(text.norm_name("s")).collect()]
    assert out == ["niacinamide", "", ""]
    assert [r[0] for r in df.select(text.is_blank("s")).collect()] == [False, True, True]


def test_label_tokens_and_clean_tokens(spark):
    df = spark.createDataFrame([("Aqua,\n ,Glycerin\nNiacinamide, ",), ("The Skin-barrier's 2x repair; café",)],
                               "t string")
    toks = [r[0] for r in df.select(text.label_tokens("t")).collect()]
    assert toks[0] == ["Aqua", "Glycerin", "Niacinamide"]
    clean_toks = [r[0] for r in df.select(text.clean_tokens("t")).collect()]
    assert clean_toks[1] == ["skin", "barrier", "repair", "caf"]     # 'the', "s", '2x' dropped


def test_first_per_key_null_key_is_one_group_and_order_wins(spark):
    df = spark.createDataFrame([(None, 3, "a"), (None, 1, "b"), ("k", 2, "c"), ("k", 1, "d")],
                               "key string, seq int, v string")
    got = {r.key: r.v for r in dedupe.first_per_key(df, "key", ["seq"]).collect()}
    assert got == {None: "b", "k": "d"}


def test_first_n_per_group_hot_group(spark):
    hot = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id"))
    cold = spark.range(5).select(F.lit("cold").alias("g"), F.col("id"))
    out = dedupe.first_n_per_group(hot.unionByName(cold), "g", ["id"], 3, salt_buckets=8, rank_col="rank")
    assert rows(out, "g", "id", "rank") == [("cold", 0, 1), ("cold", 1, 2), ("cold", 2, 3),
                                            ("hot", 0, 1), ("hot", 1, 2), ("hot", 2, 3)]
    salted = dedupe.first_n_per_group(hot.unionByName(cold), "g", ["id"], 1500, salt_buckets=8, rank_col="rank")
    assert salted.filter("g = 'hot'").count() == 1500 and salted.filter("g = 'cold'").count() == 5
    assert rows(salted.filter("g = 'hot' AND rank <= 2"), "id", "rank") == [(0, 1), (1, 2)]


def test_previous_in_key_bucketed_equals_lag(spark):
    df = spark.range(200).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("seq"),
                                 F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 10).alias("v"))
    got = dedupe.previous_in_key(df, "k", "seq", "v", "prev", "has_prev", bucket_width=5)
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select("k", "seq", F.lag("v").over(w).alias("prev"), (F.row_number().over(w) > 1).alias("has_prev"))
    assert rows(got, "k", "seq", "prev", "has_prev") == rows(want, "k", "seq", "prev", "has_prev")


def test_cdc_repeats_in_batch_and_null_safe_dates(spark):
    stored = spark.createDataFrame([("1", "retinol", "20240101"), ("2", "arbutin", None)],
                                   "safetyreportid string, ingredient_term string, receivedate string")
    stored = stored.withColumn("receivedate", F.try_to_date("receivedate", "yyyyMMdd"))
    incoming = spark.createDataFrame([
        (1, "1", "retinol", "20240101", None),        # same date -> noop
        (2, "2", "ceramide", "garbage", None),        # null vs null -> noop
        (3, "3", "peptide", "20240105", ""),          # new -> insert
        (4, "3", "peptide", "20240105", "20240106"),  # receiptdate wins, differs from the row before -> update
        (5, "3", "peptide", "20240106", None),        # equal to the row before it -> noop
        (6, "", "x", "20240101", None),               # no id -> ignored
        (7, "1", "vitamin c", "20240102", None),      # differs -> update, term kept
    ], "seq long, safetyreportid string, ingredient_term string, receivedate string, receiptdate string")
    cls = cdc.cdc_classify(stored, incoming)
    assert rows(cls, "seq", "change") == [(1, "noop"), (2, "noop"), (3, "insert"), (4, "update"),
                                          (5, "noop"), (7, "update")]
    applied = {r.safetyreportid: r for r in cdc.cdc_apply(stored, cls).collect()}
    assert applied["1"].ingredient_term == "retinol" and str(applied["1"].receivedate) == "2024-01-02"
    assert applied["3"].ingredient_term == "peptide" and str(applied["3"].receivedate) == "2024-01-06"
    assert applied["3"].last_change_seq == 4 and applied["2"].last_change_seq is None
    assert rows(cdc.cdc_counts(cls), "change", "n") == [("insert", 1), ("noop", 3), ("update", 2)]


def test_product_risk_blank_unknown_and_case(spark):
    reg = spark.createDataFrame([(1, "Retinol", None, "banned"), (2, "arbutin", "x", "Restricted"),
                                 (3, "Vitamin C", "y", "allowed")],
                                "cosing_ref_no long, inci_name string, function string, regulatory_status string")
    syn = clean.synonym_table(spark)          # platform defaults: vitamin c -> ascorbic acid
    rc = clean.clean_registry(reg, syn)
    labels = spark.createDataFrame([(1, "retinol, ARBUTIN\nunknown thing"), (2, " "), (3, None),
                                    (4, "vitamin c")], "product_code long, label_text string")
    out = {r.product_code: r for r in scoring.product_risk(labels, rc, syn).collect()}
    # banned 1.0, 'Restricted' is not a known word -> 0.4, miss -> unknown 0.4
    assert math.isclose(out[1].risk_score, (1.0 + 0.4 + 0.4) / 3) and out[1].risk_max == 1.0
    assert out[1].flagged_ingredients == 1 and out[1].total_ingredients == 3
    assert out[2].risk_score is None and out[2].total_ingredients == 0
    assert out[3].risk_score is None
    # the label token maps to 'ascorbic acid', the registry row too -> allowed 0.1
    assert math.isclose(out[4].risk_score, 0.1)


def test_match_check_empty_and_evidence_scores(spark):
    reg = spark.createDataFrame([(1, "a", "f", "allowed")],
                                "cosing_ref_no long, inci_name string, function string, regulatory_status string")
    rc = clean.clean_registry(reg, clean.synonym_table(spark))
    empty = spark.createDataFrame([(1, " ")], "product_code long, label_text string")
    assert scoring.match_check(empty, rc).count() == 0
    ab = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", None), ("4", "y")], "pmid string, ingredient_term string")
    assert rows(scoring.evidence_scores(ab), "ingredient_term", "pubmed_hits", "evidence_score") == \
        [("x", 2, 1.0), ("y", 1, 0.5)]


def test_allocate_length_minimum_and_null_keys(spark):
    df = spark.createDataFrame([(1, "t", 12), (None, "t", 1000), (2, "t", 1000), (2, "t", 5), (3, "u", 3)],
                               "pmid long, term string, total long")
    out = clean.allocate_length(df, "pmid", "term", "total", order="total")
    # batch 't' has 3 rows once the null key is gone: 12 // 3 = 4 -> 5, 5 // 3 -> 5; first row of pmid 2 by total
    assert rows(out, "pmid", "term", "abstract_length") == [("1", "t", 5), ("2", "t", 5), ("3", "u", 5)]


def test_plausible_dates_and_backfill(spark):
    df = spark.createDataFrame([("20240101",), ("20990101",), ("garbage",), (None,)], "d string")
    assert df.transform(lambda x: clean.plausible_dates(x, "d", "2024-01-25", "p")).count() == 1
    ts = spark.createDataFrame([("2024-01-10 00:00:00",), ("2024-01-20 00:00:00",), ("2024-01-20 08:00:00",),
                                ("2024-01-09 23:59:59",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert cdc.backfill(ts, "t", "2024-01-10", "2024-01-20").count() == 2
    assert cdc.backfill(ts, "absent", "2024-01-10", "2024-01-20").count() == 4


def test_date_windows_rules(spark):
    keys_df = spark.createDataFrame([("retinol", None), ("niacinamide", None), ("arbutin", "2024-08-24"),
                                     ("late", "2030-01-01")], "term string, wm string") \
                   .withColumn("wm", F.col("wm").cast("date"))
    until = "2025-01-01"
    since = windows.window_start_rule(F.col("term"), F.col("wm"), F.lit(until).cast("date"), ("retinol",))
    w = windows.date_windows(keys_df.withColumn("since", since), "term", "since", until)
    got = {r.term: [] for r in w.collect()}
    for r in w.orderBy("term", "window_no").collect():
        got[r.term].append((str(r.window_start), str(r.window_end)))
    assert got["arbutin"] == [("2024-08-24", "2024-11-22"), ("2024-11-23", "2025-01-01")]
    assert got["retinol"][0][0] == "2024-01-02"              # 365 days back for high-volume terms
    assert got["niacinamide"][0] == ("1900-01-01", "1900-04-01")
    assert "late" not in got                                  # start after the end: no window
    ends = got["niacinamide"]
    assert all(F is not None for F in ends) and ends[-1][1] == "2025-01-01"


def test_load_strategies(spark):
    target = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    batch = spark.createDataFrame([(1, "2", "x"), (2, "3", "first"), (3, "3", "second"), (4, None, "n")],
                                  "seq long, id string, v string")
    out = load.insert_if_absent(target, batch.select("seq", "id", "v"), "id", ["seq"])
    assert rows(out, "id", "v") == [("1", "a"), ("2", "b"), ("3", "first")]
    again = load.insert_if_absent(out, batch, "id", ["seq"])
    assert again.count() == out.count()                        # rerun adds nothing
    up = load.replace_upsert(target, batch.filter("id is not null").select("id", "v", "seq"), "id", "seq")
    assert rows(up, "id", "v") == [("1", "a"), ("2", "x"), ("3", "second")]
    wm = spark.createDataFrame([("batch_t1", "5"), ("t2", "9")], "source_name string, last_value string")
    ids = spark.createDataFrame([("t1", "4"), ("t1", "6"), ("t2", "1"), ("t2", "abc")], "term string, id string")
    # only 'batch_<term>' rows are per-term watermarks; 't2' has none, so all its numeric ids pass
    assert rows(load.incremental_by_key(ids, wm, "term", "id"), "term", "id") == [("t1", "6"), ("t2", "1")]
    assert rows(load.next_key_watermarks(ids, "term", "id"), "source_name", "last_value") == \
        [("batch_t1", "6"), ("batch_t2", "1")]
    assert load.non_numeric_ids(ids, "id").count() == 1
    upd = spark.createDataFrame([("t1", "3")], "source_name string, last_value string")
    both = spark.createDataFrame([("t1", "5"), ("t9", "1")], "source_name string, last_value string")
    assert rows(load.set_watermarks(both, upd), "source_name", "last_value") == [("t1", "3"), ("t9", "1")]


def test_dimensions(spark):
    assert star.dim_date_range(spark, "2010-01-01", "2030-12-31").count() == 7670
    ds = star.dim_source(spark)
    assert ds.count() == 6 and rows(ds.filter("source_key = 4"), "source_name") == [("CosIng",)]
    d = star.dim_date_range(spark, "2024-02-28", "2024-03-01").collect()
    assert [(r.date_key, r.month_name, r.day_of_week, r.quarter) for r in d] == \
        [(1, "February", "Wednesday", 1), (2, "February", "Thursday", 1), (3, "March", "Friday", 1)]


def test_dense_key_after_aggregation(spark):
    df = spark.range(5000).select((F.col("id") % 1777).cast("string").alias("k")).groupBy("k").count()
    got = keys.dense_key(df, ["k"], "key", partitions=7)
    want = df.select("k", F.row_number().over(Window.orderBy("k")).alias("rn"))
    assert got.join(want, "k").filter("key != rn").count() == 0
    assert got.select(F.max("key")).first()[0] == 1777


def test_q3_as_written_equals_literal_fan_out(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ingredient_key long, inci_name_std string")
    ev = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1)], "ingredient_key long, event_count int")
    evd = spark.createDataFrame([(1, 0.5), (1, 0.25), (3, 1.0)], "ingredient_key long, evidence_score double") \
               .withColumn("evidence_score", F.col("evidence_score").cast("decimal(5,4)"))
    got = star.q3_as_written(dim, ev, evd)
    literal = (dim.join(ev, "ingredient_key", "left").join(evd, "ingredient_key", "left")
               .groupBy("inci_name_std").agg(F.sum("event_count").alias("t"), F.avg("evidence_score").alias("a")))
    want = {r.inci_name_std: (r.t, None if r.a is None else float(r.a)) for r in literal.collect()}
    have = {r.inci_name_std: (r.total_adverse_events, None if r.avg_evidence_score is None
                              else float(r.avg_evidence_score)) for r in got.collect()}
    assert have == want
    drill = {r.inci_name_std: r.total_adverse_events for r in star.q3_drill_across(dim, ev, evd).collect()}
    assert drill == {"a": 3, "b": 1, "c": None}


def test_pca_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got = features.pca_2d(emb, ["vec_id"], "embedding").orderBy("vec_id").collect()
    data = emb.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in data], dtype=np.float64)
    xc = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(xc, full_matrices=False)
    for j, name in enumerate(["pca_x", "pca_y"]):
        comp = vt[j] * (1 if vt[j][np.abs(vt[j]).argmax()] >= 0 else -1)
        want = xc @ comp
        have = np.array([r[name] for r in got])
        assert np.allclose(have, want, atol=1e-6)


def test_tfidf_by_hand(spark):
    toks = spark.createDataFrame([("d1", "skin"), ("d1", "skin"), ("d1", "acid"), ("d2", "skin"), ("d2", "rare"),
                                  ("d3", "acid")], "doc string, term string")
    w = {(r.doc, r.term): r.tfidf for r in features.tfidf(toks, "doc", "term", F.lit(3), min_df=2).collect()}
    idf = lambda df: math.log(4 / (1 + df)) + 1
    d1 = np.array([2 * idf(2), 1 * idf(2)])
    assert math.isclose(w[("d1", "skin")], d1[0] / np.linalg.norm(d1))
    assert ("d2", "rare") not in w and math.isclose(w[("d2", "skin")], 1.0)


def test_histogram_single_value(spark):
    df = spark.createDataFrame([(7,), (7,)], "x long")
    out = eda.length_histogram(df, "x", bins=4).orderBy("bin").collect()
    assert [r.n for r in out] == [0, 0, 2, 0]
    assert math.isclose(out[0].bin_lo, 6.5) and math.isclose(out[-1].bin_hi, 7.5)


def test_dq_rules_and_unruled_table(spark):
    df = spark.createDataFrame([("1", "t", 0), ("2", "t", 10)], "pmid string, ingredient_term string, abstract_length long")
    rep = quality.dq_report(df, "pubmed_evidence")
    assert rows(rep.filter("check_name = 'range'"), "status", "n_bad") == [("WARNING", 1)]
    assert quality.is_valid(rep)
    assert quality.is_valid(quality.dq_report(df, "no_rules_table"))


def test_payload_nan_and_nulls(spark):
    df = spark.createDataFrame([(1, float("nan"), None)], "id long, x double, s string")
    p = df.select(json_fns.to_payload(df).alias("p")).first()[0]
    assert p == '{"id":1,"x":null,"s":null}'


@pytest.mark.parametrize("raw,want", [
    ("20240105", "2024-01-05 00:00:00"),
    ("2026-05-07T15:07:12Z", "2026-05-07 15:07:12"),
    ("Wed, 17 Jun 2026 05:00:00 GMT", "2026-06-17 05:00:00"),
    ("Tue, 09 Jun 2026 05:00:00 -0500", "2026-06-09 10:00:00"),
    ("not a date", None),
])
def test_unify_dates(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "s string").select(unify_dates("s").cast("string")).first()[0]
    assert got == want


def test_slug_and_strip_markup(spark):
    df = spark.createDataFrame([("Épisode 1: Skin & \"Care\" – ✓",
                                 "<html><head><style>p{}</style><script>x=\"</p>\"</script></head>"
                                 "<body><!-- ad --><p>Hi&nbsp;&amp;\tbye</p></body></html>")], "t string, h string")
    r = df.select(text.slug("t").alias("s"), text.strip_markup("h").alias("m")).first()
    assert r.s == "Épisode_1__Skin____Care_____"
    assert r.m == "Hi & bye"


def test_stringify_keeps_nulls_and_nests_json(spark):
    df = spark.createDataFrame([(1, None, [1, 2], {"a": 1.5})], "n long, s string, arr array<int>, st struct<a:double>")
    r = clean.stringify(df).first()
    assert (r.n, r.s, r.arr, r.st) == ("1", None, "[1,2]", '{"a":1.5}')


def test_normalise_and_keep_present(spark):
    df = spark.createDataFrame([(1, 2)], "` Regulatory Status ` long, `INCI name` long")
    df = clean.normalise_columns(df)
    assert df.columns == ["regulatory_status", "inci_name"]
    assert clean.keep_present(df, ["inci_name", "concentration_limit"]).columns == ["inci_name"]
    filled = clean.fill_defaults(spark.createDataFrame([("x",)], "inci_name string"))
    assert (filled.first().regulatory_status, filled.first().function) == ("unknown", "unspecified")


def test_cdc_apply_payload_and_load_time(spark):
    stored = spark.createDataFrame([("1", "retinol", "2024-01-01", '{"v": 0}', "2024-01-01 00:00:00"),
                                    ("9", "arbutin", "2024-01-03", '{"v": 9}', "2024-01-03 00:00:00")],
                                   "safetyreportid string, ingredient_term string, receivedate string, "
                                   "raw_payload string, loaded_at string")
    stored = stored.select("safetyreportid", "ingredient_term", F.col("receivedate").cast("date").alias("receivedate"),
                           "raw_payload", F.col("loaded_at").cast("timestamp").alias("loaded_at"))
    incoming = spark.createDataFrame([
        (1, "1", "retinol", "20240102", None, '{"v": 1}'),     # update
        (2, "1", "retinol", "20240102", None, '{"v": 2}'),     # noop: payload stays the update's
        (3, "2", "peptide", "20240105", None, '{"v": 3}'),     # insert
    ], "seq long, safetyreportid string, ingredient_term string, receivedate string, receiptdate string, "
       "raw_payload string")
    cls = cdc.cdc_classify(stored, incoming)
    out = {r.safetyreportid: r for r in cdc.cdc_apply(stored, cls, payload="raw_payload",
                                                       loaded_at="2024-02-01 10:00:00").collect()}
    assert out["1"].raw_payload == '{"v": 1}' and str(out["1"].loaded_at) == "2024-02-01 10:00:00"
    assert out["2"].raw_payload == '{"v": 3}' and out["2"].ingredient_term == "peptide"
    assert out["9"].raw_payload == '{"v": 9}' and str(out["9"].loaded_at) == "2024-01-03 00:00:00"


def test_pooled_vectors_watermark_value_and_sizing(spark):
    frames = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "k long, v array<double>")
    pooled = {r.k: r.pooled for r in features.pooled_vectors(features.mean_pool(frames, "k", "v"), "k").collect()}
    assert pooled == {1: [2.0, 3.0], 2: [5.0, 6.0]}
    wm = spark.createDataFrame([("pubmed", "42"), ("openfda", "2024-01-01")], "source_name string, last_value string")
    assert spark.range(1).select(load.watermark_value(wm, "pubmed").alias("w")).first().w == "42"
    assert spark.range(1).select(load.watermark_value(wm, "absent").alias("w")).first().w is None
    from kestrel.session import suggested_conf
    conf = suggested_conf(100 * 2**40, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20) + 1


def test_pca_nulls_and_too_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, [2.0, 1.0, None])], "id long, v array<double>")
    out = features.pca_2d(df, ["id"], "v").collect()
    assert all(r.pca_x is None and r.pca_y is None for r in out)
    df3 = df.unionByName(spark.createDataFrame([(3, [0.0, 2.0, 1.0])], df.schema))
    got = {r.id: r.pca_x for r in features.pca_2d(df3, ["id"], "v").collect()}
    x = np.array([[1.0, 0.0, 3.0], [2.0, 1.0, 0.0], [0.0, 2.0, 1.0]])
    xc = x - x.mean(axis=0)
    comp = np.linalg.svd(xc)[2][0]
    comp = comp * (1 if comp[np.abs(comp).argmax()] >= 0 else -1)
    assert np.allclose([got[i] for i in (1, 2, 3)], xc @ comp, atol=1e-9)


def test_padded_calendar_names(spark):
    from kestrel.functions.dates import date_parts
    parts = date_parts(F.lit("2024-05-01").cast("date"), pad_names=True)
    r = spark.range(1).select(parts["month_name"].alias("m"), parts["day_of_week"].alias("d")).first()
    assert (r.m, r.d) == ("May      ", "Wednesday")


def test_tfidf_matches_textbook_computation(spark):
    """TF-IDF weights vs a plain-Python computation with the vectorizer defaults (smooth idf, l2 rows)."""
    import collections
    import re

    from kestrel.functions.constants import STOPWORDS
    from kestrel.operators.clean import abstract_tokens
    from kestrel.plans.fixtures import Views

    from .conftest import SF001
    v = Views(spark, SF001)
    docs = {r.pmid: r.abstract for r in v.abstracts().collect() if r.abstract.strip()}
    stop = set(STOPWORDS)
    toks = {d: [t for t in re.sub(r"[^a-zA-Z\s]", " ", a.lower()).split() if t not in stop and len(t) > 2]
            for d, a in docs.items()}
    df = collections.Counter(t for ts in toks.values() for t in set(ts))
    total = collections.Counter(t for ts in toks.values() for t in ts)
    vocab = sorted((t for t in df if df[t] >= 2), key=lambda t: (-total[t], t))[:2000]
    n = len(docs)
    want = {}
    for d, ts in toks.items():
        tf = collections.Counter(t for t in ts if t in set(vocab))
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(d, t): x / norm for t, x in w.items()})
    tok_df = abstract_tokens(v.abstracts()).select("pmid", F.col("token").alias("term"))
    got = {(r.pmid, r.term): r.tfidf for r in features.tfidf(tok_df, "pmid", "term", F.lit(n)).collect()}
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12


def test_text_pca_matches_numpy(spark):
    """PCA of the TF-IDF rows vs numpy's SVD of the dense matrix built from the same weights."""
    from kestrel.functions.text import clean_tokens as ct
    from kestrel.operators.clean import drop_blank
    from kestrel.plans.fixtures import Views

    from .conftest import SF001
    docs = drop_blank(Views(spark, SF001).abstracts(), "abstract").select("pmid", ct("abstract").alias("tokens"))
    got = {r.pmid: (r.pca_x, r.pca_y) for r in features.tfidf_pca(docs, "pmid", "tokens").collect()}
    n = docs.count()
    toks = docs.select("pmid", F.explode("tokens").alias("term"))
    w = features.tfidf(toks, "pmid", "term", F.lit(n)).collect()
    pmids = sorted(got)
    terms = sorted({r.term for r in w})
    x = np.zeros((len(pmids), len(terms)))
    pi, ti = {p: i for i, p in enumerate(pmids)}, {t: j for j, t in enumerate(terms)}
    for r in w:
        x[pi[r.pmid], ti[r.term]] = r.tfidf
    xc = x - x.mean(axis=0)
    vt = np.linalg.svd(xc, full_matrices=False)[2]
    for j in range(2):
        comp = vt[j] * (1 if vt[j][np.abs(vt[j]).argmax()] >= 0 else -1)
        assert np.allclose([got[p][j] for p in pmids], xc @ comp, atol=1e-8)


def test_tfidf_and_text_pca_keep_rows_with_repeated_and_null_ids(spark):
    """A document is a row: rows that share an id or have none get weights and scores of their own."""
    rows = [("1", ["retinol", "acid", "skin"]), ("1", ["retinol", "serum"]), (None, ["acid", "retinol", "serum", "serum"]),
            ("4", ["skin", "acid"]), ("5", ["serum", "skin", "retinol"]), (None, ["acid", "skin", "skin"]), ("7", [])]
    vocab = ["acid", "retinol", "serum", "skin"]
    counts = np.array([[ts.count(t) for t in vocab] for _, ts in rows], dtype=float)
    x = counts * (np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1)
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    docs = spark.createDataFrame(rows, "pmid string, tokens array<string>")
    toks = docs.withColumn("doc", F.monotonically_increasing_id()).select("doc", "pmid", F.explode("tokens").alias("term"))
    got = features.tfidf(toks, ["doc", "pmid"], "term", F.lit(len(rows))).collect()
    order = sorted({(r.doc, r.pmid) for r in got})
    assert [p for _, p in order] == [p for p, ts in rows if ts]
    assert len(got) == (counts > 0).sum()
    for r in got:
        assert r.tfidf == pytest.approx(x[[d for d, _ in order].index(r.doc), vocab.index(r.term)])
    scores = [(r.pmid, r.pca_x, r.pca_y) for r in features.tfidf_pca(docs, "pmid", "tokens").collect()]
    xc = x - x.mean(axis=0)
    vt = np.linalg.eigh(xc.T @ xc)[1][:, ::-1].T
    want = xc @ np.array([vt[j] * (1 if vt[j][np.abs(vt[j]).argmax()] >= 0 else -1) for j in range(2)]).T
    near = lambda s: (s[0] or "", round(s[1], 6) + 0.0, round(s[2], 6) + 0.0)
    assert sorted(map(near, scores)) == sorted(near((p, *w)) for (p, _), w in zip(rows, want))


def test_leading_components_of_known_matrices():
    from kestrel.operators.features import leading_components

    rng = np.random.default_rng(3)
    for d, decay in ((2, 1.0), (5, 0.5), (40, 0.9), (300, 0.98)):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        m = (q * decay ** np.arange(d)) @ q.T
        steps = []
        got = leading_components(lambda v: steps.append(v.shape[1]) or m @ v, d, 2)
        vals, vecs = np.linalg.eigh(m)
        if decay < 1:
            assert np.abs(np.abs(got.T @ vecs[:, ::-1][:, :2]) - np.eye(2)).max() < 1e-6
        assert sum(steps) <= max(d, 8 * 60)
    low = np.outer(np.arange(30.0), np.arange(30.0))            # rank one: the second component is any orthogonal vector
    got = leading_components(lambda v: low @ v, 30, 2)
    assert abs(got[:, 0] @ got[:, 1]) < 1e-8 and abs(abs(got[:, 0] @ np.arange(30.0)) / np.linalg.norm(np.arange(30.0)) - 1) < 1e-9


def test_covariance_entries_with_gaps(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],), ([2.0],), (None,), ([0.5, 4.0, 0.0],)], "v array<double>")
    x = np.array([[1, 0, 3], [2, 0, 0], [0, 0, 0], [0.5, 4, 0]])
    want = np.cov(x.T)
    got = {(r.i, r.j): r.covariance for r in features.covariance_entries(df, "v", 4).collect()}
    assert len(got) == 10 and all(got[i, j] == pytest.approx(want[i, j]) for i in range(3) for j in range(i, 3))
    assert got[0, 3] == 0 and all(r.covariance is None for r in features.covariance_entries(df.limit(1), "v", 2).collect())
