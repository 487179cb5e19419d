"""Registered queries: loads, watermarks, CDC, backfill, windows, quality (K*, CD*, B*, A14, A15, DQ*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_fda_date
from ..functions.json_fns import json_field, to_payload
from ..operators import cdc, load, quality, windows
from ..operators.clean import choose_modified
from .fixtures import AS_OF, HIGH_VOLUME_FIXTURE_TERMS, Views
from .oracle_views import with_views
from .q_eda import LOADED_ABSTRACTS_CTE, REPORTS_CLEAN_CTES, loaded_abstracts_df
from .q_scoring import ABSTRACT_FEATURE_CTES, REG_CLEAN_CTES, abstracts_processed_df, registry_clean_df, reports_clean_df
from .registry import query

PRIOR_LOAD_CUTOFF = "2024-01-15"    # the previous incremental run loaded reports up to this date
REPLAY_UNTIL = "2025-01-01"         # end of the replay plan
BACKFILL_FROM, BACKFILL_TO = "2024-01-10", "2024-01-20"
HV_SQL = "(" + ", ".join(f"'{t}'" for t in HIGH_VOLUME_FIXTURE_TERMS) + ")"


def stored_typed(v: Views):
    return v.stored().withColumn("receivedate", parse_fda_date("receivedate"))


STORED_TYPED_CTE = {
    "st_typed": """
SELECT safetyreportid, ingredient_term, CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS receivedate FROM stored_v""",
}


# --- K2 incremental by id --------------------------------------------------------
@query("incremental_pubmed", with_views(
    """SELECT pmid, ingredient_term, abstract_length FROM loaded_abs
       UNION ALL
       SELECT pmid, ingredient_term, abstract_length FROM abs_feat a
       WHERE TRY_CAST(pmid AS BIGINT) IS NOT NULL
         AND (TRY_CAST(pmid AS BIGINT) > (SELECT max(CAST(pmid AS BIGINT)) FROM loaded_abs)
              OR (SELECT max(CAST(pmid AS BIGINT)) FROM loaded_abs) IS NULL)
         AND NOT EXISTS (SELECT 1 FROM loaded_abs l WHERE l.pmid = a.pmid)
       QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY pmid) = 1""",
    "abstracts_v", extra={**ABSTRACT_FEATURE_CTES, **LOADED_ABSTRACTS_CTE}))
def q_incremental_pubmed(spark, sf_dir):
    v = Views(spark, sf_dir)
    cols = ["pmid", "ingredient_term", "abstract_length"]
    target = loaded_abstracts_df(v).select(*cols)
    wm = target.select(F.max(F.col("pmid").cast("long"))).scalar()
    return load.incremental_by_id(target, abstracts_processed_df(v).select(*cols), "pmid", wm, ["pmid"])


# --- K3 incremental by date --------------------------------------------------------
@query("incremental_reports", with_views(
    f"""SELECT safetyreportid, ingredient_term, receivedate FROM tgt
        UNION ALL
        SELECT safetyreportid, ingredient_term, receivedate_parsed FROM (
          SELECT * FROM rep_clean
          WHERE receivedate_parsed > (SELECT max(receivedate) FROM tgt)
             OR ((SELECT max(receivedate) FROM tgt) IS NULL AND receivedate_parsed IS NOT NULL)
          QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY seq) = 1) b
        WHERE safetyreportid IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.safetyreportid = b.safetyreportid)""",
    "reports_v", "stored_v",
    extra={**REPORTS_CLEAN_CTES, **STORED_TYPED_CTE,
           "tgt": f"SELECT * FROM st_typed WHERE receivedate <= DATE '{PRIOR_LOAD_CUTOFF}'"}))
def q_incremental_reports(spark, sf_dir):
    v = Views(spark, sf_dir)
    target = stored_typed(v).filter(F.col("receivedate") <= F.lit(PRIOR_LOAD_CUTOFF).cast("date"))
    wm = target.select(F.max("receivedate")).scalar()
    batch = reports_clean_df(v).select("seq", "safetyreportid", "ingredient_term",
                                       F.col("receivedate_parsed").alias("receivedate"))
    return load.incremental_by_date(target, batch, "safetyreportid", "receivedate", wm, ["seq"])


# --- K4 insert if absent --------------------------------------------------------
INCOMING_TYPED_SQL = """
SELECT seq, safetyreportid, ingredient_term,
       CAST(try_strptime(coalesce(nullif(receiptdate, ''), receivedate), '%Y%m%d') AS DATE) AS receivedate
FROM incoming_v"""


def incoming_typed(v: Views):
    return v.incoming().select("seq", "safetyreportid", "ingredient_term",
                               parse_fda_date(choose_modified("receiptdate", "receivedate")).alias("receivedate"))


@query("insert_if_absent", with_views(
    """SELECT safetyreportid, ingredient_term, receivedate FROM st_typed
       UNION ALL
       SELECT safetyreportid, ingredient_term, receivedate FROM inc_typed b
       WHERE safetyreportid IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM st_typed t WHERE t.safetyreportid = b.safetyreportid)
       QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY seq) = 1""",
    "stored_v", "incoming_v", extra={**STORED_TYPED_CTE, "inc_typed": INCOMING_TYPED_SQL}))
def q_insert_if_absent(spark, sf_dir):
    v = Views(spark, sf_dir)
    return load.insert_if_absent(stored_typed(v), incoming_typed(v), "safetyreportid", ["seq"])


# --- K5 replace upsert --------------------------------------------------------
PAGE_CODE = r"/([0-9]+)([?#]|$)"


@query("replace_upsert", f"""
WITH docs AS (
  SELECT coalesce(nullif(regexp_extract(url, '{PAGE_CODE}', 1), ''), sha256(html)) AS doc_key, page_id, url
  FROM pages),
tgt AS (SELECT doc_key, page_id, url, 0 AS src FROM docs WHERE url LIKE '%/en/%'),
bat AS (SELECT doc_key, page_id, url, 1 AS src FROM docs)
SELECT doc_key, page_id, url FROM (SELECT * FROM tgt UNION ALL SELECT * FROM bat)
QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY src DESC, page_id DESC) = 1""")
def q_replace_upsert(spark, sf_dir):
    v = Views(spark, sf_dir)
    pages = v.table("pages", ["page_id", "url", "html"])
    docs = pages.select(load.document_key(F.regexp_extract("url", PAGE_CODE, 1), F.col("html")).alias("doc_key"),
                        "page_id", "url")
    target = docs.filter(F.col("url").contains("/en/"))    # stored by an earlier run: the English pages
    return load.replace_upsert(target, docs, "doc_key", "page_id")


# --- K6 / A14 watermarks --------------------------------------------------------
@query("watermark_table", with_views(
    """SELECT source_name, last_value FROM wm_upd
       UNION ALL SELECT source_name, last_value FROM wm_prev WHERE source_name NOT IN (SELECT source_name FROM wm_upd)""",
    "stored_v", "incoming_v",
    extra={**STORED_TYPED_CTE, "inc_typed": INCOMING_TYPED_SQL,
           "wm_prev": """SELECT ingredient_term AS source_name,
                                strftime(max(coalesce(receivedate, DATE '1900-01-01')), '%Y-%m-%d') AS last_value
                         FROM st_typed GROUP BY 1""",
           "wm_upd": """SELECT ingredient_term AS source_name,
                               strftime(max(coalesce(receivedate, DATE '1900-01-01')), '%Y-%m-%d') AS last_value
                        FROM inc_typed GROUP BY 1"""}))
def q_watermark_table(spark, sf_dir):
    v = Views(spark, sf_dir)
    prev = load.max_date_watermark(stored_typed(v), "ingredient_term", "receivedate")
    upd = load.max_date_watermark(incoming_typed(v), "ingredient_term", "receivedate")
    return load.set_watermarks(prev, upd)


# --- K9 payload --------------------------------------------------------
@query("payload_json", with_views(
    """SELECT seq, json_extract_string(p, '$.safetyreportid') AS p_id,
              json_extract_string(p, '$.receiptdate') AS p_receiptdate,
              CAST(len(json_keys(p)) AS BIGINT) AS n_keys
       FROM (SELECT seq, CAST(to_json(struct_pack(seq := seq, safetyreportid := safetyreportid,
                                                  ingredient_term := ingredient_term, receivedate := receivedate,
                                                  receiptdate := receiptdate)) AS VARCHAR) AS p
             FROM incoming_v)""", "incoming_v"))
def q_payload_json(spark, sf_dir):
    inc = Views(spark, sf_dir).incoming()
    p = inc.select("seq", to_payload(inc).alias("p"))
    return p.select("seq", json_field("p", "$.safetyreportid").alias("p_id"),
                    json_field("p", "$.receiptdate").alias("p_receiptdate"),
                    F.size(F.json_object_keys("p")).cast("long").alias("n_keys"))


# --- K10 per-term watermarks --------------------------------------------------------
@query("incremental_per_term", with_views(
    """SELECT a.ingredient_term, a.pmid, a.abstract_length
       FROM abs_feat a LEFT JOIN (SELECT ingredient_term, max(CAST(pmid AS BIGINT)) AS wm FROM loaded_abs GROUP BY 1) w
         ON w.ingredient_term = a.ingredient_term
       WHERE TRY_CAST(a.pmid AS BIGINT) IS NOT NULL AND (w.wm IS NULL OR TRY_CAST(a.pmid AS BIGINT) > w.wm)""",
    "abstracts_v", extra={**ABSTRACT_FEATURE_CTES, **LOADED_ABSTRACTS_CTE}))
def q_incremental_per_term(spark, sf_dir):
    v = Views(spark, sf_dir)
    wms = load.next_key_watermarks(loaded_abstracts_df(v), "ingredient_term", "pmid")
    batch = abstracts_processed_df(v).select("ingredient_term", "pmid", "abstract_length")
    return load.incremental_by_key(batch, wms, "ingredient_term", "pmid")


# --- K1 full load --------------------------------------------------------
@query("full_load_registry", with_views(
    "SELECT inci_name, inci_name_std, function, regulatory_status FROM reg_clean WHERE inci_name IS NOT NULL",
    "registry_v", "synonyms_v", extra=REG_CLEAN_CTES))
def q_full_load_registry(spark, sf_dir):
    from ..sinks.publish import full_load_frame
    reg = registry_clean_df(Views(spark, sf_dir)).select("inci_name", "inci_name_std", "function", "regulatory_status")
    return full_load_frame(reg, "inci_name")


# --- S5 manifest resume --------------------------------------------------------
@query("manifest_resume", """
WITH existing AS (SELECT p_partkey AS product_code, CAST(NULL AS BIGINT) AS source_page,
                         CAST(NULL AS INTEGER) AS position FROM part WHERE p_size <= 10),
incoming AS (SELECT l_partkey AS product_code, l_orderkey AS source_page, l_linenumber AS position FROM lineitem)
SELECT * FROM existing
UNION ALL
SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.product_code = i.product_code)
QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY source_page, position) = 1""")
def q_manifest_resume(spark, sf_dir):
    v = Views(spark, sf_dir)
    existing = v.table("part", ["p_partkey", "p_size"]).filter(F.col("p_size") <= 10).select(
        F.col("p_partkey").alias("product_code"), F.lit(None).cast("long").alias("source_page"),
        F.lit(None).cast("int").alias("position"))
    incoming = v.table("lineitem", ["l_partkey", "l_orderkey", "l_linenumber"]).select(
        F.col("l_partkey").alias("product_code"), F.col("l_orderkey").alias("source_page"),
        F.col("l_linenumber").alias("position"))
    return load.append_manifest(existing, incoming, "product_code", ["source_page", "position"])


# --- CD1 / CD2 change capture --------------------------------------------------------
CDC_CTES = {
    **STORED_TYPED_CTE,
    "inc": """
SELECT seq, safetyreportid, ingredient_term,
       CAST(try_strptime(coalesce(nullif(receiptdate, ''), receivedate), '%Y%m%d') AS DATE) AS modified
FROM incoming_v WHERE safetyreportid IS NOT NULL AND safetyreportid <> ''""",
    "inc_l": """
SELECT *, lag(modified) OVER w AS prev_m, row_number() OVER w AS rn
FROM inc WINDOW w AS (PARTITION BY safetyreportid ORDER BY seq)""",
    "cls": """
SELECT i.seq, i.safetyreportid, i.ingredient_term, i.modified,
       CASE WHEN i.rn = 1 AND s.safetyreportid IS NULL THEN 'insert'
            WHEN (CASE WHEN i.rn > 1 THEN i.prev_m ELSE s.receivedate END) IS NOT DISTINCT FROM i.modified THEN 'noop'
            ELSE 'update' END AS change
FROM inc_l i LEFT JOIN st_typed s ON s.safetyreportid = i.safetyreportid""",
}


def classified_df(v: Views):
    return cdc.cdc_classify(stored_typed(v), v.incoming())


@query("cdc_classify", with_views("SELECT seq, safetyreportid, modified, change FROM cls",
                                  "stored_v", "incoming_v", extra=CDC_CTES))
def q_cdc_classify(spark, sf_dir):
    return classified_df(Views(spark, sf_dir)).select("seq", "safetyreportid", "modified", "change")


@query("cdc_counts", with_views(
    """SELECT c.change, coalesce(n, 0) AS n
       FROM (VALUES ('insert'), ('update'), ('noop')) c(change)
       LEFT JOIN (SELECT change, count(*) AS n FROM cls GROUP BY 1) x ON x.change = c.change""",
    "stored_v", "incoming_v", extra=CDC_CTES))
def q_cdc_counts(spark, sf_dir):
    return cdc.cdc_counts(classified_df(Views(spark, sf_dir)))


@query("cdc_apply", with_views(
    """SELECT coalesce(s.safetyreportid, a.safetyreportid) AS safetyreportid,
              CASE WHEN s.safetyreportid IS NOT NULL THEN s.ingredient_term ELSE a.first_term END AS ingredient_term,
              CASE WHEN a.safetyreportid IS NOT NULL THEN a.last_date ELSE s.receivedate END AS receivedate,
              a.last_change_seq
       FROM st_typed s FULL OUTER JOIN (
         SELECT safetyreportid, arg_max_null(modified, seq) AS last_date,
                max(CASE WHEN change <> 'noop' THEN seq END) AS last_change_seq,
                arg_min(ingredient_term, seq) AS first_term
         FROM cls GROUP BY 1) a ON a.safetyreportid = s.safetyreportid""",
    "stored_v", "incoming_v", extra=CDC_CTES))
def q_cdc_apply(spark, sf_dir):
    v = Views(spark, sf_dir)
    return cdc.cdc_apply(stored_typed(v), classified_df(v))


# --- B1 backfill --------------------------------------------------------
@query("backfill_window", with_views(
    f"""SELECT seq, safetyreportid, ts AS backfill_ts FROM (
          SELECT seq, safetyreportid, try_strptime(receivedate, '%Y%m%d') AS ts FROM reports_v)
        WHERE ts >= TIMESTAMP '{BACKFILL_FROM}' AND ts <= TIMESTAMP '{BACKFILL_TO}'""", "reports_v"))
def q_backfill_window(spark, sf_dir):
    r = Views(spark, sf_dir).reports()
    out = cdc.backfill(r, "receivedate", BACKFILL_FROM, BACKFILL_TO)
    return out.select("seq", "safetyreportid", F.col("backfill_ts").cast("timestamp_ntz").alias("backfill_ts"))


# --- B2 / A15 / R4 windows --------------------------------------------------------
@query("date_windows", with_views(
    f"""SELECT ingredient_term, CAST(i AS BIGINT) AS window_no, CAST(since + CAST(i * 91 AS INTEGER) AS DATE)
                 AS window_start,
               least(CAST(since + CAST(i * 91 + 90 AS INTEGER) AS DATE), DATE '{REPLAY_UNTIL}') AS window_end
        FROM wk, LATERAL (SELECT unnest(generate_series(0, (datediff('day', since, DATE '{REPLAY_UNTIL}') - 1) // 91))
                          AS i) g
        WHERE since < DATE '{REPLAY_UNTIL}'""",
    "reports_v", "stored_v",
    extra={**STORED_TYPED_CTE,
           "wk": f"""SELECT t.ingredient_term,
                            coalesce(w.wm, CASE WHEN t.ingredient_term IN {HV_SQL}
                                                THEN DATE '{REPLAY_UNTIL}' - 365 END,
                                     DATE '1900-01-01') AS since
                     FROM (SELECT DISTINCT ingredient_term FROM reports_v) t
                     LEFT JOIN (SELECT ingredient_term, max(receivedate) AS wm FROM st_typed GROUP BY 1) w
                       ON w.ingredient_term = t.ingredient_term"""}))
def q_date_windows(spark, sf_dir):
    v = Views(spark, sf_dir)
    terms = v.reports().select("ingredient_term").distinct()
    wm = stored_typed(v).groupBy("ingredient_term").agg(F.max("receivedate").alias("wm"))
    keys = terms.join(wm, "ingredient_term", "left").withColumn(
        "since", windows.window_start_rule(F.col("ingredient_term"), F.col("wm"), F.lit(REPLAY_UNTIL).cast("date"),
                                           HIGH_VOLUME_FIXTURE_TERMS))
    return windows.date_windows(keys, "ingredient_term", "since", REPLAY_UNTIL)


@query("window_volume", with_views(
    f"""SELECT ingredient_term, window_start, least(CAST(window_start + 90 AS DATE), DATE '{AS_OF}') AS window_end,
               count(*) AS n_records, count(*) > 25000 AS over_ceiling
        FROM (SELECT ingredient_term, CAST(since + CAST(floor(datediff('day', since, d) / 91) * 91 AS INTEGER) AS DATE)
                       AS window_start
              FROM (SELECT ingredient_term, CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS d,
                           CASE WHEN ingredient_term IN {HV_SQL} THEN DATE '{AS_OF}' - 365
                                ELSE DATE '1900-01-01' END AS since
                    FROM reports_v)
              WHERE d IS NOT NULL AND d >= since AND d <= DATE '{AS_OF}')
        GROUP BY ingredient_term, window_start""", "reports_v"))
def q_window_volume(spark, sf_dir):
    r = Views(spark, sf_dir).reports().withColumn("d", parse_fda_date("receivedate"))
    since = windows.window_start_rule(F.col("ingredient_term"), F.lit(None).cast("date"), F.lit(AS_OF).cast("date"),
                                      HIGH_VOLUME_FIXTURE_TERMS)
    return windows.window_volume(r, "ingredient_term", "d", since, AS_OF)


@query("event_windows", """
SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS n_events, count(*) > 25000 AS over_ceiling
FROM events GROUP BY event_type, time_bucket(INTERVAL 1 DAY, ts)""")
def q_event_windows(spark, sf_dir):
    ev = Views(spark, sf_dir).table("events", ["ts", "event_type"])
    return windows.event_windows(ev, "ts", "event_type", "1 day")


# --- S4 / H14 variant access --------------------------------------------------------
@query("variant_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_variant_props(spark, sf_dir):
    ev = Views(spark, sf_dir).table("events", ["event_id", "props"])
    return ev.select("event_id", json_field("props", "$.k", "int").alias("k"))


# --- DQ1-DQ4 --------------------------------------------------------
DQ_SQL = """
SELECT 'pubmed_evidence' AS table_name, 'schema' AS check_name, c AS column_name, 'PASSED' AS status, CAST(0 AS BIGINT) AS n_bad
FROM (VALUES ('pmid'), ('ingredient_term'), ('abstract_length')) t(c)
UNION ALL SELECT 'cosing_staging', 'schema', c, 'PASSED', 0 FROM (VALUES ('inci_name'), ('function'), ('regulatory_status')) t(c)
UNION ALL SELECT 'adverse_events', 'schema', c, 'PASSED', 0 FROM (VALUES ('safetyreportid'), ('receivedate')) t(c)
UNION ALL SELECT 'pubmed_evidence', 'nulls', 'pmid', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, n
  FROM (SELECT count(*) FILTER (WHERE pmid IS NULL) AS n FROM abs_feat)
UNION ALL SELECT 'pubmed_evidence', 'range', 'abstract_length', CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASSED' END, n
  FROM (SELECT count(*) FILTER (WHERE abstract_length < 1 OR abstract_length > 5000) AS n FROM abs_feat)
UNION ALL SELECT 'cosing_staging', 'nulls', 'inci_name', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, n
  FROM (SELECT count(*) FILTER (WHERE inci_name IS NULL) AS n FROM reg_clean)
UNION ALL SELECT 'adverse_events', 'nulls', 'safetyreportid', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, n
  FROM (SELECT count(*) FILTER (WHERE safetyreportid IS NULL) AS n FROM rep_clean)"""

DQ_VIEWS = ("abstracts_v", "registry_v", "synonyms_v", "reports_v")
DQ_EXTRA = {**ABSTRACT_FEATURE_CTES, **REG_CLEAN_CTES, **REPORTS_CLEAN_CTES}


def dq_full_report(v: Views):
    proc = abstracts_processed_df(v).select("pmid", "ingredient_term", "abstract_length")
    reg = registry_clean_df(v).select("inci_name", "inci_name_std", "function", "regulatory_status")
    rep = reports_clean_df(v).select("safetyreportid", "receivedate", "ingredient_term")
    return (quality.dq_report(proc, "pubmed_evidence")
            .unionByName(quality.dq_report(reg, "cosing_staging"))
            .unionByName(quality.dq_report(rep, "adverse_events")))


@query("dq_report", with_views(DQ_SQL, *DQ_VIEWS, extra=DQ_EXTRA))
def q_dq_report(spark, sf_dir):
    return dq_full_report(Views(spark, sf_dir))


@query("dq_verdict", with_views(
    f"SELECT table_name, bool_and(status <> 'FAILED') AS is_valid FROM ({DQ_SQL}) GROUP BY table_name",
    *DQ_VIEWS, extra=DQ_EXTRA))
def q_dq_verdict(spark, sf_dir):
    return quality.dq_verdict(dq_full_report(Views(spark, sf_dir)))
