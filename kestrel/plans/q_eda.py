"""Registered queries: reports and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators import clean, dedupe, eda
from .fixtures import AS_OF, Views
from .oracle_views import sql_strip, with_views
from .q_scoring import (
    ABSTRACT_FEATURE_CTES, REG_CLEAN_CTES, abstracts_processed_df, registry_clean_df, reports_clean_df,
)
from .registry import query

S = sql_strip

REPORTS_CLEAN_CTES = {
    "rep_parsed": """
SELECT *, CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS receivedate_parsed FROM reports_v""",
    "rep_clean": """
SELECT * FROM rep_parsed WHERE receivedate_parsed <= DATE '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY seq) = 1""",
}


def abstract_token_rows(v: Views):
    return clean.abstract_tokens(v.abstracts())


@query("top_keywords", with_views(
    """SELECT token AS term, count(*) AS count FROM (SELECT unnest(toks) AS token FROM abs_tok)
       GROUP BY token ORDER BY count DESC, term ASC LIMIT 30""", "abstracts_v", extra=ABSTRACT_FEATURE_CTES))
def q_top_keywords(spark, sf_dir):
    return eda.top_k_counts(abstract_token_rows(Views(spark, sf_dir)), "token")


@query("length_histogram", with_views(
    """SELECT b.bin, lo + b.bin * (hi - lo) / 40 AS bin_lo, lo + (b.bin + 1) * (hi - lo) / 40 AS bin_hi,
              coalesce(c.n, 0) AS n
       FROM (SELECT range AS bin FROM range(40)) b CROSS JOIN st LEFT JOIN c ON c.bin = b.bin
       WHERE lo IS NOT NULL""",
    "abstracts_v", extra={**ABSTRACT_FEATURE_CTES,
                          "f": "SELECT CAST(abstract_length AS DOUBLE) AS x FROM abs_feat",
                          "st": """SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                                          CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM f""",
                          "c": """SELECT CAST(least(floor((x - lo) * 40 / (hi - lo)), 39) AS BIGINT) AS bin,
                                         count(*) AS n FROM f, st GROUP BY 1"""}))
def q_length_histogram(spark, sf_dir):
    return eda.length_histogram(abstracts_processed_df(Views(spark, sf_dir)), "abstract_length")


@query("null_counts", with_views(
    """SELECT 'inci_name' AS column_name, count(*) FILTER (WHERE inci_name IS NULL) AS null_count FROM registry_v
       UNION ALL SELECT 'function', count(*) FILTER (WHERE function IS NULL) FROM registry_v
       UNION ALL SELECT 'regulatory_status', count(*) FILTER (WHERE regulatory_status IS NULL) FROM registry_v""",
    "registry_v"))
def q_null_counts(spark, sf_dir):
    return eda.null_counts(Views(spark, sf_dir).registry(), ["inci_name", "function", "regulatory_status"])


@query("dup_counts", with_views(
    """SELECT 'cosing' AS source, count(*) AS rows_before,
              CAST(count(DISTINCT inci_name_std) + max(CASE WHEN inci_name_std IS NULL THEN 1 ELSE 0 END) AS BIGINT)
                AS rows_after,
              CAST(count(*) - count(DISTINCT inci_name_std) - max(CASE WHEN inci_name_std IS NULL THEN 1 ELSE 0 END)
                AS BIGINT) AS removed
       FROM reg_std
       UNION ALL
       SELECT 'openfda', count(*),
              CAST(count(DISTINCT safetyreportid) + max(CASE WHEN safetyreportid IS NULL THEN 1 ELSE 0 END) AS BIGINT),
              CAST(count(*) - count(DISTINCT safetyreportid) - max(CASE WHEN safetyreportid IS NULL THEN 1 ELSE 0 END)
                AS BIGINT)
       FROM rep_parsed WHERE receivedate_parsed <= DATE '2024-01-25'""",
    "registry_v", "synonyms_v", "reports_v",
    extra={"reg_n": REG_CLEAN_CTES["reg_n"], "reg_std": REG_CLEAN_CTES["reg_std"],
           "rep_parsed": REPORTS_CLEAN_CTES["rep_parsed"]}))
def q_dup_counts(spark, sf_dir):
    v = Views(spark, sf_dir)
    reg = clean.standardise(clean.fill_defaults(v.registry()), "inci_name", v.synonyms(), "inci_name_std")
    reps = clean.plausible_dates(v.reports(), "receivedate", AS_OF, "receivedate_parsed")
    return eda.dup_counts(reg, "inci_name_std", "cosing").unionByName(
        eda.dup_counts(reps, "safetyreportid", "openfda"))


@query("missingness_summary", with_views(
    f"""SELECT 'pubmed_text' AS source, count(*) AS n_rows,
               round_even(100 * coalesce(avg(CASE WHEN pmid IS NULL OR length({S('pmid')}) = 0 THEN 1.0 ELSE 0.0 END),
                                         0), 1) AS pct_missing_key_field
        FROM abs_feat
        UNION ALL
        SELECT 'obf_images', (SELECT count(*) FROM available_v),
               round_even(100 * (1 - (SELECT count(*) FROM available_v) / greatest((SELECT count(*) FROM manifest_v), 1)),
                          1)
        UNION ALL
        SELECT 'audio_video', count(*), round_even(100 * avg(CASE WHEN captioned THEN 0.0 ELSE 1.0 END), 1)
        FROM transcripts_v
        UNION ALL
        SELECT 'cosing', count(*), round_even(100 * avg(CASE WHEN regulatory_status = 'unknown' THEN 1.0 ELSE 0.0 END), 1)
        FROM reg_clean
        UNION ALL
        SELECT 'openfda', count(*),
               round_even(100 * coalesce(avg(CASE WHEN safetyreportid IS NULL OR length({S('safetyreportid')}) = 0
                                                  THEN 1.0 ELSE 0.0 END), 0), 1)
        FROM rep_clean""",
    "abstracts_v", "available_v", "manifest_v", "transcripts_v", "registry_v", "synonyms_v", "reports_v",
    extra={**ABSTRACT_FEATURE_CTES, **REG_CLEAN_CTES, **REPORTS_CLEAN_CTES}))
def q_missingness_summary(spark, sf_dir):
    v = Views(spark, sf_dir)
    avail, manifest = v.available(), v.manifest()
    n_man = manifest.select(F.count(F.lit(1))).scalar()
    images = avail.agg(F.lit("obf_images").alias("source"), F.count(F.lit(1)).alias("n_rows"), n_man.alias("_m"))
    images = images.select("source", "n_rows", F.bround(100 * (1 - F.col("n_rows") / F.greatest("_m", F.lit(1))), 1)
                           .alias("pct_missing_key_field"))
    return eda.missingness_summary([
        eda.source_summary(abstracts_processed_df(v), "pubmed_text", is_blank("pmid")),
        images,
        eda.source_summary(v.transcripts(), "audio_video", ~F.col("captioned")),
        eda.source_summary(registry_clean_df(v), "cosing", F.col("regulatory_status") == "unknown"),
        eda.source_summary(reports_clean_df(v), "openfda", is_blank("safetyreportid")),
    ])


@query("broken_manifest", with_views(
    """SELECT (SELECT count(*) FROM manifest_v) AS n_manifest, (SELECT count(*) FROM available_v) AS n_available,
              count(*) AS n_broken,
              round_even(100 * count(*) / greatest((SELECT count(*) FROM manifest_v), 1), 1) AS pct_broken
       FROM manifest_v m WHERE NOT EXISTS (SELECT 1 FROM available_v a WHERE a.product_code = m.product_code)""",
    "manifest_v", "available_v"))
def q_broken_manifest(spark, sf_dir):
    v = Views(spark, sf_dir)
    return eda.broken_share(v.manifest(), v.available(), "product_code")


@query("caption_coverage", with_views(
    """SELECT count(*) AS n_items, count(*) FILTER (WHERE coalesce(t.captioned, false)) AS n_captioned,
              count(*) FILTER (WHERE NOT coalesce(t.captioned, false)) AS n_fallback,
              round_even(100 * avg(CASE WHEN coalesce(t.captioned, false) THEN 0.0 ELSE 1.0 END), 1) AS pct_fallback
       FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN transcripts_v t ON t.conv_id = i.conv_id""",
    "transcripts_v"))
def q_caption_coverage(spark, sf_dir):
    v = Views(spark, sf_dir)
    return eda.caption_coverage(v.table("conversations", ["conv_id"]), v.transcripts(), "conv_id", "captioned")


@query("join_segments", """
SELECT conv_id, count(*) AS n_segments, string_agg(text, ' ' ORDER BY turn) AS transcript,
       CAST(length(string_agg(text, ' ' ORDER BY turn)) AS BIGINT) AS transcript_len
FROM conversations GROUP BY conv_id""")
def q_join_segments(spark, sf_dir):
    conv = Views(spark, sf_dir).table("conversations", ["conv_id", "turn", "text"])
    return eda.join_segments(conv, "conv_id", "turn", "text")


@query("table_row_counts", with_views(
    """SELECT table_name, n_rows FROM (
         SELECT 'cosing_staging' AS table_name, count(*) AS n_rows FROM reg_clean
         UNION ALL SELECT 'pubmed_evidence', count(*) FROM abs_feat
         UNION ALL SELECT 'adverse_events', count(*) FROM rep_clean
         UNION ALL SELECT 'products', count(*) FROM labels_text_v)
       ORDER BY n_rows DESC, table_name""",
    "registry_v", "synonyms_v", "abstracts_v", "reports_v", "labels_text_v",
    extra={**REG_CLEAN_CTES, **ABSTRACT_FEATURE_CTES, **REPORTS_CLEAN_CTES}))
def q_table_row_counts(spark, sf_dir):
    v = Views(spark, sf_dir)
    return eda.table_row_counts({
        "cosing_staging": registry_clean_df(v),
        "pubmed_evidence": abstracts_processed_df(v),
        "adverse_events": reports_clean_df(v),
        "products": v.labels_text(),
    })


@query("preview", with_views(
    """SELECT inci_name_std, regulatory_status, function FROM reg_clean ORDER BY inci_name_std LIMIT 10""",
    "registry_v", "synonyms_v", extra=REG_CLEAN_CTES))
def q_preview(spark, sf_dir):
    return eda.preview(registry_clean_df(Views(spark, sf_dir)),
                       ["inci_name_std", "regulatory_status", "function"], ["inci_name_std"], 10)


@query("dedupe_first", with_views(
    """SELECT safetyreportid, seq, ingredient_term, receivedate FROM reports_v
       QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY seq) = 1""", "reports_v"))
def q_dedupe_first(spark, sf_dir):
    r = Views(spark, sf_dir).reports().select("safetyreportid", "seq", "ingredient_term", "receivedate")
    return dedupe.first_per_key(r, "safetyreportid", ["seq"])


@query("first_n_per_group", """
SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank
FROM documents QUALIFY rank <= 3""")
def q_first_n_per_group(spark, sf_dir):
    docs = Views(spark, sf_dir).table("documents", ["source", "doc_id"])
    return dedupe.first_n_per_group(docs, "source", ["doc_id"], 3, rank_col="rank")


LOADED_ABSTRACTS_CTE = {
    "loaded_abs": """
SELECT * FROM abs_feat a
WHERE EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = a.pmid)""",
}


def loaded_abstracts_df(v: Views):
    """Prior load of the evidence table: the processed abstracts that already have labels."""
    labelled = v.table("labels", ["doc_id"]).select(F.col("doc_id").cast("string").alias("pmid"))
    return abstracts_processed_df(v).join(labelled, "pmid", "left_semi")


@query("id_difference", with_views(
    """SELECT pmid FROM abs_feat a WHERE NOT EXISTS (SELECT 1 FROM loaded_abs l WHERE l.pmid = a.pmid)""",
    "abstracts_v", extra={**ABSTRACT_FEATURE_CTES, **LOADED_ABSTRACTS_CTE}))
def q_id_difference(spark, sf_dir):
    v = Views(spark, sf_dir)
    return eda.id_difference(abstracts_processed_df(v), loaded_abstracts_df(v), "pmid")
