"""Registered queries: cleaning and scoring (product risk, evidence, match check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import coerce_int
from ..functions.text import norm_name
from ..operators import clean, scoring
from .fixtures import AS_OF, Views
from .oracle_views import sql_clean_tokens, sql_strip, with_views
from .registry import query

S = sql_strip

# ---------------------------------------------------------------------------
# Shared oracle CTEs (DuckDB): cleaned registry and standardised label tokens.
REG_CLEAN_CTES = {
    "reg_n": f"""
SELECT cosing_ref_no, inci_name, coalesce(function, 'unspecified') AS function,
       coalesce(regulatory_status, 'unknown') AS regulatory_status,
       coalesce(lower({S('inci_name')}), '') AS nm
FROM registry_v""",
    "reg_std": """
SELECT r.cosing_ref_no, r.inci_name, r.function, r.regulatory_status,
       coalesce(s.std_name, r.nm) AS inci_name_std
FROM reg_n r LEFT JOIN synonyms_v s ON s.common_name = r.nm""",
    "reg_clean": """
SELECT * FROM reg_std
QUALIFY row_number() OVER (PARTITION BY inci_name_std ORDER BY cosing_ref_no) = 1""",
}

LABEL_TOKEN_CTES = {
    "tok": f"""
SELECT product_code, unnest(list_filter(string_split(replace(label_text, chr(10), ','), ','),
                                        lambda t: length({S('t')}) > 0)) AS token
FROM labels_text_v""",
    "tok_std": f"""
SELECT t.product_code, coalesce(s.std_name, lower({S('t.token')})) AS std
FROM tok t LEFT JOIN synonyms_v s ON s.common_name = lower({S('t.token')})""",
}

RISK_WEIGHT_SQL = ("CAST(CASE {c} WHEN 'restricted' THEN 0.8 WHEN 'banned' THEN 1.0 WHEN 'allowed' THEN 0.1 "
                   "WHEN 'unknown' THEN 0.4 ELSE 0.4 END AS DOUBLE)")

PRODUCT_RISK_CTES = {
    **REG_CLEAN_CTES, **LABEL_TOKEN_CTES,
    "scored": """
SELECT t.product_code, coalesce(r.regulatory_status, 'unknown') AS st
FROM tok_std t LEFT JOIN reg_clean r ON r.inci_name_std = t.std""",
    "risk_agg": f"""
SELECT product_code, avg({RISK_WEIGHT_SQL.format(c='st')}) AS risk_score,
       max({RISK_WEIGHT_SQL.format(c='st')}) AS risk_max,
       count(*) FILTER (WHERE st IN ('restricted', 'banned')) AS flagged_ingredients,
       count(*) AS total_ingredients
FROM scored GROUP BY product_code""",
    "product_risk_r": """
SELECT l.product_code, a.risk_score, a.risk_max,
       coalesce(a.flagged_ingredients, 0) AS flagged_ingredients,
       coalesce(a.total_ingredients, 0) AS total_ingredients
FROM labels_text_v l LEFT JOIN risk_agg a ON a.product_code = l.product_code""",
}

ABSTRACT_FEATURE_CTES = {
    "abs_tok": f"""
SELECT pmid, ingredient_term, {sql_clean_tokens('abstract')} AS toks
FROM abstracts_v WHERE length({S('abstract')}) > 0""",
    "abs_feat": """
SELECT pmid, ingredient_term, array_to_string(toks, ' ') AS clean_text, CAST(len(toks) AS BIGINT) AS abstract_length
FROM abs_tok""",
}


def registry_clean_df(v: Views):
    return clean.clean_registry(v.registry(), v.synonyms())


def product_risk_df(v: Views):
    return scoring.product_risk(v.labels_text(), registry_clean_df(v), v.synonyms())


def abstracts_processed_df(v: Views):
    return clean.abstract_features(v.abstracts())


def reports_clean_df(v: Views):
    return clean.clean_reports(v.reports(), AS_OF)


@query("product_risk", with_views("SELECT * FROM product_risk_r", "registry_v", "synonyms_v", "labels_text_v",
                                  extra=PRODUCT_RISK_CTES))
def q_product_risk(spark, sf_dir):
    return product_risk_df(Views(spark, sf_dir))


@query("registry_clean", with_views(
    "SELECT cosing_ref_no, inci_name, function, regulatory_status, inci_name_std FROM reg_clean",
    "registry_v", "synonyms_v", extra=REG_CLEAN_CTES))
def q_registry_clean(spark, sf_dir):
    return registry_clean_df(Views(spark, sf_dir))


@query("standardise_names", with_views(
    "SELECT cosing_ref_no, inci_name, inci_name_std FROM reg_std", "registry_v", "synonyms_v",
    extra={k: REG_CLEAN_CTES[k] for k in ("reg_n", "reg_std")}))
def q_standardise_names(spark, sf_dir):
    v = Views(spark, sf_dir)
    return clean.standardise(v.registry(), "inci_name", v.synonyms(), "inci_name_std") \
                .select("cosing_ref_no", "inci_name", "inci_name_std")


@query("label_tokens", with_views(
    f"""SELECT product_code, CAST(pos - 1 AS INTEGER) AS pos, token, lower({S('token')}) AS token_norm FROM (
          SELECT product_code, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos FROM (
            SELECT product_code, list_filter(string_split(replace(label_text, chr(10), ','), ','),
                                             lambda t: length({S('t')}) > 0) AS toks
            FROM labels_text_v))""", "labels_text_v"))
def q_label_tokens(spark, sf_dir):
    rows = scoring.label_token_rows(Views(spark, sf_dir).labels_text(), "product_code", "label_text")
    return rows.withColumn("token_norm", norm_name("token"))


@query("evidence_scores", with_views(
    """SELECT ingredient_term, count(*) AS pubmed_hits,
              count(*) / max(count(*)) OVER () AS evidence_score
       FROM abstracts_v WHERE length(""" + S("abstract") + """) > 0 AND ingredient_term IS NOT NULL
       GROUP BY ingredient_term""", "abstracts_v"))
def q_evidence_scores(spark, sf_dir):
    return scoring.evidence_scores(abstracts_processed_df(Views(spark, sf_dir)))


@query("cross_source_match", with_views(
    f"""SELECT count(*) AS obf_ingredients_checked, count(n.name) AS matched_in_cosing,
               round_even(100 * (1 - count(n.name) / count(*)), 1) AS pct_unmatched
        FROM (SELECT coalesce(lower({S('token')}), '') AS name FROM tok) t
        LEFT JOIN (SELECT DISTINCT inci_name_std AS name FROM reg_clean WHERE inci_name_std IS NOT NULL) n
          ON n.name = t.name
        HAVING count(*) > 0""",
    "registry_v", "synonyms_v", "labels_text_v",
    extra={**REG_CLEAN_CTES, "tok": LABEL_TOKEN_CTES["tok"]}))
def q_cross_source_match(spark, sf_dir):
    v = Views(spark, sf_dir)
    return scoring.match_check(v.labels_text(), registry_clean_df(v))


@query("abstract_features", with_views("SELECT * FROM abs_feat", "abstracts_v", extra=ABSTRACT_FEATURE_CTES))
def q_abstract_features(spark, sf_dir):
    return abstracts_processed_df(Views(spark, sf_dir)).select(
        "pmid", "ingredient_term", "clean_text", "abstract_length")


@query("reports_clean", with_views(
    """SELECT seq, safetyreportid, ingredient_term, receivedate, receivedate_parsed FROM (
         SELECT *, CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS receivedate_parsed FROM reports_v)
       WHERE receivedate_parsed <= DATE '""" + AS_OF + """'
       QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY seq) = 1""", "reports_v"))
def q_reports_clean(spark, sf_dir):
    return reports_clean_df(Views(spark, sf_dir)).select(
        "seq", "safetyreportid", "ingredient_term", "receivedate", "receivedate_parsed")


@query("coerce_int", with_views(
    """SELECT seq, CAST(trunc(coalesce(TRY_CAST(receivedate AS DOUBLE), 0)) AS BIGINT) AS receivedate_int,
              CAST(trunc(coalesce(TRY_CAST(CAST(src_value AS VARCHAR) AS DOUBLE), 0)) AS BIGINT) AS value_int
       FROM reports_v""", "reports_v"))
def q_coerce_int(spark, sf_dir):
    return Views(spark, sf_dir).reports("value").select(
        "seq", coerce_int("receivedate").alias("receivedate_int"), coerce_int("value").alias("value_int"))


@query("allocate_length", with_views(
    """SELECT ingredient_term, pmid, CAST(greatest(floor(length(abstract) / n), 5) AS BIGINT) AS abstract_length
       FROM (SELECT *, count(*) OVER (PARTITION BY ingredient_term) AS n FROM abstracts_v WHERE pmid IS NOT NULL)
       QUALIFY row_number() OVER (PARTITION BY ingredient_term, pmid ORDER BY pmid) = 1""", "abstracts_v"))
def q_allocate_length(spark, sf_dir):
    v = Views(spark, sf_dir)
    df = v.abstracts().withColumn("_len", F.length("abstract"))
    out = clean.allocate_length(df, "pmid", "ingredient_term", "_len", order="pmid")
    return out.select("ingredient_term", "pmid", "abstract_length")


@query("date_quality", with_views(
    """SELECT count(*) FILTER (WHERE d > DATE '""" + AS_OF + """') AS n_future,
              count(*) FILTER (WHERE d IS NULL) AS n_unparseable
       FROM (SELECT CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS d FROM reports_v)""", "reports_v"))
def q_date_quality(spark, sf_dir):
    return clean.date_quality_counts(Views(spark, sf_dir).reports(), "receivedate", AS_OF)
