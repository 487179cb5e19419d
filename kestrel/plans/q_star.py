"""Registered queries: star schema and OLAP."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from . import star
from .fixtures import AS_OF, Views
from .oracle_views import with_views
from .q_scoring import (
    ABSTRACT_FEATURE_CTES, PRODUCT_RISK_CTES, REG_CLEAN_CTES, RISK_WEIGHT_SQL, abstracts_processed_df,
    product_risk_df, registry_clean_df,
)
from .registry import query


class Star:
    """The star schema over one scale-factor directory (lazy plans, built once per query)."""

    def __init__(self, spark, sf_dir):
        self.v = Views(spark, sf_dir)

    @cached_property
    def dim_date(self):
        v = self.v
        dates = v.safety().select(F.col("full_date").alias("d")).unionByName(
            v.table("orders", ["o_orderdate"]).select(F.col("o_orderdate").cast("date").alias("d")))
        return star.dim_date(dates, "d")

    @cached_property
    def registry_clean(self):
        return registry_clean_df(self.v)

    @cached_property
    def dim_ingredient(self):
        return star.dim_ingredient(self.registry_clean)

    @cached_property
    def dim_product(self):
        return star.dim_product(self.v.labels_text())

    @cached_property
    def dim_reporter(self):
        return star.dim_reporter(self.v.reporter())

    @cached_property
    def ref_keys(self):
        return star.ingredient_key_by_ref(self.v.registry(), self.v.synonyms(), self.dim_ingredient)

    @cached_property
    def fact_safety_event(self):
        return star.fact_safety_event(self.v.safety(), self.ref_keys, self.dim_date, self.v.reporter(),
                                      self.dim_reporter)

    @cached_property
    def fact_ingredient_evidence(self):
        return star.fact_ingredient_evidence(self.v.evidence(), abstracts_processed_df(self.v), self.ref_keys)

    @cached_property
    def product_risk(self):
        return product_risk_df(self.v)

    @cached_property
    def fact_product_risk(self):
        return star.fact_product_risk(self.product_risk, self.dim_product, self.dim_date, AS_OF)


# --- oracle CTEs (DuckDB) ----------------------------------------------------------
STAR_CTES = {
    **PRODUCT_RISK_CTES, **ABSTRACT_FEATURE_CTES,
    "dd_bounds": """
SELECT CAST(date_trunc('year', min(d)) AS DATE) AS lo,
       CAST(date_trunc('year', max(d)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS hi
FROM (SELECT CAST(ts AS DATE) AS d FROM events UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "dim_date_o": """
SELECT CAST(datediff('day', lo, d) + 1 AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
       dayname(d) AS day_of_week
FROM (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM dd_bounds)""",
    "dim_ingredient_o": f"""
SELECT row_number() OVER (ORDER BY inci_name_std) AS ingredient_key, inci_name, inci_name_std, function,
       regulatory_status, CAST(NULL AS VARCHAR) AS concentration_limit,
       CAST({RISK_WEIGHT_SQL.format(c='regulatory_status')} AS DECIMAL(4,2)) AS risk_weight
FROM reg_clean""",
    "dim_product_o": """
SELECT row_number() OVER (ORDER BY product_code) AS product_key, product_code, CAST(NULL AS VARCHAR) AS product_name,
       category, CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS country
FROM (SELECT CAST(product_code AS VARCHAR) AS product_code, min(category) AS category
      FROM labels_text_v WHERE product_code IS NOT NULL GROUP BY 1)""",
    "dim_reporter_o": """
SELECT row_number() OVER (ORDER BY reporter_country) AS reporter_key, reporter_country, region
FROM (SELECT reporter_country, min(region) AS region FROM reporter_v GROUP BY 1)""",
    "ref_keys_o": """
SELECT r.cosing_ref_no, d.ingredient_key FROM reg_std r LEFT JOIN dim_ingredient_o d ON d.inci_name_std = r.inci_name_std""",
    "fact_safety_o": """
SELECT s.event_id, CAST(s.event_id AS VARCHAR) AS safetyreportid, dd.date_key, rk.ingredient_key,
       CAST(1 AS INTEGER) AS source_key, dr.reporter_key, s.is_serious, CAST(1 AS INTEGER) AS event_count
FROM safety_v s
LEFT JOIN dim_date_o dd ON dd.full_date = s.full_date
LEFT JOIN ref_keys_o rk ON rk.cosing_ref_no = s.cosing_ref_no
LEFT JOIN reporter_v rv ON rv.n_nationkey = s.n_nationkey
LEFT JOIN dim_reporter_o dr ON dr.reporter_country = rv.reporter_country""",
    "ev_scores": """
SELECT ingredient_term, count(*) / max(count(*)) OVER () AS evidence_score
FROM abs_feat WHERE ingredient_term IS NOT NULL GROUP BY 1""",
    "fact_evidence_o": """
SELECT e.pmid, e.cosing_ref_no, CAST(NULL AS INTEGER) AS date_key, rk.ingredient_key, CAST(2 AS INTEGER) AS source_key,
       CAST(a.abstract_length AS INTEGER) AS abstract_length, CAST(sc.evidence_score AS DECIMAL(5,4)) AS evidence_score
FROM evidence_v e JOIN abs_feat a ON a.pmid = e.pmid
LEFT JOIN ev_scores sc ON sc.ingredient_term = a.ingredient_term
LEFT JOIN ref_keys_o rk ON rk.cosing_ref_no = e.cosing_ref_no""",
    "fact_risk_o": f"""
SELECT dp.product_key, CAST(p.product_code AS VARCHAR) AS product_code,
       (SELECT max(date_key) FROM dim_date_o WHERE full_date = DATE '{AS_OF}') AS date_key,
       CAST(3 AS INTEGER) AS source_key, CAST(p.risk_score AS DECIMAL(5,4)) AS risk_score,
       CAST(p.flagged_ingredients AS INTEGER) AS flagged_ingredients,
       CAST(p.total_ingredients AS INTEGER) AS total_ingredients
FROM product_risk_r p LEFT JOIN dim_product_o dp ON dp.product_code = CAST(p.product_code AS VARCHAR)""",
}
STAR_VIEWS = ("registry_v", "synonyms_v", "labels_text_v", "abstracts_v", "safety_v", "reporter_v", "evidence_v")


def star_sql(sql: str) -> str:
    return with_views(sql, *STAR_VIEWS, extra=STAR_CTES)


@query("dim_date", star_sql("SELECT * FROM dim_date_o"))
def q_dim_date(spark, sf_dir):
    return Star(spark, sf_dir).dim_date


@query("dim_ingredient", star_sql("SELECT * FROM dim_ingredient_o"))
def q_dim_ingredient(spark, sf_dir):
    return Star(spark, sf_dir).dim_ingredient


@query("dim_product", star_sql("SELECT * FROM dim_product_o"))
def q_dim_product(spark, sf_dir):
    return Star(spark, sf_dir).dim_product


@query("dim_reporter", star_sql("SELECT * FROM dim_reporter_o"))
def q_dim_reporter(spark, sf_dir):
    return Star(spark, sf_dir).dim_reporter


@query("fact_safety_event", star_sql("SELECT * FROM fact_safety_o"))
def q_fact_safety_event(spark, sf_dir):
    return Star(spark, sf_dir).fact_safety_event.drop("event_key")


@query("fact_ingredient_evidence", star_sql("SELECT * FROM fact_evidence_o"))
def q_fact_ingredient_evidence(spark, sf_dir):
    return Star(spark, sf_dir).fact_ingredient_evidence.drop("evidence_key")


@query("fact_product_risk", star_sql("SELECT * FROM fact_risk_o"))
def q_fact_product_risk(spark, sf_dir):
    return Star(spark, sf_dir).fact_product_risk.drop("risk_key")


@query("products", with_views(
    """SELECT CAST(l.product_code AS VARCHAR) AS product_code, l.category, l.label_text AS ingredients_text,
              p.risk_score
       FROM labels_text_v l LEFT JOIN product_risk_r p ON p.product_code = l.product_code
       WHERE l.product_code IS NOT NULL""",
    "registry_v", "synonyms_v", "labels_text_v", extra=PRODUCT_RISK_CTES))
def q_products(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.products_staging(s.v.labels_text(), s.product_risk)


@query("q1_events_by_ingredient_year", star_sql(
    """SELECT i.inci_name_std, d.year, count(*) AS events
       FROM fact_safety_o f JOIN dim_ingredient_o i ON f.ingredient_key = i.ingredient_key
       JOIN dim_date_o d ON f.date_key = d.date_key
       GROUP BY i.inci_name_std, d.year ORDER BY events DESC"""))
def q_q1(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.q1_events_by_ingredient_year(s.fact_safety_event, s.dim_ingredient, s.dim_date)


@query("q2_high_risk_products", star_sql(
    """SELECT r.product_code, p.product_name, r.risk_score, r.flagged_ingredients
       FROM fact_risk_o r JOIN dim_product_o p ON r.product_key = p.product_key
       WHERE r.risk_score > 0.7 ORDER BY r.risk_score DESC"""))
def q_q2(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.q2_high_risk_products(s.fact_product_risk, s.dim_product)


@query("q3_as_written", star_sql(
    """SELECT i.inci_name_std, CAST(SUM(e.event_count) AS BIGINT) AS total_adverse_events,
              CAST(AVG(ev.evidence_score) AS DECIMAL(20,12)) AS avg_evidence_score
       FROM dim_ingredient_o i
       LEFT JOIN fact_safety_o e ON i.ingredient_key = e.ingredient_key
       LEFT JOIN fact_evidence_o ev ON i.ingredient_key = ev.ingredient_key
       GROUP BY i.inci_name_std ORDER BY total_adverse_events DESC NULLS FIRST"""))
def q_q3_as_written(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.q3_as_written(s.dim_ingredient, s.fact_safety_event, s.fact_ingredient_evidence)


@query("q3_drill_across", star_sql(
    """SELECT i.inci_name_std, CAST(e.total AS BIGINT) AS total_adverse_events, CAST(ev.avg_score AS DECIMAL(20,12)) AS avg_evidence_score
       FROM dim_ingredient_o i
       LEFT JOIN (SELECT ingredient_key, SUM(event_count) AS total FROM fact_safety_o GROUP BY 1) e
         ON i.ingredient_key = e.ingredient_key
       LEFT JOIN (SELECT ingredient_key, AVG(evidence_score) AS avg_score FROM fact_evidence_o GROUP BY 1) ev
         ON i.ingredient_key = ev.ingredient_key
       ORDER BY total_adverse_events DESC NULLS FIRST"""))
def q_q3_drill_across(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.q3_drill_across(s.dim_ingredient, s.fact_safety_event, s.fact_ingredient_evidence)
