"""Star schema (D1-D9) and the OLAP queries over it.

Dimensions get lasting keys from a key map (``keys.new_members``) or, without
one, dense keys from ``dense_key`` (range-partitioned, no
single-partition sort); facts carry their natural grain plus an ``xxhash64``
key. Foreign keys resolve by left joins to the dimensions (miss -> null).
All dimensions, the calendar too, are left to AQE (broadcast when measured
small, shuffle join otherwise): a calendar that follows the data grows with one wild date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DIM_SOURCE_ROWS
from ..functions.dates import date_parts
from ..functions.numeric import risk_weight
from ..operators import clean, keys, scoring
from ..operators.dedupe import first_per_key
from ..operators.load import insert_if_absent


def dim_date(dates: DataFrame, col: str) -> DataFrame:
    """D1 + H11: one row per day of every year the dates touch; date_key = day number from the start."""
    bounds = dates.agg(F.trunc(F.min(col).cast("date"), "year").alias("lo"),
                       F.date_sub(F.add_months(F.trunc(F.max(col).cast("date"), "year"), 12), 1).alias("hi"))
    days = bounds.select("lo", F.explode(F.sequence("lo", "hi")).alias("full_date"))
    parts = date_parts("full_date")
    return days.select((F.datediff("full_date", "lo") + 1).alias("date_key"), "full_date",
                       *[v.alias(k) for k, v in parts.items()])


def dim_date_range(spark, from_date: str, to_date: str) -> DataFrame:
    """D1 with an explicit range (e.g. 2010-01-01..2030-12-31 = 7,670 days)."""
    lo = F.lit(from_date).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(lo, F.lit(to_date).cast("date"))).alias("full_date"))
    return days.select((F.datediff("full_date", lo) + 1).alias("date_key"), "full_date",
                       *[v.alias(k) for k, v in date_parts("full_date").items()])


def dim_source(spark) -> DataFrame:
    """The six fixed sources."""
    return spark.createDataFrame(DIM_SOURCE_ROWS, "source_key int, source_name string, source_type string, "
                                                  "extraction_method string")


def source_key(name: str):
    """Key of a fixed source (the dimension is a constant table)."""
    return F.lit({r[1]: r[0] for r in DIM_SOURCE_ROWS}[name]).cast("int")


def _keyed(df: DataFrame, member: str, key: str, key_map: DataFrame | None) -> DataFrame:
    """The dimension's rows with their key: the lasting one of ``key_map``, or dense numbers of this very table."""
    if key_map is None:
        return keys.dense_key(df, [member], key)
    return df.join(key_map.select(member, key), member, "left").select(key, *df.columns)


def dim_ingredient(registry_clean: DataFrame, key_map: DataFrame | None = None) -> DataFrame:
    """D3 + H13: one row per standard name with its risk weight as decimal(4,2)."""
    df = registry_clean.select(
        "inci_name", "inci_name_std", "function", "regulatory_status",
        (F.col("concentration_limit") if "concentration_limit" in registry_clean.columns
         else F.lit(None).cast("string")).alias("concentration_limit"),
        risk_weight("regulatory_status").cast("decimal(4,2)").alias("risk_weight"))
    return _keyed(df, "inci_name_std", "ingredient_key", key_map)


def dim_product(labels: DataFrame, code: str = "product_code", category: str = "category", key_map: DataFrame | None = None) -> DataFrame:
    """One row per product code (text); name, brand and country are not in the sources (null)."""
    df = clean.drop_null_keys(labels.select(F.col(code).cast("string").alias("product_code"),
                                            F.col(category).alias("category")), "product_code")
    df = df.groupBy("product_code").agg(F.min("category").alias("category"))
    df = df.select("product_code", F.lit(None).cast("string").alias("product_name"), "category",
                   F.lit(None).cast("string").alias("brand"), F.lit(None).cast("string").alias("country"))
    return _keyed(df, "product_code", "product_key", key_map)


def dim_reporter(reporters: DataFrame, key_map: DataFrame | None = None) -> DataFrame:
    """Country -> region, one row per country."""
    df = reporters.groupBy("reporter_country").agg(F.min("region").alias("region"))
    return _keyed(df, "reporter_country", "reporter_key", key_map)


def ingredient_key_by_ref(registry: DataFrame, synonyms: DataFrame, dim_ing: DataFrame) -> DataFrame:
    """J10 helper: registry reference number -> ingredient_key (via the standard name)."""
    std = clean.standardise(registry.select("cosing_ref_no", "inci_name"), "inci_name", synonyms, "inci_name_std")
    return std.join(dim_ing.select("inci_name_std", "ingredient_key"), "inci_name_std", "left") \
              .select("cosing_ref_no", "ingredient_key")


def fact_safety_event(safety: DataFrame, ref_keys: DataFrame, dim_dt: DataFrame, reporters: DataFrame,
                      dim_rep: DataFrame) -> DataFrame:
    """One row per report x ingredient; event_count 1; foreign keys by left joins."""
    rep = reporters.select("n_nationkey", "reporter_country").join(
        dim_rep.select("reporter_country", "reporter_key"), "reporter_country", "left")
    f = (safety.join(dim_dt.select("full_date", "date_key"), "full_date", "left")
               .join(ref_keys, "cosing_ref_no", "left")
               .join(rep.select("n_nationkey", "reporter_key"), "n_nationkey", "left"))
    return f.select(
        F.xxhash64("event_id", "cosing_ref_no").alias("event_key"),
        "event_id", F.col("event_id").cast("string").alias("safetyreportid"),
        "date_key", "ingredient_key", source_key("openFDA").alias("source_key"), "reporter_key",
        "is_serious", F.lit(1).cast("int").alias("event_count"))


def fact_ingredient_evidence(evidence: DataFrame, processed: DataFrame, ref_keys: DataFrame) -> DataFrame:
    """One row per processed abstract x ingredient, with the term's evidence score as decimal(5,4)."""
    scores = scoring.evidence_scores(processed)
    f = (evidence.join(processed.select("pmid", "ingredient_term", "abstract_length"), "pmid")
                 .join(scores.select("ingredient_term", "evidence_score"), "ingredient_term", "left")
                 .join(ref_keys, "cosing_ref_no", "left"))
    return f.select(
        F.xxhash64("pmid", "cosing_ref_no").alias("evidence_key"),
        "pmid", "cosing_ref_no", F.lit(None).cast("int").alias("date_key"), "ingredient_key",
        source_key("PubMed").alias("source_key"), F.col("abstract_length").cast("int").alias("abstract_length"),
        F.col("evidence_score").cast("decimal(5,4)").alias("evidence_score"))


def missing_keys(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows (fact, foreign_key, n_rows, n_missing): how many rows of each fact found no member, out-of-calendar dates among them."""
    parts = []
    for name, df in facts.items():
        cols = [c for c in ("date_key", "ingredient_key", "product_key", "reporter_key") if c in df.columns]
        counts = F.array(*[F.struct(F.lit(c).alias("foreign_key"), F.count_if(F.col(c).isNull()).alias("n_missing")) for c in cols])
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), counts.alias("c")).select(F.lit(name).alias("fact"), "n_rows", F.inline("c")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("fact", "foreign_key", "n_rows", "n_missing")


def fact_product_risk(risk: DataFrame, dim_prod: DataFrame, dim_dt: DataFrame, run_date: str) -> DataFrame:
    """One assessment per product per run date (A2-A4 measures)."""
    # the run date's key is one value: a scalar subquery over the calendar
    day_key = dim_dt.filter(F.col("full_date") == F.lit(run_date).cast("date")).select(F.max("date_key")).scalar()
    f = (risk.withColumn("product_code", F.col("product_code").cast("string"))
             .join(dim_prod.select("product_code", "product_key"), "product_code", "left"))
    return f.select(
        F.xxhash64("product_code", F.lit(run_date)).alias("risk_key"),
        "product_key", "product_code", day_key.alias("date_key"), source_key("OBF").alias("source_key"),
        F.col("risk_score").cast("decimal(5,4)").alias("risk_score"),
        F.col("flagged_ingredients").cast("int").alias("flagged_ingredients"),
        F.col("total_ingredients").cast("int").alias("total_ingredients"))


def products_staging(labels: DataFrame, risk: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Products (product_code, category, ingredients_text, risk_score) inserted if absent."""
    rows = labels.select(F.col("product_code").cast("string").alias("product_code"), "category",
                         F.col("label_text").alias("ingredients_text"), F.col("product_code").alias("_ord")) \
                 .join(risk.select(F.col("product_code").cast("string").alias("product_code"), "risk_score"),
                       "product_code", "left")
    if target is None:   # inserting into an empty table keeps the first row of each code
        cols = ["product_code", "category", "ingredients_text", "risk_score"]
        return first_per_key(rows.dropna(subset=["product_code"]), "product_code", ["_ord"]).select(*cols)
    return insert_if_absent(target, rows, "product_code", ["_ord"])


# --- OLAP ------------------------------------------------------------------

def q1_events_by_ingredient_year(fact: DataFrame, dim_ing: DataFrame, dim_dt: DataFrame) -> DataFrame:
    """Q1 (J5): adverse events by ingredient by year (inner joins), most first."""
    j = fact.join(dim_ing.select("ingredient_key", "inci_name_std"), "ingredient_key") \
            .join(dim_dt.select("date_key", "year"), "date_key")
    return j.groupBy("inci_name_std", "year").agg(F.count(F.lit(1)).alias("events")) \
            .orderBy(F.desc("events"), "inci_name_std", "year")


def q2_high_risk_products(fact: DataFrame, dim_prod: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Q2 (P7 + J6): products scoring above the threshold, highest first (nulls first in DESC)."""
    j = fact.filter(F.col("risk_score") > F.lit(threshold)).join(
        dim_prod.select("product_key", "product_name"), "product_key")
    return j.select("product_code", "product_name", "risk_score", "flagged_ingredients") \
            .orderBy(F.col("risk_score").desc_nulls_first(), "product_code")


def _exact_avg(total, count):
    """Mean of NUMERIC scores kept exact (decimal division), as PostgreSQL's AVG(numeric) is."""
    return (total / count).cast("decimal(20,12)")


def _per_ingredient(dim_ing: DataFrame, events: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per ingredient: event sum and count, evidence score sum and counts (each fact pre-aggregated)."""
    ev = events.groupBy("ingredient_key").agg(F.sum("event_count").alias("_sum_events"),
                                              F.count(F.lit(1)).alias("_n_events"))
    evd = evidence.groupBy("ingredient_key").agg(F.sum("evidence_score").alias("_sum_score"),
                                                 F.count("evidence_score").alias("_n_score"),
                                                 F.count(F.lit(1)).alias("_n_evidence"))
    return dim_ing.select("ingredient_key", "inci_name_std").join(ev, "ingredient_key", "left") \
                  .join(evd, "ingredient_key", "left")


def q3_drill_across(dim_ing: DataFrame, events: DataFrame, evidence: DataFrame) -> DataFrame:
    """Q3, drill-across (default): aggregate each fact per ingredient first, then join."""
    j = _per_ingredient(dim_ing, events, evidence)
    out = j.groupBy("inci_name_std").agg(
        F.sum("_sum_events").alias("total_adverse_events"),
        _exact_avg(F.sum("_sum_score"), F.sum("_n_score")).alias("avg_evidence_score"))
    return out.orderBy(F.col("total_adverse_events").desc_nulls_first(), "inci_name_std")


def q3_as_written(dim_ing: DataFrame, events: DataFrame, evidence: DataFrame) -> DataFrame:
    """Q3 as written: dimension LEFT JOIN both facts in one pass, then SUM / AVG.

    That join repeats every event once per evidence row of the ingredient, so
    its SUM is the event sum times max(evidence rows, 1), while every score is
    repeated max(event rows, 1) times, which leaves the AVG unchanged.
    Computed here from per-ingredient aggregates with exactly that result, so
    the pairs themselves are never materialised.
    """
    j = _per_ingredient(dim_ing, events, evidence)
    mult = F.greatest(F.coalesce(F.col("_n_evidence"), F.lit(0)), F.lit(1))
    out = j.groupBy("inci_name_std").agg(
        F.sum(F.col("_sum_events") * mult).alias("total_adverse_events"),
        _exact_avg(F.sum("_sum_score"), F.sum("_n_score")).alias("avg_evidence_score"))
    return out.orderBy(F.col("total_adverse_events").desc_nulls_first(), "inci_name_std")


__all__ = [
    "missing_keys", "dim_date", "dim_date_range", "dim_source", "dim_ingredient", "dim_product", "dim_reporter",
    "ingredient_key_by_ref", "fact_safety_event", "fact_ingredient_evidence", "fact_product_risk",
    "products_staging", "q1_events_by_ingredient_year", "q2_high_risk_products", "q3_drill_across", "q3_as_written",
]
