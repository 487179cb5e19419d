"""Scoring (J1, J2, A1-A4, A8): label tokens against the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FLAGGED_STATUSES, STATUS_DEFAULT
from ..functions.numeric import pct, risk_weight
from ..functions.text import label_tokens, norm_name
from .clean import standardise


def label_token_rows(labels: DataFrame, code: str, text: str) -> DataFrame:
    """H2 exploded: (code, pos, token) for every non-blank piece of a label."""
    return labels.select(code, F.posexplode(label_tokens(text)).alias("pos", "token"))


def product_risk(labels: DataFrame, registry_clean: DataFrame, synonyms: DataFrame,
                 code: str = "product_code", text: str = "label_text") -> DataFrame:
    """J1 + A2-A4: per product mean and max risk weight over its label tokens.

    Tokens are standardised (strip, lower, synonyms), looked up in the
    registry (miss -> status 'unknown'), weighted (unknown word -> 0.4) and
    averaged with repeats counted. Products with no tokens keep a row with a
    null score and zero counts.

    Plan: explode -> join registry on the standard name (the registry is a
    dimension; AQE broadcasts it when its measured size allows, otherwise a
    shuffle join with skew splitting) -> partial aggregation per product.
    One shuffle (the aggregation) when the registry is broadcast.
    """
    # explode_outer keeps a product without tokens as one row with a null token,
    # so the aggregate below yields every product without a join back
    tokens = labels.select(code, F.explode_outer(label_tokens(text)).alias("token"))
    tokens = standardise(tokens, "token", synonyms, "std")
    tokens = tokens.withColumn("std", F.when(F.col("token").isNotNull(), F.col("std")))
    reg = registry_clean.select(F.col("inci_name_std").alias("std"), F.col("regulatory_status").alias("_status"))
    scored = tokens.join(reg, "std", "left")
    has_token = F.col("token").isNotNull()
    status = F.coalesce(F.col("_status"), F.lit(STATUS_DEFAULT))
    weight = F.when(has_token, risk_weight(status))
    return scored.groupBy(code).agg(
        F.avg(weight).alias("risk_score"),
        F.max(weight).alias("risk_max"),
        F.count_if(has_token & status.isin(*FLAGGED_STATUSES)).cast("long").alias("flagged_ingredients"),
        F.count("token").cast("long").alias("total_ingredients"),
    )


def evidence_scores(processed_abstracts: DataFrame, term: str = "ingredient_term") -> DataFrame:
    """A1: hits per term / the largest hit count (null terms excluded; max 0 -> 1)."""
    counts = (processed_abstracts.filter(F.col(term).isNotNull())
              .groupBy(term).agg(F.count(F.lit(1)).alias("pubmed_hits")))
    # the largest count enters as a scalar subquery over the (one row per term) result
    mx = counts.select(F.max("pubmed_hits")).scalar()
    with_max = counts.withColumn("_mx", mx)       # the subquery enters once, as a column
    return with_max.select(term, "pubmed_hits",
                           (F.col("pubmed_hits") / F.coalesce(F.nullif("_mx", F.lit(0)), F.lit(1)))
                           .alias("evidence_score"))


def match_check(labels: DataFrame, registry_clean: DataFrame, code: str = "product_code",
                text: str = "label_text") -> DataFrame:
    """J2 + A8 + U3: how many label tokens (stripped, lower, no synonyms) exist in the registry.

    Token multiplicity is kept; the registry side is its distinct standard
    names, so the left join cannot fan out. No tokens -> no row.
    """
    tokens = label_token_rows(labels, code, text).select(norm_name("token").alias("name"))
    names = registry_clean.select(F.col("inci_name_std").alias("name")).dropna().distinct() \
                          .withColumn("_hit", F.lit(1))
    j = tokens.join(names, "name", "left")
    agg = j.agg(F.count(F.lit(1)).alias("obf_ingredients_checked"),
                F.count("_hit").alias("matched_in_cosing"))
    return agg.filter(F.col("obf_ingredients_checked") > 0).select(
        "obf_ingredients_checked", "matched_in_cosing",
        pct(100 * (1 - F.col("matched_in_cosing") / F.col("obf_ingredients_checked"))).alias("pct_unmatched"))
