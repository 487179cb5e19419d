"""Cleaning layer (P1-P11, J8): DataFrame -> DataFrame, no actions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (
    FUNCTION_DEFAULT, MIN_ALLOCATED_LENGTH, REGISTRY_KEPT_COLUMNS, REGISTRY_OPTIONAL_COLUMNS,
    STATUS_DEFAULT, SYNONYMS,
)
from ..functions.dates import parse_fda_date
from ..functions.text import clean_text, clean_tokens, is_blank, norm_name, py_strip
from .dedupe import attach_group_count, first_per_key
from .keys import small_lookup


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip, lower, space -> '_' on every column name."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def keep_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist (driver-side schema check, no job)."""
    present = [c for c in columns if c in df.columns]
    return df.select(*present)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Status -> 'unknown', function -> 'unspecified' where missing (columns added if absent)."""
    status = F.col("regulatory_status") if "regulatory_status" in df.columns else F.lit(None).cast("string")
    function = F.col("function") if "function" in df.columns else F.lit(None).cast("string")
    return df.withColumns({
        "regulatory_status": F.coalesce(status, F.lit(STATUS_DEFAULT)),
        "function": F.coalesce(function, F.lit(FUNCTION_DEFAULT)),
    })


def synonym_table(spark, pairs: dict[str, str] | list[tuple[str, str]] | None = None) -> DataFrame:
    """Synonym lookup as a DataFrame (default: the platform's fixed pairs)."""
    rows = list((pairs or SYNONYMS).items()) if isinstance(pairs or SYNONYMS, dict) else list(pairs)
    return spark.createDataFrame(rows, "common_name string, std_name string")


def standardise(df: DataFrame, col: str, synonyms: DataFrame, out: str) -> DataFrame:
    """J8 + H1: stripped lower-case name, mapped once through the synonyms.

    Not transitive; a null name becomes ''. The synonym table is a curated
    list (bounded), so it is broadcast.
    """
    syn = small_lookup(synonyms.select(F.col("common_name").alias("_cn"), F.col("std_name").alias("_sn")))
    named = df.withColumn("_n", norm_name(col))
    j = named.join(syn, named["_n"] == syn["_cn"], "left")
    return j.withColumn(out, F.coalesce(F.col("_sn"), F.col("_n"))).drop("_n", "_cn", "_sn")


def clean_registry(registry: DataFrame, synonyms: DataFrame, order: str = "cosing_ref_no") -> DataFrame:
    """P2 + P3 + J8 + W1: the processed registry, one row per standard name.

    ``order`` is the explicit first-wins order (file position / reference no).
    """
    keep = REGISTRY_KEPT_COLUMNS + REGISTRY_OPTIONAL_COLUMNS
    cols = [c for c in [order] + keep if c in registry.columns]
    df = fill_defaults(keep_present(registry, cols))
    df = standardise(df, "inci_name", synonyms, "inci_name_std")
    return first_per_key(df, "inci_name_std", [order])


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose stripped text is non-empty."""
    return df.filter(~is_blank(col))


def drop_null_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """P5."""
    return df.dropna(subset=[key] if isinstance(key, str) else key)


def abstract_features(abstracts: DataFrame) -> DataFrame:
    """P4 + H3-H5: non-blank abstracts with clean_text and abstract_length."""
    df = drop_blank(abstracts, "abstract").withColumn("_tok", clean_tokens("abstract"))
    return df.withColumns({
        "clean_text": clean_text("_tok"),
        "abstract_length": F.size("_tok").cast("long"),
    }).drop("_tok")


def abstract_tokens(abstracts: DataFrame) -> DataFrame:
    """Token rows (pmid, ingredient_term, token) of the non-blank abstracts, repeats kept."""
    df = drop_blank(abstracts, "abstract")
    return df.select("pmid", "ingredient_term", F.explode(clean_tokens("abstract")).alias("token"))


def choose_modified(primary: str, fallback: str):
    """``primary`` if non-empty, else ``fallback``."""
    return F.coalesce(F.nullif(F.col(primary), F.lit("")), F.col(fallback))


def plausible_dates(df: DataFrame, col: str, as_of: str, parsed: str) -> DataFrame:
    """Parse 'yyyyMMdd'; keep dates on or before ``as_of`` (drops unparseable ones)."""
    return (df.withColumn(parsed, parse_fda_date(col))
              .filter(F.col(parsed) <= F.lit(as_of).cast("date")))


def date_quality_counts(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """P6 report: future and unparseable dates, one pass."""
    d = parse_fda_date(col)
    return df.agg(F.count_if(d > F.lit(as_of).cast("date")).alias("n_future"),
                  F.count_if(d.isNull()).alias("n_unparseable"))


def clean_reports(reports: DataFrame, as_of: str, key: str = "safetyreportid", order: str = "seq") -> DataFrame:
    """P6 + W1: plausible dates, then the first report per id (by landing order)."""
    return first_per_key(plausible_dates(reports, "receivedate", as_of, "receivedate_parsed"), key, [order])


def stringify(df: DataFrame) -> DataFrame:
    """P10: nested / non-string columns to text (null stays null); JSON for nested."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("struct", "array", "map", "variant"):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        elif t == "string":
            out.append(F.col(f.name))
        else:
            out.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*out)


def allocate_length(df: DataFrame, key: str, group: str, total: str, order: str,
                    out: str = "abstract_length", minimum: int = MIN_ALLOCATED_LENGTH) -> DataFrame:
    """floor(total / rows in the batch), at least ``minimum``; key as text; first per key.

    The batch is the ``group`` (a term): all batches run in one job, and the
    first row (by ``order``) of each key inside its batch is kept. Null keys
    are dropped before the cast, so they never turn into text.
    """
    df = drop_null_keys(df, key)
    df = attach_group_count(df, group, "_batch_rows")
    df = df.withColumn(out, F.greatest(F.floor(F.col(total) / F.col("_batch_rows")),
                                       F.lit(minimum)).cast("long"))
    df = df.withColumn(key, F.col(key).cast("string")).drop("_batch_rows")
    return first_per_key(df, [group, key], [order])


__all__ = [
    "normalise_columns", "keep_present", "fill_defaults", "synonym_table", "standardise", "clean_registry",
    "drop_blank", "drop_null_keys", "abstract_features", "abstract_tokens", "choose_modified", "plausible_dates",
    "date_quality_counts", "clean_reports", "stringify", "allocate_length", "py_strip",
]
