"""Reports (A5-A12, A16, J9, J11, T1, T3, U4): small outputs from full scans.

Global figures (min/max, totals) enter row-level expressions as scalar
subqueries (``DataFrame.scalar()``), never through a driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import HISTOGRAM_BINS, TOP_KEYWORDS
from ..functions.numeric import pct
from .keys import materialize, small_lookup


def top_k_counts(tokens: DataFrame, col: str, k: int = TOP_KEYWORDS, term_alias: str = "term") -> DataFrame:
    """A5 + T1: most frequent values, ties by value (repeatable). Limit is the feature.

    groupBy is partially aggregated per task; orderBy+limit plans as
    TakeOrderedAndProject (top-k per partition, then merged).
    """
    counts = tokens.groupBy(F.col(col).alias(term_alias)).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(term_alias)).limit(k)


def length_histogram(df: DataFrame, col: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between min and max (last bin closed); empty bins kept.

    When min == max the range is widened by 0.5 on each side, as numpy does.
    Output: (bin, bin_lo, bin_hi, n).
    """
    x = F.col(col).cast("double")
    # One pass over the data: counts per distinct value (partial aggregation),
    # materialised once (one row per distinct value, so small). The range is a
    # scalar subquery over it; binning and the bin edges read plain columns.
    by_value = materialize(df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
                             .groupBy("_x").agg(F.count(F.lit(1)).alias("_n")))
    bounds = by_value.select(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    b = by_value.withColumn("_b", bounds)
    same = F.col("_b.lo") == F.col("_b.hi")
    b = b.select("_x", "_n",
                 F.when(same, F.col("_b.lo") - 0.5).otherwise(F.col("_b.lo")).alias("_lo"),
                 F.when(same, F.col("_b.hi") + 0.5).otherwise(F.col("_b.hi")).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    idx = F.least(F.floor((F.col("_x") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("long")
    counts = b.groupBy(idx.alias("bin"), "_lo", "_hi").agg(F.sum("_n").alias("n"))
    # every bin, also the empty ones: ``bins`` rows generated from the (single) range row
    edges = (counts.select("_lo", "_hi").distinct()
             .select("_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")))
                     .alias("bin")))
    edges = edges.select("bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_hi"))
    # both sides hold at most ``bins`` rows by construction
    out = small_lookup(counts.select("bin", "n")).join(edges, "bin", "right")
    return out.select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column in one pass, long form (column_name, null_count)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_count")


def dup_counts(df: DataFrame, key: str, source: str) -> DataFrame:
    """A10: rows removed by a first-per-key dedupe (a null key counts as one value)."""
    return df.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("rows_before"),
        (F.count_distinct(F.col(key)) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).alias("_after"),
    ).select("source", "rows_before",
             F.coalesce("_after", F.lit(0)).cast("long").alias("rows_after"),
             (F.col("rows_before") - F.coalesce("_after", F.lit(0))).cast("long").alias("removed"))


def source_summary(df: DataFrame, source: str, missing: F.Column) -> DataFrame:
    """One A7 row: (source, n_rows, pct_missing_key_field) with ``missing`` a per-row flag."""
    return df.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("n_rows"),
        pct(100 * F.coalesce(F.avg(F.when(missing, 1.0).otherwise(0.0)), F.lit(0.0))).alias("pct_missing_key_field"),
    )


def broken_share(manifest: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Manifest entries with no processed row; count and percent."""
    broken = manifest.join(available.select(key).distinct(), key, "left_anti")
    n_manifest = manifest.select(F.count(F.lit(1))).scalar()
    n_available = available.select(F.count(F.lit(1))).scalar()
    counts = broken.agg(F.count(F.lit(1)).alias("n_broken")).select(
        n_manifest.alias("n_manifest"), n_available.alias("n_available"), "n_broken")
    return counts.withColumn("pct_broken",
                             pct(100 * F.col("n_broken") / F.greatest(F.col("n_manifest"), F.lit(1))))


def missingness_summary(parts: list[DataFrame]) -> DataFrame:
    """A7 + U1: union of the per-source rows."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def caption_coverage(items: DataFrame, transcripts: DataFrame, key: str, flag: str) -> DataFrame:
    """J11 + A11: items without a caption need the fallback; count and percent."""
    j = items.select(key).distinct().join(transcripts.select(key, flag), key, "left")
    needs = ~F.coalesce(F.col(flag), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("n_items"),
                 F.count_if(~needs).alias("n_captioned"),
                 F.count_if(needs).alias("n_fallback"),
                 pct(100 * F.avg(needs.cast("double"))).alias("pct_fallback"))


def join_segments(segments: DataFrame, key: str, pos: str, text: str, bucket: int = 1024) -> DataFrame:
    """A media item's segments joined by one space, in order; and its length.

    Two levels, so a very long item is not sorted in one task: segments are
    first joined per (item, position range of ``bucket`` segments), spread
    over tasks; then the item's partial texts (one per range) are joined in
    range order. The transcript is one value per item, so its parts meet in
    one row at the end.
    """
    part = segments.withColumn("_b", F.floor(F.col(pos) / F.lit(bucket)))
    partial = part.groupBy(key, "_b").agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(text)))),
                                 lambda s: s[text]), " ").alias("_part"))
    agg = partial.groupBy(key).agg(
        F.sum("_n").alias("n_segments"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_part"))),
                                 lambda s: s["_part"]), " ").alias("transcript"))
    return agg.withColumn("transcript_len", F.length("transcript").cast("long"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("n_rows"), "table_name")


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows of chosen columns under an explicit order (limit is the feature)."""
    return df.select(*columns).orderBy(*order).limit(n)


def id_difference(ids: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """U4: ids not yet loaded (anti-join; both sides shuffle on the key)."""
    return ids.select(key).join(loaded.select(key), key, "left_anti")
