"""Change capture and replay (CD1, CD2, W2, B1, P11).

Set-based: one join of the batch with the stored keys instead of a lookup
per record. Repeats of an id inside one batch are judged against the row
before them (W2), which is what sequential processing of the batch does:
after any record the stored date equals that record's date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_fda_date, unify_dates
from .clean import choose_modified
from .dedupe import previous_in_key
from .load import keys_in

INSERT, UPDATE, NOOP = "insert", "update", "noop"


def cdc_classify(stored: DataFrame, incoming: DataFrame, key: str = "safetyreportid", order: str = "seq",
                 stored_date: str = "receivedate", bucket_width: int = 1 << 20, expected_keys: int | None = None) -> DataFrame:
    """CD1: classify every incoming record with an id as insert / update / noop.

    ``stored`` has one row per key with a typed DATE column ``stored_date``.
    The incoming modified date is ``receiptdate`` when non-empty, else
    ``receivedate`` ('yyyyMMdd'), typed; dates compare null-safely.
    Adds ``modified`` (DATE) and ``change`` to the incoming columns. ``expected_keys``: see ``load.keys_in``.
    """
    inc = incoming.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    inc = inc.withColumn("modified", parse_fda_date(choose_modified("receiptdate", "receivedate")))
    inc = previous_in_key(inc, key, order, "modified", "_prev", "_has_prev", bucket_width)
    # only stored rows of ids in this batch take part (see ``keys_in``)
    st = keys_in(stored.select(key, F.col(stored_date).alias("_stored"), F.lit(True).alias("_exists")),
                 inc.select(key).distinct(), key, expected_keys)
    j = inc.join(st, key, "left")
    prev = F.when(F.col("_has_prev"), F.col("_prev")).otherwise(F.col("_stored"))
    exists = F.col("_has_prev") | F.col("_exists").isNotNull()
    change = (F.when(~exists, F.lit(INSERT))
              .when(prev.eqNullSafe(F.col("modified")), F.lit(NOOP))
              .otherwise(F.lit(UPDATE)))
    return j.withColumn("change", change).drop("_prev", "_has_prev", "_stored", "_exists")


def cdc_counts(classified: DataFrame) -> DataFrame:
    """CD1 totals: (change, n) for the three classes (absent classes count 0)."""
    spark = classified.sparkSession
    classes = spark.createDataFrame([(INSERT,), (UPDATE,), (NOOP,)], "change string")
    counts = classified.groupBy("change").agg(F.count(F.lit(1)).alias("n"))
    return classes.join(counts, "change", "left").select("change", F.coalesce("n", F.lit(0)).alias("n"))


def cdc_apply(stored: DataFrame, classified: DataFrame, key: str = "safetyreportid", order: str = "seq",
              term: str = "ingredient_term", stored_date: str = "receivedate", payload: str | None = None,
              loaded_at: str | None = None, expected_keys: int | None = None) -> DataFrame:
    """CD2: the stored table after the batch.

    Per id: the date of its last incoming record; the payload of its last
    insert/update (``last_change_seq`` names that record, null = unchanged);
    the ingredient term is kept on update, taken from the first record on
    insert. With ``payload`` (a column of the incoming records, also stored)
    the stored payload is replaced by that record's; with ``loaded_at`` (a
    'yyyy-MM-dd HH:mm:ss' run parameter, never the wall clock) changed rows
    get that load time and the others keep theirs.

    Per-id figures are aggregations (pre-reduced per task); only stored rows of
    the batch's ids are joined, the rest pass through.
    """
    changed_seq = F.when(F.col("change") != NOOP, F.col(order))
    aggs = [
        F.max_by("modified", F.col(order)).alias("_last_date"),
        F.max(changed_seq).alias("last_change_seq"),
        F.min_by(term, F.col(order)).alias("_first_term"),
    ]
    if payload:
        aggs.append(F.max_by(payload, changed_seq).alias("_new_payload"))   # null orderings (noops) are skipped
    per_id = classified.groupBy(key).agg(*aggs)
    extra = [c for c in (payload, "loaded_at" if loaded_at else None) if c and c in stored.columns]
    batch_keys = per_id.select(key)
    # rows of ids outside the batch pass through unchanged (anti-join with the
    # batch's key set, broadcast when small: the stored table is not shuffled)
    untouched = stored.join(batch_keys, key, "left_anti").select(
        key, term, stored_date, *extra, F.lit(None).cast("long").alias("last_change_seq"))
    st = keys_in(stored, batch_keys, key, expected_keys).select(
        key, F.col(term).alias("_st_term"), F.col(stored_date).alias("_st_date"),
        *[F.col(c).alias("_st_" + c) for c in extra], F.lit(True).alias("_st"))
    j = per_id.join(st, key, "left")
    changed = F.col("last_change_seq").isNotNull()
    cols = [
        key,
        F.when(F.col("_st").isNotNull(), F.col("_st_term")).otherwise(F.col("_first_term")).alias(term),
        F.col("_last_date").alias(stored_date),
    ]
    if payload and payload in stored.columns:
        cols.append(F.when(changed, F.col("_new_payload")).otherwise(F.col("_st_" + payload)).alias(payload))
    if loaded_at and "loaded_at" in stored.columns:
        cols.append(F.when(changed, F.lit(loaded_at).cast("timestamp")).otherwise(F.col("_st_loaded_at"))
                    .alias("loaded_at"))
    touched = j.select(*cols, "last_change_seq")
    return untouched.unionByName(touched)


def backfill(df: DataFrame, date_col: str, from_date: str, to_date: str, parsed: str = "backfill_ts") -> DataFrame:
    """B1: rows whose date lies in [from, to] (both midnight, inclusive); unparseable rows dropped.

    An absent column means no filter. Text dates go through ``unify_dates``.
    """
    if date_col not in df.columns:
        return df
    dtype = df.schema[date_col].dataType.typeName()
    ts = F.col(date_col).cast("timestamp") if dtype in ("date", "timestamp", "timestamp_ntz") \
        else unify_dates(date_col)
    lo = F.lit(from_date).cast("date").cast("timestamp")
    hi = F.lit(to_date).cast("date").cast("timestamp")
    return df.withColumn(parsed, ts).filter((F.col(parsed) >= lo) & (F.col(parsed) <= hi))
