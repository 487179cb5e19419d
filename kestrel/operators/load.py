"""Load strategies as set operations.

A target table is a DataFrame (read from its published version, see
``sinks.publish``); a load returns the next version of it. Watermarks are
rows of a small (source -> value) table and enter filters as scalar
subqueries or joins, never as driver-side values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import NO_WATERMARK_START
from .clean import drop_null_keys
from .dedupe import first_per_key


def _cols(x: Sequence[str] | str) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


BROADCAST_KEYS = 200_000        # batches of more keys get a Bloom filter, as their keys may not be broadcast
BLOOM_BITS_PER_KEY = 16
BLOOM_MAX_WORDS = 1 << 20       # 8 MB; beyond, the filter lets more rows pass, but never drops one


def bloom_words(batch_keys: DataFrame, key: str, n_keys: int) -> Column:
    """A Bloom filter of the keys as a scalar subquery: an array of 64-bit words.

    Register-blocked: a key sets four bits of one word, so a test reads one word.
    Built by ``bit_or`` per word (reduced map-side); the result has at most ``BLOOM_MAX_WORDS`` words.
    """
    spark = batch_keys.sparkSession
    n = _bloom_size(n_keys)
    words = batch_keys.groupBy(_bloom_word(key, n).alias("i")).agg(F.bit_or(_bloom_mask(key)).alias("w"))
    full = spark.range(n).join(words, F.col("id") == F.col("i"), "left").select("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))), lambda x: x["w"])).scalar()


def _bloom_size(n_keys: int) -> int:
    return min(max(n_keys * BLOOM_BITS_PER_KEY // 64, 1), BLOOM_MAX_WORDS)


def _bloom_word(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("long")


def _bloom_mask(key: str) -> Column:
    h = F.xxhash64(F.lit("bloom"), F.col(key))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def maybe_in(table: DataFrame, batch_keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """The table's rows whose key may be in the batch, without a shuffle of the table: no row of the batch's keys is lost,
    about 1 in 200 of the others passes."""
    # one read of the word: the subquery's value is then tested per row inside the scan's stage
    word = F.element_at(bloom_words(batch_keys, key, n_keys), (_bloom_word(key, _bloom_size(n_keys)) + 1).cast("int"))
    return table.where(word.bitwiseAND(_bloom_mask(key)) == _bloom_mask(key))


def keys_in(table: DataFrame, batch_keys: DataFrame, key: str, expected_keys: int | None = None) -> DataFrame:
    """The table's rows whose key occurs in the batch.

    The batch's key set is the small side: once AQE measures it below the
    broadcast threshold it is broadcast and the (large) table is filtered
    map-side, without shuffling it. A batch known to have more than ``BROADCAST_KEYS`` keys (``expected_keys``)
    is first turned into a Bloom filter, so that of the table little more than the batch's own rows is shuffled for the exact join.
    """
    if expected_keys is not None and expected_keys > BROADCAST_KEYS:
        table = maybe_in(table, batch_keys, key, expected_keys)
    return table.join(batch_keys, key, "left_semi")


def new_rows(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str] | str, expected_keys: int | None = None) -> DataFrame:
    """Rows ``insert_if_absent`` would add: first per key in the batch, key not in the target."""
    first = first_per_key(drop_null_keys(batch, key), key, _cols(order))
    present = keys_in(target.select(key), first.select(key), key, expected_keys)
    return first.join(present, key, "left_anti")


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str] | str) -> DataFrame:
    """Existing rows win, the first batch row per key wins, a rerun adds nothing.

    Plan: aggregate-based dedupe of the batch; the target's keys narrowed to
    the batch's (``keys_in``), then an anti-join of two batch-sized sides;
    union. Output has the target's columns.
    """
    return target.unionByName(new_rows(target, batch, key, order).select(*target.columns))


def numeric_id(key: str) -> Column:
    """An id as a number, null when not numeric (never throws)."""
    return F.col(key).try_cast("long")


def above_id_watermark(batch: DataFrame, key: str, watermark: Column | None) -> DataFrame:
    """K2 filter: numeric id strictly above the watermark; no watermark -> all numeric ids."""
    n = numeric_id(key)
    if watermark is None:
        return batch.filter(n.isNotNull())
    # the watermark (a scalar subquery) enters once, as a column: each textual
    # reference to a subquery would otherwise be planned and run separately
    wm = F.col("_wm")
    return batch.withColumn("_wm", watermark.cast("long")) \
                .filter(n.isNotNull() & (wm.isNull() | (n > wm))).drop("_wm")


def non_numeric_ids(batch: DataFrame, key: str) -> DataFrame:
    """K2 rejects: ids that are present but not numeric (set aside and counted, not thrown)."""
    return batch.filter(F.col(key).isNotNull() & numeric_id(key).isNull())


def incremental_by_id(target: DataFrame, batch: DataFrame, key: str, watermark: Column | None,
                      order: Sequence[str] | str) -> DataFrame:
    """K2: keep ids above the watermark, insert the absent ones (next target version)."""
    return insert_if_absent(target, above_id_watermark(drop_null_keys(batch, key), key, watermark), key, order)


def incremental_by_date(target: DataFrame, batch: DataFrame, key: str, date_col: str,
                        watermark: Column | None, order: Sequence[str] | str) -> DataFrame:
    """K3: keep typed dates strictly after the watermark, then insert if absent (no blind append)."""
    d = F.col(date_col)
    if watermark is None:
        kept = batch.filter(d.isNotNull())
    else:
        wm = F.col("_wm")
        kept = batch.withColumn("_wm", watermark).filter(d.isNotNull() & (wm.isNull() | (d > wm))).drop("_wm")
    return insert_if_absent(target, kept, key, order)


def replace_upsert(target: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """K5: the last writer replaces the whole row of its key.

    Target rows rank before every batch row; inside the batch ``order``
    decides. ``max_by`` is an aggregation, so a hot key is pre-reduced on
    the map side.
    """
    rest = [c for c in target.columns if c != key]
    t = target.select(key, F.lit(0).alias("_src"), F.lit(None).cast(batch.schema[order].dataType).alias("_ord"),
                      F.struct(*rest).alias("_doc"))
    b = batch.select(key, F.lit(1).alias("_src"), F.col(order).alias("_ord"), F.struct(*rest).alias("_doc"))
    latest = t.unionByName(b).groupBy(key).agg(
        F.max_by("_doc", F.struct("_src", "_ord")).alias("_doc"))
    return latest.select(key, *[F.col("_doc")[c].alias(c) for c in rest])


def document_key(code: Column, text: Column) -> Column:
    """K5 key: the product code when present, else a stable hash of the document text."""
    return F.coalesce(F.nullif(code, F.lit("")), F.sha2(text, 256))


def max_date_watermark(df: DataFrame, key: str, date_col: str, source_col: str = "source_name",
                       value_col: str = "last_value") -> DataFrame:
    """Newest date per key as 'yyyy-MM-dd'; a missing date counts as 1900-01-01."""
    d = F.coalesce(F.col(date_col), F.lit(NO_WATERMARK_START).cast("date"))
    return df.groupBy(F.col(key).alias(source_col)).agg(
        F.date_format(F.max(d), "yyyy-MM-dd").alias(value_col))


def set_watermarks(current: DataFrame, updates: DataFrame, source_col: str = "source_name") -> DataFrame:
    """K6: upsert one row per source; the update replaces the stored value (even a lower one)."""
    return replace_upsert(current.withColumn("_seq", F.lit(0)), updates.withColumn("_seq", F.lit(1)),
                          source_col, "_seq").drop("_seq")


def watermark_value(watermarks: DataFrame, source: str, source_col: str = "source_name",
                    value_col: str = "last_value") -> Column:
    """K6 get: one source's value as a scalar subquery (null when absent)."""
    return watermarks.filter(F.col(source_col) == source).select(F.max(value_col)).scalar()


KEY_WATERMARK_PREFIX = "batch_"


def incremental_by_key(batch: DataFrame, watermarks: DataFrame, group: str, key: str,
                       wm_group: str = "source_name", wm_value: str = "last_value",
                       prefix: str = KEY_WATERMARK_PREFIX) -> DataFrame:
    """One watermark per group (named ``<prefix><group>`` in the watermark table); keep numeric ids
    above their group's; groups without one keep all.

    The watermark table has one row per name, so the join never fans out.
    """
    named = watermarks.filter(F.col(wm_group).startswith(prefix))
    wm = named.select(F.expr(f"substring({wm_group}, {len(prefix) + 1})").alias(group),
                      F.col(wm_value).try_cast("long").alias("_wm"))
    j = batch.join(wm, group, "left")
    n = numeric_id(key)
    return j.filter(n.isNotNull() & (F.col("_wm").isNull() | (n > F.col("_wm")))).drop("_wm")


def next_key_watermarks(loaded: DataFrame, group: str, key: str, prefix: str = KEY_WATERMARK_PREFIX) -> DataFrame:
    """K10 update: each group's watermark (``<prefix><group>``) moves to its largest loaded id."""
    return loaded.groupBy(F.concat(F.lit(prefix), F.col(group)).alias("source_name")).agg(
        F.max(numeric_id(key)).cast("string").alias("last_value"))


def append_manifest(existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[str] | str) -> DataFrame:
    """Add keys not yet in the manifest, only the first of repeats in the batch."""
    return insert_if_absent(existing, incoming, key, order)
