"""Order-dependent row selection (W1-W3), written to survive hot keys.

A key may hold a third of all rows, so nothing here sorts a whole key group
inside one task:

* ``first_per_key`` is an aggregation (``min_by``), so each map task reduces
  its share of a hot key to one row before the shuffle.
* ``first_n_per_group`` relies on Spark's partial window group limit (at
  most n rows per group leave each map task), salting beyond its threshold.
* ``previous_in_key`` (lag) cuts each key into order ranges, takes the lag
  inside each range, and patches the first row of a range from the last row
  of the range before it (a small per-range summary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """Keep the first row of every key by ``order`` (a null key is one group).

    Ties on ``order`` are broken by the remaining columns, so the result does
    not depend on the input partitioning. Column order is preserved.
    """
    keys, order_cols = _cols(key), _cols(order)
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) for c in order_cols + [r for r in rest if r not in order_cols]])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), by).alias("_first"))
    return picked.select(*[F.col(c) for c in keys], *[F.col("_first")[c].alias(c) for c in rest]).select(*df.columns)


WINDOW_GROUP_LIMIT_MAX = 1000   # Spark's default spark.sql.optimizer.windowGroupLimitThreshold


def first_n_per_group(df: DataFrame, group: Sequence[str] | str, order: Sequence[str] | str, n: int,
                      salt_buckets: int = 16, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, ties by the remaining columns.

    The order is total but for rows equal in every column, so the same rows
    are kept under any partitioning and by either plan below.

    For ``n`` within Spark's window group-limit threshold this is the plain
    ``row_number() <= n`` filter: Catalyst plans a *partial* WindowGroupLimit
    before the shuffle, so each map task sends at most ``n`` rows of a hot
    group. Beyond the threshold the same bound comes from salting: rank inside
    (group, salt) buckets first, then rank the at most n * salt_buckets
    survivors of each group.
    """
    groups, order_cols = _cols(group), _cols(order)
    order_cols += [c for c in df.columns if c not in order_cols and c not in groups]
    cols = [F.col(c) for c in df.columns]
    if n <= min(WINDOW_GROUP_LIMIT_MAX, int(df.sparkSession.conf.get(
            "spark.sql.optimizer.windowGroupLimitThreshold", str(WINDOW_GROUP_LIMIT_MAX)))):
        w = Window.partitionBy(*groups).orderBy(*order_cols)
        out = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)
    else:
        salt = F.abs(F.xxhash64(*[F.col(c) for c in df.columns])) % salt_buckets
        w1 = Window.partitionBy(*groups, "_salt").orderBy(*order_cols)
        stage1 = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n)
        w2 = Window.partitionBy(*groups).orderBy(*order_cols)
        out = stage1.withColumn("_rank", F.row_number().over(w2)).filter(F.col("_rank") <= n)
    if rank_col:
        cols.append(F.col("_rank").cast("long").alias(rank_col))
    return out.select(*cols)


def previous_in_key(df: DataFrame, key: str, order: str, value: str, out: str,
                    has_prev_out: str, bucket_width: int = 1 << 20) -> DataFrame:
    """Value of the previous row (by ``order``) of the same key.

    ``order`` must be a unique, integral sequence (file offset, event id).
    Rows are cut into ranges of ``bucket_width`` sequence numbers per key; the
    window runs per (key, range), and the first row of each range takes the
    last value of the nearest earlier range. ``has_prev_out`` tells a first
    row (no previous) from a previous row whose value is null.
    """
    ranged = df.withColumn("_b", F.floor(F.col(order) / F.lit(bucket_width)))
    w = Window.partitionBy(key, "_b").orderBy(order)
    b = ranged.withColumn("_lag", F.lag(F.struct(F.col(value).alias("v"))).over(w))
    # last value of each (key, range), reduced map-side; then the range before, over that small summary
    last = ranged.groupBy(key, "_b").agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(order)).alias("_last"))
    wb = Window.partitionBy(key).orderBy("_b")
    carry = last.select(key, "_b", F.lag("_last").over(wb).alias("_carry"))
    j = b.join(carry, [key, "_b"], "left")
    prev = F.coalesce(F.col("_lag"), F.col("_carry"))
    return j.select(*[F.col(c) for c in df.columns],
                    prev["v"].alias(out), prev.isNotNull().alias(has_prev_out))


def attach_group_count(df: DataFrame, key: Sequence[str] | str, out: str) -> DataFrame:
    """Row count of each row's group, via a (partially aggregated) count and a join.

    Unlike ``count(*) over (partition by key)`` this never buffers a hot group
    in one task; the join side is one row per group.
    """
    keys = _cols(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, keys, "left")
