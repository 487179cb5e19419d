"""Surrogate keys and bounded broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and read it from there.

    For intermediates consumed by several branches of one plan (a subquery
    and the main query), which Spark would otherwise recompute per branch.
    Reliable (survives executor loss), unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dense_key(df: DataFrame, order: Sequence[str] | str, name: str, partitions: int | None = None) -> DataFrame:
    """Dense 1..n key in ``order`` without a single-partition sort.

    Range-partition and sort by the natural key, number rows inside each
    partition, and add the running row count of the partitions before it (a
    table of one row per partition). Equals ``row_number() over (order by
    ...)`` when the order columns are unique, at any data size.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or spark.sparkContext.defaultParallelism
    # Range bounds come from sampling, so two evaluations of this frame could
    # cut partitions differently; a reliable checkpoint (shared storage,
    # survives executor loss) pins one partitioning for the sizes and the rows.
    ranged = materialize(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    keyed = ranged.join(F.broadcast(offsets), "_pid")
    return keyed.select(
        (F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1).cast("long").alias(name),
        *[F.col(c) for c in df.columns],
    )


def new_members(members: DataFrame, key_map: DataFrame, member: str, key: str, partitions: int | None = None) -> DataFrame:
    """Rows (``key``, ``member``) for the members that the key map doesn't hold, numbered on from its largest key.

    Members already in the map keep their key for good. The unseen ones are dealt by
    hash, numbered by name within each part, and offset by the parts before (a
    table of one row per part): any evaluation gives the same numbers, so
    nothing is checkpointed. Null members get no key.
    """
    n = partitions or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unseen = members.select(member).where(F.col(member).isNotNull()).distinct().join(key_map.select(member), member, "left_anti")
    dealt = unseen.withColumn("_part", F.pmod(F.xxhash64(member), F.lit(n)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))      # at most n rows
    largest = key_map.select(F.coalesce(F.max(key), F.lit(0).cast("long"))).scalar()
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(member)))
    return ranked.join(F.broadcast(offsets), "_part").select((largest + F.col("_off") + F.col("_rank")).cast("long").alias(key), member)


def small_lookup(df: DataFrame) -> DataFrame:
    """Broadcast a lookup table whose size is bounded by construction.

    Only for tables that cannot grow with the data (weights, synonyms,
    histogram bins, a vocabulary capped by a parameter, calendar tables).
    Data-sized sides are left to the planner: AQE turns a join into a
    broadcast at run time only when the measured side is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    return F.broadcast(df)
