"""Document fingerprints (9): bottom-k sketches of shingle hashes, DataFrame functions only.

The sketch of a text is the ``K`` smallest distinct 48-bit hashes of its
five-word shingles. Sketches of parts merge into the sketch of the whole; two
sketches estimate resemblance and containment, one the number of distinct
shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, text_of

K = 128
SHINGLE_WORDS = 5
HASH_BITS = 48


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = K, width: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` plus ``out``: ascending array of at most ``k`` hashes.

    Words are separated by ASCII white space. A text of fewer than ``width``
    words has one shingle of all its words, one without words (null, empty) an
    empty sketch. Equal texts have equal sketches.
    """
    hw, sh = fresh(df, "_words"), fresh(df, "_shingles")
    words = F.array_remove(F.split(text_of(text_col), r"[\x20\x09-\x0D]+"), "")
    df = df.withColumn(hw, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(hw)
    one = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(F.col(hw), i + j) for j in range(width)]), 64 - HASH_BITS)
    last = F.greatest(n - width, F.lit(0))
    df = df.withColumn(sh, F.when(n > 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<bigint>")))
    return df.withColumn(out, F.slice(F.array_distinct(F.sort_array(sh)), 1, k)).drop(hw, sh)


def merge(df: DataFrame, key: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """Sketch of the union of all sketches of a key: ``key..., sketch_col``.

    Hashes are made distinct per key and the ``k`` smallest kept by rank (each
    map task keeps ``k`` of a key before the shuffle), so a hot key sends little.
    """
    h = fresh(df, "_hash")
    rows = df.select(*key, F.explode(sketch_col).alias(h)).distinct()
    rank = fresh(rows, "_rank")
    low = rows.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(h))).where(F.col(rank) <= k)
    return low.groupBy(*key).agg(F.sort_array(F.collect_list(h)).alias(sketch_col))


def resemblance(a: str, b: str, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sketch columns; two empty ones are equal, one empty one is unlike all others."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.array_intersect(F.array_intersect(union, F.col(a)), F.col(b))
    return F.when(F.size(F.col(a)) + F.size(F.col(b)) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(union))


def distinct_shingles(a: str | Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    a = F.col(a) if isinstance(a, str) else a
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(1 << HASH_BITS)) / (F.element_at(a, -1) + 1))


def containment(a: str, b: str, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has, from the resemblance and the counts (0 for an empty ``a``)."""
    r, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(F.col(a)) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), r * (na + nb) / (1 + r) / na))


def as_text(a: str) -> Column:
    """A sketch as one string of 12 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), HASH_BITS // 4, "0"))), "")


def _buckets(df: DataFrame, id_name: str, buckets: int) -> tuple[Column, Column, Column, int]:
    """Descending id ranges: (bucket of an id, whether it is its bucket's first id, the bucket before, last bucket).

    Only ``buckets`` quantiles and first ids reach the driver.
    """
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    bounds = df.agg(F.percentile_approx(id_name, shares, 10_000)).first()[0] or []
    bounds = sorted(set(bounds), reverse=True)
    steps = [1 << j for j in reversed(range(max(1, len(bounds).bit_length())))]
    table = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    # binary search: how many bounds are above the id; null ids come last
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) > F.col(id_name)), at + s).otherwise(at))
    bucket = F.when(F.col(id_name).isNull(), F.lit(len(bounds))).otherwise(found)
    heads = {r["b"]: r["h"] for r in df.groupBy(bucket.alias("b")).agg(F.max(id_name).alias("h")).collect()}
    used = sorted(heads)
    before = {b: used[i - 1] for i, b in enumerate(used)}  # the first bucket's is the last: the order is a ring
    size = len(bounds) + 1
    head = F.get(F.array(*[F.lit(heads.get(b)).cast("long") for b in range(size)]), bucket)
    prev = F.get(F.array(*[F.lit(before.get(b, -1)) for b in range(size)]), bucket)
    return bucket, F.col(id_name).eqNullSafe(head), prev, size


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> tuple[DataFrame, object]:
    """``id, text, tie, bucket, guest, next`` and the window that orders a bucket.

    ``next`` is the text of the next document by descending id (nulls last,
    equal ids by a hash of the text); after the last comes the first. Documents
    are dealt by id range into ``buckets`` parts of about equal size, so no task
    sorts more than one range; the first document of a range is also sent to the
    range before it as a guest. A single document is its own next one.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket, is_head, prev, _ = _buckets(src.select("id"), "id", buckets)
    native = F.struct(bucket.alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(prev.alias("bucket"), F.lit(1).alias("guest"))
    placed = (src.withColumn("tie", F.xxhash64("text"))
              .withColumn("at", F.explode(F.when(is_head, F.array(native, guest)).otherwise(F.array(native))))
              .select("id", "text", "tie", "at.bucket", "at.guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("id"), "tie")
    return placed.withColumn("next", F.lead("text").over(order)), order


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Sketches of every text and of its edited text, and their likeness.

    ``id, n_chars, edited_sha256, sketch, edited_sketch, near_edited,
    near_next``. The edited text has the last ``floor(n_chars / 2)`` code points
    replaced by the first as many (or all) of the next document, see
    ``with_next``. Null texts are empty; repeated rows and null ids keep a row
    each; an empty table gives an empty result.
    """
    df, order = with_next(docs, id_col, text_col)
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    df = df.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))"),
                                          F.expr("substring(coalesce(next, ''), 1, cast(n_chars div 2 as int))"))).drop("next")
    df = df.withColumn("edited_sha256", F.sha2("edited", 256))
    df = with_sketch(df, "text", "sketch", k).drop("text")
    df = with_sketch(df, "edited", "edited_sketch", k).drop("edited")
    df = df.withColumn("next_sketch", F.lead("sketch").over(order)).where("guest = 0")
    return df.select("id", "n_chars", "edited_sha256", "sketch", "edited_sketch",
                     resemblance("sketch", "edited_sketch", k).alias("near_edited"), resemblance("sketch", "next_sketch", k).alias("near_next"))
