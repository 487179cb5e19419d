"""Feature engineering at scale.

TF-IDF weights are computed inside each document's row: only per-term counts are
shuffled, and the vocabulary (capped at ``max_features`` terms, so bounded) goes
to every task. PCA of short vectors fits with Spark ML; PCA of
text multiplies the covariance with a narrow block of vectors, one aggregation
per step, so no d x d matrix exists anywhere. Projections are built-in array expressions.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import TFIDF_MAX_FEATURES, TFIDF_MIN_DF
from ..functions.numeric import rms_normalise
from .keys import materialize, small_lookup


def tfidf(tokens: DataFrame, doc: str | list[str], term: str, n_docs, max_features: int = TFIDF_MAX_FEATURES,
          min_df: int = TFIDF_MIN_DF) -> DataFrame:
    """M1: (doc, term, tfidf) for the vocabulary terms of each document.

    Vocabulary: terms in at least ``min_df`` documents, then the
    ``max_features`` most frequent by total count (ties by term).
    Weight = tf * (ln((1 + n) / (1 + df)) + 1), rows L2-normalised.
    ``doc`` names the column or columns that tell documents apart. A document
    is a row, so where ids may repeat or be null one of them is a row number.
    ``n_docs`` is a Column (scalar subquery) or number: all documents, also
    those left without vocabulary terms.
    """
    keys = [doc] if isinstance(doc, str) else doc
    # the explicit not-null filter makes both uses of ``tf`` (vocabulary, weights)
    # the same plan, so the token aggregation's exchange is computed once and reused
    tf = tokens.filter(F.col(term).isNotNull()).groupBy(*keys, term).agg(F.count(F.lit(1)).alias("tf"))
    stats = tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocab = stats.filter(F.col("df") >= min_df).orderBy(F.desc("total"), F.asc(term)).limit(max_features)
    return tfidf_weights(tf, vocab.select(term, "df"), keys, term, n_docs)


def tfidf_weights(tf: DataFrame, vocab: DataFrame, keys: list[str], term: str, n_docs) -> DataFrame:
    """Weights from (keys, term, tf) and a vocabulary (term, df) capped at max_features rows (broadcast)."""
    idf = F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1.0)
    weighted = tf.join(small_lookup(vocab), term).select(*keys, term, (F.col("tf") * idf).alias("w"))
    # a document has at most max_features vocabulary rows, so this window is bounded per task
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys)))
    return weighted.select(*keys, term, (F.col("w") / norm).alias("tfidf"))


def top_terms(weights: DataFrame, doc: str | list[str], term: str, weight: str, k: int | None = None) -> DataFrame:
    """Terms of each document ranked by weight (ties by term), the first ``k`` or all; groups are bounded by the vocabulary."""
    w = Window.partitionBy(*([doc] if isinstance(doc, str) else doc)).orderBy(F.desc(weight), F.asc(term))
    ranked = weights.withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def pca_2d(df: DataFrame, key: list[str], vec: str, k: int = 2, min_rows: int = 3) -> DataFrame:
    """M2: centred principal-component scores (pca_x, pca_y) of an array column.

    Missing vector elements count as 0. With fewer than ``min_rows`` rows the
    scores are null (no meaningful components). The fit runs in Spark ML
    (covariance by a distributed tree aggregate; the d x k loadings come back
    to the driver, d = vector length). Scores are built-in array expressions:
    (x - mean) . pc_j. Each component's sign is fixed so that its
    largest-magnitude loading is positive, which makes the output repeatable
    (the decomposition itself has no random seed).
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    names = ["pca_x", "pca_y"] + [f"pca_{j}" for j in range(2, k)]
    vectors = df.select(*key, F.transform(vec, lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("_a"))
    if vectors.limit(min_rows).count() < min_rows:      # reads at most min_rows rows
        return vectors.select(*key, *[F.lit(None).cast("double").alias(n) for n in names])
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors.select(array_to_vector("_a").alias("_v")))
    pc = model.pc.toArray()  # d x k, bounded by the vector length
    comps = []
    for j in range(k):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        comps.append([float(sign * c) for c in col])
    # (x - mean) . pc = x . pc - mean(x . pc): project first, then centre with one scalar subquery
    dots = [F.aggregate(F.zip_with("_a", F.array(*[F.lit(c) for c in comps[j]]), lambda x, c: x * c),
                        F.lit(0.0), lambda acc, x: acc + x).alias(f"_d{j}") for j in range(k)]
    proj = vectors.select(*key, *dots)
    means = proj.select(F.array(*[F.avg(f"_d{j}") for j in range(k)])).scalar()
    proj = proj.withColumn("_means", means)       # the subquery enters once, as a column
    return proj.select(*key, *[(F.col(f"_d{j}") - F.col("_means")[j]).alias(names[j]) for j in range(k)])


def mean_pool(frames: DataFrame, key: str, vec: str) -> DataFrame:
    """M3: element-wise mean of the frame vectors of each key, as rows (key, pos, mean_value, n_frames).

    posexplode -> groupBy(key, pos).avg: partial aggregation, so a key with
    many frames is pre-reduced on the map side.
    """
    ex = frames.select(key, F.posexplode(vec).alias("pos", "x"))
    pooled = ex.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean_value"),
                                       F.count(F.lit(1)).alias("n_frames"))
    return pooled.select(key, F.col("pos").cast("long").alias("pos"), "mean_value", "n_frames")


def pooled_vectors(pooled: DataFrame, key: str) -> DataFrame:
    """M3 as arrays: one fixed-length vector per key (length = vector dimension, bounded)."""
    agg = pooled.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "mean_value"))).alias("_s"))
    return agg.select(key, F.transform("_s", lambda s: s["mean_value"]).alias("pooled"))


def rms_rows(df: DataFrame, key: str, vec: str) -> DataFrame:
    """H15 as rows: (key, pos, value) of the RMS-normalised array."""
    return df.select(key, F.posexplode(rms_normalise(vec)).alias("pos", "value")) \
             .select(key, F.col("pos").cast("long").alias("pos"), "value")


def vocabulary(docs: DataFrame, tokens: str, max_features: int = TFIDF_MAX_FEATURES, min_df: int = TFIDF_MIN_DF) -> list[tuple[str, int]]:
    """(term, documents) of the terms in at least ``min_df`` documents, the ``max_features`` most frequent (ties by term).

    One shuffle, of per-term counts. Sorting a row's tokens marks every term's
    first occurrence, so that total and document counts come from the same rows.
    """
    ordered = F.array_sort(F.filter(tokens, lambda t: t.isNotNull()))
    # every token beside the one before it; the last pair has no token
    marked = F.zip_with(ordered, F.concat(F.array(F.lit(None).cast("string")), ordered),
                        lambda t, before: F.struct(t.alias("t"), (~t.eqNullSafe(before)).cast("int").alias("first")))
    rows = docs.select(F.inline(marked)).where("t IS NOT NULL")
    stats = rows.groupBy("t").agg(F.count(F.lit(1)).alias("total"), F.sum("first").alias("df")).where(F.col("df") >= min_df)
    return [(r["t"], r["df"]) for r in stats.orderBy(F.desc("total"), F.asc("t")).limit(max_features).collect()]


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if its scan has fewer splits than there are cores (small or single-row-group files)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _array(values, sql_type: str) -> Column:
    """A literal array (folded to a constant when the query is planned)."""
    return F.from_json(F.lit(json.dumps(values)), sql_type)


def tfidf_vectors(docs: DataFrame, tokens: str, vocab: list[tuple[str, int]], n_docs: int) -> DataFrame:
    """M1 in the row: adds ``idx`` (vocabulary numbers, ascending) and ``val`` (L2-normalised weights) to every document.

    Counts, idf and normalisation run row by row on sparse vectors; nothing is
    shuffled. Documents without vocabulary terms have empty arrays, null tokens count as none.
    """
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    from pyspark.sql.functions.builtin import unwrap_udt

    if not vocab:
        return docs.withColumns({"idx": F.array().cast("array<int>"), "val": F.array().cast("array<double>")})
    idf = [math.log((1 + n_docs) / (1 + df)) + 1 for _, df in vocab]
    safe = docs.withColumn("_tokens", F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda t: t.isNotNull()))
    counted = CountVectorizerModel.from_vocabulary([t for t, _ in vocab], inputCol="_tokens", outputCol="_counts").transform(safe)
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_weights").transform(counted)
    unit = Normalizer(p=2.0, inputCol="_weights", outputCol="_unit").transform(weighted)
    return unit.withColumn("_u", unwrap_udt(F.col("_unit"))).select(*docs.columns, F.col("_u.indices").alias("idx"), F.col("_u.values").alias("val"))


def ranked_terms(vectors: DataFrame, keep: list[str], vocab: list[tuple[str, int]]) -> DataFrame:
    """Rows (``keep``, rank, term, tfidf): each document's terms by weight (ties by term), ordered inside its row."""
    terms = _array([t for t, _ in vocab], "array<string>")
    pairs = F.transform(F.arrays_zip("idx", "val"), lambda x: F.struct((-x["val"]).alias("w"), F.element_at(terms, x["idx"] + 1).alias("term")))
    ranked = vectors.select(*keep, F.posexplode(F.array_sort(pairs)).alias("pos", "x"))
    return ranked.select(*keep, (F.col("pos") + 1).cast("long").alias("rank"), F.col("x.term").alias("term"), (-F.col("x.w")).alias("tfidf"))


def _gram_batches(batches, block: np.ndarray):
    """Partial sums of one task's rows: per coordinate the sum of x_i and of x_i * (x . block_j)."""
    d, b = block.shape
    s, g = np.zeros(d), np.zeros((d, b))
    for batch in batches:
        idx, val = (c.flatten().to_numpy(zero_copy_only=False) for c in (batch.column(0), batch.column(1)))
        sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        s += np.bincount(idx, weights=val, minlength=d)
        for j in range(b):
            y = np.bincount(owner, weights=val * block[idx, j], minlength=len(sizes))
            g[:, j] += np.bincount(idx, weights=val * y[owner], minlength=d)
    seen = np.flatnonzero((s != 0) | (g != 0).any(axis=1))
    columns = [pa.array(seen, pa.int32()), pa.array(s[seen]), *[pa.array(g[seen, j]) for j in range(b)]]
    yield pa.RecordBatch.from_arrays(columns, ["i", "s", *[f"g{j}" for j in range(b)]])


def gram_rows(vectors: DataFrame, block: np.ndarray) -> DataFrame:
    """Rows ``i, s, g``: per coordinate the sum of ``x_i`` and the array of sums of ``x_i * (x . block_j)`` over all sparse rows (``idx, val``).

    Linear algebra on Arrow batches: a task sums its rows into one d x b matrix, so
    the shuffle has at most d rows per task. Coordinates that are 0 in every row have no row.
    """
    names = [f"g{j}" for j in range(block.shape[1])]
    partial = vectors.select("idx", "val").mapInArrow(lambda it: _gram_batches(it, block), ", ".join(["i int, s double", *[f"{n} double" for n in names]]))
    sums = partial.groupBy("i").agg(F.sum("s").alias("s"), *[F.sum(n).alias(n) for n in names])
    return sums.select("i", "s", F.array(*names).alias("g"))


def covariance_times(vectors: DataFrame, block: np.ndarray, n: int) -> np.ndarray:
    """The sample covariance of the rows times ``block`` (d x b, both small); one distributed aggregation."""
    d, b = block.shape
    g, mean = np.zeros((d, b)), np.zeros(d)
    for r in gram_rows(vectors, block).collect():       # at most d rows of b numbers
        g[r["i"]], mean[r["i"]] = r["g"], r["s"] / n
    return (g - n * np.outer(mean, mean @ block)) / (n - 1)


def covariance_entries(df: DataFrame, vec: str, dim: int) -> DataFrame:
    """M2: rows (i, j, covariance) of the first ``dim`` elements of an array column, ``i <= j`` from 0; missing elements count as 0.

    The same aggregation that ``covariance_times`` runs, with the unit vectors as its block.
    """
    dense = df.select(F.sequence(F.lit(0), F.lit(dim - 1)).alias("idx"), F.transform(
        F.sequence(F.lit(1), F.lit(dim)), lambda i: F.coalesce(F.get(vec, i - 1).cast("double"), F.lit(0.0))).alias("val"))
    n = dense.select(F.count(F.lit(1))).scalar()
    # every pair of coordinates, as those that are 0 everywhere have no sums (dim rows and dim x dim entries)
    spark = df.sparkSession
    rows = spark.range(dim).withColumnRenamed("id", "i").join(gram_rows(dense, np.eye(dim)), "i", "left").select(
        "i", F.coalesce("s", F.lit(0.0)).alias("s"), F.coalesce("g", F.array_repeat(F.lit(0.0), dim)).alias("g"))
    sums = F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"])
    entries = rows.select("i", "s", F.posexplode("g").alias("j", "g")).where("i <= j").withColumns({"_s": rows.agg(sums).scalar(), "_n": n})
    covariance = (F.col("g") - F.col("s") * F.col("_s")[F.col("j")] / F.col("_n")) / F.nullif(F.col("_n") - 1, F.lit(0))
    return entries.select("i", F.col("j").cast("long").alias("j"), covariance.alias("covariance"))


def leading_components(times, d: int, k: int, block: int = 8, tol: float = 1e-10, max_steps: int = 60) -> np.ndarray:
    """The ``k`` leading eigenvectors (d x k) of a symmetric matrix known by its products ``times(V)`` with narrow blocks.

    Block power iteration that keeps all blocks seen as an orthonormal basis
    and takes the best vectors of their span (Rayleigh-Ritz), so it needs few
    products; it ends when ``times(v) = lambda v`` holds to ``tol`` or the basis is complete.
    """
    b = min(max(block, k), d)
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(d, b)))
    basis, images = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(max_steps):
        w = times(q)
        basis, images = np.hstack([basis, q]), np.hstack([images, w])
        t = basis.T @ images
        values, small = np.linalg.eigh((t + t.T) / 2)
        values, small = values[::-1][:k], small[:, ::-1][:, :k]
        vectors = basis @ small
        if basis.shape[1] >= d or np.abs(images @ small - vectors * values).max() <= tol * max(abs(values[0]), 1e-300):
            break
        rest = w - basis @ (basis.T @ w)
        rest -= basis @ (basis.T @ rest)
        q, r = np.linalg.qr(rest)
        keep = np.abs(np.diag(r)) > 1e-13 * max(np.abs(w).max(), 1e-300)
        q = q[:, keep][:, : d - basis.shape[1]]
        if not q.shape[1]:      # the span is invariant: its vectors are exact
            break
    return vectors


def tfidf_pca(tokens_by_doc: DataFrame, doc: str, tokens: str, k: int = 2,
              max_features: int = TFIDF_MAX_FEATURES, min_df: int = TFIDF_MIN_DF) -> DataFrame:
    """M2 on text: centred PCA scores of the L2-normalised TF-IDF vectors of documents.

    ``tokens_by_doc`` has one row per document with its token array (null counts
    as empty); every row gets its own scores, also where ids repeat or are null.
    The sparse vectors are written once to the shared folder; each step of the block
    power iteration reads them for one product of the (never built) covariance with
    a d x 8 block, whose d rows reach the driver. Scores are array expressions in the row,
    centred afterwards; each component's largest loading is made positive.
    Fewer than two documents or ``k`` terms have no components: null scores.
    """
    names = ["pca_x", "pca_y"] + [f"pca_{j}" for j in range(2, k)]
    tokens_by_doc = spread(tokens_by_doc)
    vocab = vocabulary(tokens_by_doc, tokens, max_features, min_df)
    n_docs = tokens_by_doc.count()
    if n_docs < 2 or len(vocab) < k:
        return tokens_by_doc.select(doc, *[F.lit(None).cast("double").alias(n) for n in names])
    vectors = materialize(tfidf_vectors(tokens_by_doc.select(doc, tokens), tokens, vocab, n_docs).select(doc, "idx", "val"))
    comps = leading_components(lambda block: covariance_times(vectors, block, n_docs), len(vocab), k)
    comps = comps * np.where(comps[np.abs(comps).argmax(axis=0), range(k)] >= 0, 1.0, -1.0)
    loadings = [_array(comps[:, j].tolist(), "array<double>") for j in range(k)]
    # documents without vocabulary terms are the zero vector: score 0 before centring
    dot = lambda c: F.aggregate(F.arrays_zip("idx", "val"), F.lit(0.0), lambda acc, x: acc + x["val"] * F.element_at(c, x["idx"] + 1))
    proj = vectors.select(doc, *[dot(c).alias(f"_d{j}") for j, c in enumerate(loadings)])
    means = proj.select(F.array(*[F.avg(f"_d{j}") for j in range(k)])).scalar()
    proj = proj.withColumn("_means", means)
    return proj.select(doc, *[(F.col(f"_d{j}") - F.col("_means")[j]).alias(names[j]) for j in range(k)])
