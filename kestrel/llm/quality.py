"""Quality classifier (6): positive-unlabelled learning with a non-negative risk.

A linear model on character-class bigrams and a few word statistics of the
whole text. Training sees trusted positives and unlabelled texts only; the
class prior is estimated from the scores of all texts; the non-negative unbiased
risk keeps the estimate of the negative part from going below zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import fresh, text_of

TRAIN_ROWS = 10_000   # bound of each training sample: positives and unlabelled texts (the prior comes from all texts)
FOLDS = 2             # the prior's scores come from models that didn't see the text
KEEP_SCORE = 0.7
STEPS = 300

# character classes: one row per class, its bytes; bytes of no row fall into the last class
CLASS_BYTES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\x0b\x0c\r",
    bytes(range(128, 256)), b".", b",", b"!", b"?", b"|", b"$", b"%", b"&", b"*", b"#", b"@", b"'\"`", b"()[]{}<>", b"-_/\\", b":;",
]
_CLASS = np.full(256, len(CLASS_BYTES), dtype=np.uint8)
for _i, _bytes in enumerate(CLASS_BYTES):
    _CLASS[list(_bytes)] = _i
CLASSES = len(CLASS_BYTES) + 1
WORD_FEATURES = 8
FEATURES = CLASSES * CLASSES + WORD_FEATURES


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature matrix of the documents of one chunk (rows of zeros for empty texts)."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(data):
        return out
    cls = _CLASS[data].astype(np.int64)
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    pair = cls[:-1] * CLASSES + cls[1:]
    same = doc[:-1] == doc[1:]
    counts = np.bincount((doc[:-1] * (CLASSES * CLASSES) + pair)[same], minlength=n * CLASSES * CLASSES)
    out[:, : CLASSES * CLASSES] = np.sqrt(counts.reshape(n, -1) / np.maximum(size - 1, 1)[:, None])
    owner, starts, ends = tv.word_spans(data, offsets)
    hashes = tv.span_hashes(data, starts, ends)
    words = np.maximum(np.bincount(owner, minlength=n), 1).astype(np.float64)

    def share(flag: np.ndarray, of: np.ndarray = owner) -> np.ndarray:
        return np.bincount(of, weights=flag, minlength=n) / words

    repeat = np.zeros(len(hashes))
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    distinct = np.ones(len(hashes))
    distinct[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    first, last = cls[starts], cls[ends - 1]
    upper = np.concatenate(([0], np.cumsum(cls == 1)))
    lower = np.concatenate(([0], np.cumsum(cls == 0)))
    shout = (upper[ends] - upper[starts] > 0) & (lower[ends] == lower[starts])
    w = CLASSES * CLASSES
    out[:, w] = share(repeat)
    out[:, w + 1] = share(distinct, owner[order]) * np.minimum(1, words / 50)
    out[:, w + 2] = share(np.minimum(ends - starts, 30)) / 10
    out[:, w + 3] = share(last > 7)             # ends in a symbol
    out[:, w + 4] = share(shout)
    out[:, w + 5] = share((first > 5) | (first == 2))
    out[:, w + 6] = np.log1p(size) / 10
    out[:, w + 7] = size > 0
    return out


@dataclass(frozen=True)
class PuModel:
    """Weights of the linear score, the offset, and the prior they were fitted with."""

    weights: np.ndarray
    offset: float
    prior: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def prior_cuts(positive: np.ndarray) -> np.ndarray:
    """Ascending score cuts; the region above each holds at least 30 % of the positives (a little below, so that equal texts' scores fall on one side)."""
    return np.quantile(positive, np.linspace(0.0, 0.7, 141)) - 1e-6


def prior_of_counts(positive: np.ndarray, cuts: np.ndarray, above: np.ndarray, total: int) -> float:
    """Class prior from scores of a positive-against-unlabelled classifier.

    For any region A of scores, P(A | unlabelled) >= prior * P(A | positive), so
    the least ratio over the regions bounds the prior; it is tight where a
    region holds no negatives. ``above`` counts, of the ``total`` unlabelled
    texts, those that score at least each cut. Regions hold at least 30 % of the
    positives, so that the ratio is not one of two small counts.
    """
    p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    return float(np.clip((above / max(total, 1) / np.maximum(p, 1e-9)).min(), 0.02, 0.98))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """``prior_of_counts`` of two arrays of scores."""
    cuts = prior_cuts(positive)
    return prior_of_counts(positive, cuts, len(unlabelled) - np.searchsorted(np.sort(unlabelled), cuts, side="left"), len(unlabelled))


def _descend(x: np.ndarray, gradient, steps: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on weights and offset; deterministic."""
    theta = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        slope = gradient(x @ theta[:-1] + theta[-1])
        g = np.append(x.T @ slope, slope.sum())
        g[:-1] += 1e-5 * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _standard(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.vstack((positive, unlabelled)).astype(np.float64)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 0.02
    return (x - mean) / spread, mean, spread


def fit_separator(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS // 3) -> tuple[np.ndarray, float]:
    """Weights and offset of a plain classifier of positives against unlabelled rows (zeros if either is missing)."""
    if not len(positive) or not len(unlabelled):
        return np.zeros(FEATURES), 0.0
    x, mean, spread = _standard(positive, unlabelled)
    np_, nu = len(positive), len(unlabelled)
    y = np.concatenate((np.ones(np_), np.zeros(nu)))
    weight = np.concatenate((np.full(np_, 0.5 / np_), np.full(nu, 0.5 / nu)))
    w, b = _descend(x, lambda z: weight * (_sigmoid(z) - y), steps)
    return w / spread, float(b - (w * mean / spread).sum())


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS, prior: float | None = None) -> PuModel:
    """Fit by the non-negative PU risk ``prior E+[l(g)] + max(0, E_u[l(-g)] - prior E+[l(-g)])``.

    ``l`` is the logistic loss. When the second part falls below zero its
    gradient is reversed, which undoes the overfitting. With no positives or no
    unlabelled rows the model scores 0.5 everywhere. Without a ``prior`` it is
    estimated from the given rows.
    """
    d = positive.shape[1] if positive.ndim == 2 else FEATURES
    if not len(positive) or not len(unlabelled):
        return PuModel(np.zeros(d), 0.0, 0.5)
    if prior is None:
        w, b = fit_separator(positive, unlabelled, steps // 3)
        prior = estimate_prior(positive @ w + b, unlabelled @ w + b)
    x, mean, spread = _standard(positive, unlabelled)
    np_, nu = len(positive), len(unlabelled)

    def gradient(z: np.ndarray) -> np.ndarray:
        s = _sigmoid(z)
        plus, minus = z[:np_], z[np_:]
        rest = np.logaddexp(0, minus).mean() - prior * np.logaddexp(0, plus).mean()
        part = np.concatenate((-prior * s[:np_] / np_, s[np_:] / nu))
        slope = np.concatenate((prior * (s[:np_] - 1) / np_, np.zeros(nu)))
        return slope + part if rest >= 0 else -part

    w, b = _descend(x, gradient, steps)
    return PuModel(w / spread, float(b - (w * mean / spread).sum()), prior)


def _feature_rows(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and folds, on the driver, of one row per key of a frame ``key, fold, text`` with boundedly many keys (16-bit floats on the way)."""

    def run(batches):
        for batch in batches:
            rows = [f.astype(np.float16).tobytes() for _, _, data, off in tv.chunks(batch.column("text")) for f in features(data, off)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("fold"), pa.array(rows, pa.binary())], names=["key", "fold", "f"])

    # rows of one key are equal, so any of them will do; each map task sends one per key
    one = df.select("key", "fold", "text").mapInArrow(run, "key long, fold int, f binary").groupBy("key", "fold").agg(F.min("f").alias("f"))
    got = one.orderBy("key").toArrow()
    if not len(got):
        return np.zeros((0, FEATURES), dtype=np.float32), np.zeros(0, dtype=np.int64)
    rows = np.vstack([np.frombuffer(r.as_buffer(), dtype=np.float16) for r in got.column("f")]).astype(np.float32)
    return rows, got.column("fold").to_numpy().astype(np.int64)


def _some(rows: DataFrame, n: int, seed: int, among: DataFrame | None = None) -> DataFrame:
    """Rows of at most ``n`` (id, text) pairs, those with the smallest hashes: the same on every run.

    ``among`` limits the choice to its ids. Only ids and hashes are shuffled;
    the texts of the chosen rows meet a broadcast of ``n`` hashes.
    """
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), "id", "text"))
    keys = keyed.select("id", "key")
    if among is not None:
        keys = keys.join(among, "id", "left_semi")
    return keyed.join(F.broadcast(keys.select("key").distinct().orderBy("key").limit(n)), "key", "left_semi")


def _scores_above(texts: DataFrame, models: list[tuple[np.ndarray, float]], cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of all texts (``fold, text``) score at least each cut by their fold's model, and how many there are."""
    shared = texts.sparkSession.sparkContext.broadcast((models, cuts))

    def run(batches):
        models, cuts = shared.value
        seen = np.zeros(len(cuts) + 1, dtype=np.int64)
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            for a, b, data, off in tv.chunks(batch.column("text")):
                f = features(data, off).astype(np.float16).astype(np.float32)  # as the sample that the cuts come from
                z = np.column_stack([f @ w + c for w, c in models])[np.arange(b - a), folds[a:b]]
                seen += np.bincount(np.searchsorted(cuts, z, side="right"), minlength=len(cuts) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], names=["bin", "n"])

    counts = np.zeros(len(cuts) + 1, dtype=np.int64)
    for row in texts.select("fold", "text").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row["bin"]] = row["n"]
    return counts[::-1].cumsum()[::-1][1:], int(counts.sum())


def train(docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> PuModel:
    """Fit on at most ``train_rows`` trusted positives and as many unlabelled texts, with the class prior of all texts.

    ``positives`` has one column, the ids of trusted positives. Samples are of
    distinct (id, text) pairs, so neither repeated rows nor an id on many rows
    can outgrow the bound. The prior is a statistic of the whole table: texts
    are dealt by hash into ``FOLDS``, each fold is scored by a classifier that
    was fitted on the others, and the scores of every row are counted on the
    executors (142 counts reach the driver). Null ids are unlabelled texts;
    without positives, or for an empty table, the model scores 0.5.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    src = src.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    ids = positives.select(F.col(positives.columns[0]).cast("long").alias("id")).where(F.col("id").isNotNull())
    good, good_fold = _feature_rows(_some(src, train_rows, 1, ids))
    other, other_fold = _feature_rows(_some(src, train_rows, 2))
    if not len(good) or not len(other):
        return fit_pu(good, other)
    apart = [(good_fold != k, other_fold != k) for k in range(FOLDS)]
    if not all(g.any() and o.any() for g, o in apart):  # too few texts to hold any out
        apart = [(good_fold >= 0, other_fold >= 0)] * FOLDS
    models = [fit_separator(good[g], other[o]) for g, o in apart]
    z = np.column_stack([good @ w + c for w, c in models])[np.arange(len(good)), good_fold]
    cuts = prior_cuts(z)
    return fit_pu(good, other, prior=prior_of_counts(z, cuts, *_scores_above(src, models, cuts)))


def score(docs: DataFrame, model: PuModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the score of every whole text (null and empty: the score of an empty text)."""
    linear = docs.sparkSession.sparkContext.broadcast((model.weights, model.offset))

    @F.pandas_udf("double")
    def scored(text):
        res = np.empty(len(text))
        for a, b, data, off in tv.chunks(pa.array(text, type=pa.large_string(), from_pandas=True)):
            res[a:b] = _sigmoid(features(data, off) @ linear.value[0] + linear.value[1])
        return pd.Series(res)

    return docs.withColumn(out, scored(F.col(text_col)))


def keep_quality(docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP_SCORE) -> DataFrame:
    """Rows of ``docs`` whose text scores at least ``keep`` (columns unchanged).

    Null and empty texts get the score of an empty text; repeated rows get equal
    scores; without positives every score is 0.5, so nothing passes; an empty
    table stays empty.
    """
    name = fresh(docs, "_score")
    model = train(docs, positives, id_col, text_col)
    return score(docs, model, text_col, name).where(F.col(name) >= keep).select(*docs.columns)
