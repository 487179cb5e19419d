"""The quality classifier's prior against a plain count over all texts; bounded training rows; hand-computed risk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality
from kestrel.llm import textvec as tv
from kestrel.llm.queries import held_out, trusted_positives
from kestrel.sources.tables import read_table

from ..conftest import SF001


def matrix(texts) -> np.ndarray:
    return np.vstack([quality.features(data, off) for _, _, data, off in tv.chunks(pa.array(texts, pa.string()))])


def folded(df):
    return df.select("text", F.pmod(F.xxhash64("text"), F.lit(quality.FOLDS)).cast("int").alias("fold"))


def test_counts_cover_every_text(spark):
    docs = folded(read_table(spark, SF001, "documents").where("text is not null"))
    rng = np.random.default_rng(3)
    models = [(rng.normal(size=quality.FEATURES), 0.1), (rng.normal(size=quality.FEATURES), -0.2)]
    rows = docs.collect()
    f = matrix([r["text"] for r in rows]).astype(np.float16).astype(np.float32)
    z = np.array([f[i] @ models[r["fold"]][0] + models[r["fold"]][1] for i, r in enumerate(rows)])
    cuts = np.quantile(z, [0.1, 0.5, 0.9]) + 1e-9
    above, total = quality._scores_above(docs.repartition(5), models, cuts)
    assert total == len(rows) and above.tolist() == [int((z >= c).sum()) for c in cuts]


def test_prior_of_scores():
    # 60 % of the unlabelled scores are drawn as the positives', the rest lie below all of them
    positive = np.linspace(1, 2, 1000)
    unlabelled = np.concatenate((np.linspace(1, 2, 600), np.linspace(-2, -1, 400)))
    assert abs(quality.estimate_prior(positive, unlabelled) - 0.6) < 0.01
    cuts = quality.prior_cuts(positive)
    above = np.array([(unlabelled >= c).sum() for c in cuts])
    assert quality.prior_of_counts(positive, cuts, above, 1000) == quality.estimate_prior(positive, unlabelled)
    assert quality.prior_of_counts(positive, cuts, above * 10**9, 1000 * 10**9) == quality.estimate_prior(positive, unlabelled)


def test_prior_follows_all_texts_not_the_sample(spark):
    rng = np.random.default_rng(11)
    words = ["red", "house", "stands", "near", "old", "river", "people", "like", "small", "garden"]
    good = [(i, "The " + " ".join(rng.choice(words, 12)) + ".") for i in range(120)] + [(200 + i, "The red house stands near the river.") for i in range(40)]
    junk = [(1000 + i, "$$$ || " + " | ".join(rng.choice(words, 9)) + f" BUY!! {i}") for i in range(480)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    known = spark.createDataFrame([(i,) for i in [*range(0, 120, 2), *range(200, 240, 2)]], "doc_id long")
    whole = quality.train(docs, known)
    small = quality.train(docs, known, train_rows=40)
    assert abs(whole.prior - 0.25) < 0.08 and abs(small.prior - 0.25) < 0.1


def test_one_id_or_text_on_many_rows_stays_within_the_bound(spark):
    many = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id") % 50).alias("text"))
    docs = many.unionByName(spark.createDataFrame([(i, f"other {i}") for i in range(100, 130)] + [(None, None), (8, "")], "doc_id long, text string"))
    src = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("fold"))
    for bound, want in ((10, 10), (1000, 50 + 30 + 2)):
        rows, folds = quality._feature_rows(quality._some(src, bound, 1))
        assert len(rows) == len(folds) == want
    again = quality._feature_rows(quality._some(src.repartition(7), 10, 1))[0]
    assert (quality._feature_rows(quality._some(src, 10, 1))[0] == again).all()
    assert quality.train(docs, spark.createDataFrame([(7,), (7,), (None,)], "doc_id long"), train_rows=10).weights.shape == (quality.FEATURES,)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "Plain words of a text." if i % 2 else "!! $$ ||", 1, 2, 3, 0.5) for i in range(40)],
                                 "doc_id long, text string, id int, fold int, key int, _score double")
    known = spark.createDataFrame([(i,) for i in range(1, 40, 4)], "doc_id long")
    kept = quality.keep_quality(docs, known)
    assert kept.columns == docs.columns and kept.where("doc_id % 2 = 1").count() == 20
    assert quality.train(docs.limit(0), known).prior == 0.5 and quality.train(docs, known.limit(0)).prior == 0.5


def test_risk_gradient_is_the_risk_s(spark):
    """The fitted model's risk is no worse than that of random changes of it, by the formula written out."""
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(1, 1, (80, 3)), rng.normal(-1, 1, (80, 3))
    unl = np.vstack((rng.normal(1, 1, (40, 3)), neg[:40]))
    model = quality.fit_pu(pos, unl, steps=2000, prior=0.5)
    loss = lambda z: np.log1p(np.exp(-z))

    def risk(w, b):
        g, u = pos @ w + b, unl @ w + b
        return 0.5 * loss(g).mean() + max(0.0, loss(-u).mean() - 0.5 * loss(-g).mean())

    best = risk(model.weights, model.offset)
    tries = [risk(model.weights + d[:3], model.offset + d[3]) for d in rng.normal(0, 0.3, (200, 4))]
    assert best <= min(tries) + 5e-3


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_accuracy(spark, sf):
    sf_dir = SF001.replace("sf0.001", sf)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    scored = quality.score(docs, quality.train(docs, trusted_positives(spark, sf_dir)))
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"]).where("quality is not null")
    rows = scored.where(held_out("doc_id")).join(labels, "doc_id").select((F.col("score") >= quality.KEEP_SCORE).cast("int").alias("p"), "quality").collect()
    assert np.mean([r["p"] == r["quality"] for r in rows]) >= 0.92
