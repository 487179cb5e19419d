"""LM scoring knows the words past the most frequent ones."""

from __future__ import annotations

import numpy as np
import pytest

from kestrel.llm import lm_score


def test_rare_topical_words_change_the_score(spark):
    rng = np.random.default_rng(3)
    fill = ["w%dq" % i for i in range(2200)]  # more frequent than the topics' words, all of one shape
    rows = [(i, " ".join(rng.permutation(fill))) for i in range(12)]
    topic = {c: ["%s%dq" % (c, i) for i in range(40)] for c in ("gene", "loan")}
    for j, c in enumerate(topic):
        rows += [(100 + 10 * j + k, " ".join(topic[c])) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.train(docs, docs.where("doc_id between 100 and 105"))
    got = {r["id"]: r for r in lm_score.score_documents(docs, model).collect()}
    assert len(got) == len(rows) and got[100]["score"] < 0 < got[110]["score"]
    assert got[100]["n_tokens"] == got[110]["n_tokens"] == 41
    # pairs and words that training hasn't seen
    other = spark.createDataFrame([(1, "gene0q loan0q never"), (2, None)], "doc_id long, text string")
    new = {r["id"]: r for r in lm_score.score_documents(other, model).collect()}
    p = lambda n: -np.log((n + lm_score.ADD) / (model.nb + lm_score.ADD * model.types))
    first = -np.log(lm_score.WEIGHT * 6 / len(rows) + (1 - lm_score.WEIGHT) * np.exp(-p(6)))
    assert new[1]["n_tokens"] == 4 and new[1]["background_loss"] == pytest.approx((first + p(6) + p(0) + p(len(rows))) / 4)
    assert new[2]["n_tokens"] == 1
