"""Scores by asked and answered counts equal those of the staged model, which other tests hold against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from kestrel.llm import lm_corpus, lm_score

RNG = np.random.default_rng(8)


def test_packing():
    for x in ([], [0], [5, 0, 255], [2 ** 64 - 1, 1], RNG.integers(0, 1 << 40, 1000)):
        x = np.array(x, dtype=np.uint64)
        assert (lm_corpus.unpack(lm_corpus.pack(x)) == x).all()
        keys = np.unique(x)
        assert (lm_corpus.unpack_keys(lm_corpus.pack_keys(keys)) == keys).all()


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 1 << 22])
def test_equals_the_staged_model(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(lm_corpus, "CHUNK_BYTES", chunk_bytes)
    words = ["w%d" % i for i in range(60)] + ["Ünlü", "漢字", "9th", "x.", ","]
    rows = [(i, " ".join(RNG.choice(words, RNG.integers(0, 40))), "a") for i in range(120)]
    rows += [(200 + i, f"once{i} only.{i} é{i}ñ " + rows[i][1], "b") for i in range(30)]          # words below MIN_COUNT
    rows += [(300, None, "c"), (301, "", "c"), (302, " \n", "c"), (None, "w1 w2 w3", "d"), (None, None, "d"), (5, "again w1", "e"), (7, rows[7][1], "e"), (7, rows[7][1], "e"),
             (303, "w1 " * 20_000, "f")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, source string, id string, chunk int, n_tokens int").repartition(3)
    target = spark.createDataFrame([(i,) for i in [*range(0, 240, 3), 5, 5, 303, 999]] + [(None,)], "doc_id long")
    model = lm_score.train(docs, docs.join(target.distinct(), "doc_id", "left_semi"))
    key = lambda r: (str(r["id"]), r["n_tokens"], round(r["score"], 9))
    want = sorted(lm_score.score_documents(docs, model).collect(), key=key)
    got = sorted(lm_corpus.score_corpus(docs, target).collect(), key=key)
    assert len(got) == len(rows)
    for g, w in zip(got, want):
        assert (g["id"], g["n_tokens"]) == (w["id"], w["n_tokens"])
        assert [g[c] for c in ("target_loss", "background_loss", "score")] == pytest.approx([w[c] for c in ("target_loss", "background_loss", "score")], abs=1e-9)


def test_empty_tables_and_no_target(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert lm_corpus.score_corpus(docs.limit(0), none).collect() == []
    got = {r["id"]: r for r in lm_corpus.score_corpus(docs, none).collect()}
    model = lm_score.train(docs, docs.limit(0))
    want = {r["id"]: r for r in lm_score.score_documents(docs, model).collect()}
    assert got[1]["target_loss"] == pytest.approx(want[1]["target_loss"]) and got[2]["n_tokens"] == 1
