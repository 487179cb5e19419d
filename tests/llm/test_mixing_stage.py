"""The pipeline's mixing stage applies the mix."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from kestrel.llm import mixing


def test_mixing_stage_applies_the_mix(spark):
    rows = [(i, None if i == 7 else " \t%s" % "  ".join("w%dx%d" % (i, k) for k in range(3 + i % 11)) + "\n", "abc"[i * i % 3], -1) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int").repartition(3)
    takes = {r["id"]: r for r in mixing.mix(docs).collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    text, copies, got = {i: t for i, t, _, _ in rows}, Counter(), Counter()
    for r in out:
        i, words = r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        copies[i, r["shard"]] += 1
        got[i] += len(words)
        assert len(words) == r["take_words"] and text[i].startswith(r["text"])
        assert r["text"] == text[i] or (r["n_chars"] == len(r["text"]) and r["text"].endswith(words[-1]))
    assert copies == Counter((i, s) for i, r in takes.items() for s in r["shards"])
    assert got == Counter({i: r["taken"] for i, r in takes.items() if r["taken"]})
    assert any(r["text"] != text[r["doc_id"]] for r in out) and len(out) != len(rows)
    order = [(r["shard"], r["position_key"]) for r in out]
    assert order == sorted(order)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0
