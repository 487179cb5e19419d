"""Blocks of the mix where one id or one text stands on many rows; every draw's shard against the quotas of the splitting tree."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm import mixing


def hot(spark):
    one_id = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text"), F.lit("a").alias("source"))
    one_row = spark.range(2500).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the very same text").alias("text"), F.lit("b").alias("source"))
    rest = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 > 0, F.repeat(F.lit("w "), (F.col("id") % 40).cast("int"))).alias("text"),
                                    F.when(F.col("id") % 3 > 0, "c").alias("source"))
    return one_id.unionByName(one_row).unionByName(rest)


@pytest.mark.parametrize("piece", [1000, 64])
def test_no_id_or_text_fills_a_block(spark, monkeypatch, piece):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", piece)
    rows = mixing.mix(hot(spark).repartition(3)).collect()
    assert len(rows) == 6500
    filled = Counter((r["source"], r["block"]) for r in rows)
    assert max(filled.values()) < 2 * mixing.BLOCK_DOCS
    assert {s: len({b for t, b in filled if t == s}) for s in ("a", "b")} == {"a": 47, "b": 40}
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(taken[s] == round(t) for s, t in target.items())


def test_shards_are_the_splitting_tree_s(spark):
    docs = hot(spark)
    rows = mixing.mix(docs, block_docs=20, levels=3).collect()
    blocks = {s: math.ceil(n / 20) for s, n in Counter(r["source"] for r in rows).items()}
    at = defaultdict(set)      # (source, draw number) -> shards of its rows
    for r in rows:
        for e, shard in enumerate(r["shards"]):
            at[r["source"], e * blocks[r["source"]] + r["block"]].add(shard)
    assert all(len(v) == 1 for v in at.values())
    draws = {s: max(d for t, d in at if t == s) + 1 for s in blocks}
    quotas = mixing.split_quotas(spark.createDataFrame(list(draws.items()), "source string, draws long"), levels=3).collect()
    want = {}
    for s in draws:
        ordered = sorted((q["shard"], q["draws"]) for q in quotas if q["source"] == s)
        want.update({(s, d): shard for d, shard in enumerate(x for x, n in ordered for _ in range(n))})
    assert {k: v.pop() for k, v in at.items()}.items() <= want.items()
    assert set(want.values()) == set(range(8))


def test_few_rows_in_few_filled_blocks_stay_within_the_shards(spark):
    """Blocks without a row are drawn too, so no copy falls behind the last shard."""
    for n in (1, 2, 3, 70, 130):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"), (F.col("id") % 2).cast("string").alias("source"))
        rows = mixing.mix(docs, block_docs=1).collect()
        assert len(rows) == n and {s for r in rows for s in r["shards"]} <= set(range(16))


def test_whole_rows_come_back(spark):
    docs = hot(spark).where("source = 'b' or doc_id % 50 = 7").withColumn("tie", F.lit(1))
    out = mixing.mixed_documents(docs)
    takes = mixing.mix(docs).agg(F.sum("taken"), F.sum(F.size("shards"))).first()
    assert out.columns == [*docs.columns, "shard", "position_key", "take_words"]
    assert tuple(out.agg(F.sum("take_words"), F.count(F.lit(1))).first()) == tuple(takes)
