"""Long runs of white space, clashing column names, case pairs of other scripts; native queries without Python in any staged plan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame

import corpus_pipeline
from kestrel.llm import decontaminate, token_counts
from kestrel.llm.queries import QUERIES

from ..conftest import SF001

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "MapInPandas", "MapInArrow", "PythonUDF", "CartesianProduct")


def test_long_runs_of_one_class():
    enc, piece = token_counts._encodings(token_counts.TOKENIZER)
    rng = random.Random(5)
    for _ in range(30):     # short enough for the pattern itself, long enough to be cut out
        text = "".join(rng.choice(["word ", "x", " é,", "7\n", "  ", "\t" * rng.randint(1000, 3000), " " * rng.randint(990, 2500), "　" * 1200, "\n \t" * 500])
                       for _ in range(rng.randint(1, 12)))
        assert token_counts.encode(text) == enc.encode_ordinary(text)
    for c, n in ((" ", 1_000_000), ("\n", 300_000), ("a", 1_000_000), ("7", 1_000_000), (".", 1_000_000)):
        assert len(token_counts.encode(c * n)) == len(piece.encode_ordinary(c * n))
    assert token_counts.encode(" " * 1_000_000 + "end") == piece.encode_ordinary(" " * 999_999) + enc.encode_ordinary(" end")


def test_token_counts_of_a_blank_text(spark):
    df = spark.createDataFrame([(1, " " * 1_000_000), (2, "a b"), (3, None), (4, "x" + "\n" * 50_000 + "y")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df).collect()}
    assert got == {i: len(token_counts.encode(t or "")) for i, t in df.collect()}


def test_mixing_stage_with_clashing_names(spark):
    clash = ["key", "shard", "shards", "take_words", "_taken", "_copy", "position_key", "_id", "_n", "_tid", "_size", "size", "block", "taken", "ID"]
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2], *range(len(clash))) for i in range(40)] + [(None, "n n", None, *range(len(clash)))] * 3 + [(5, None, "a", *range(len(clash)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in clash))
    plain = docs.select("doc_id", "text", "source")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert out.columns == [*docs.columns, "shard_", "position_key_", "take_words_"]
    pick = lambda df, s, p, t: [(r["doc_id"], r["text"], r["source"], r[s], r[p], r[t]) for r in df.collect()]
    assert sorted(pick(out, "shard_", "position_key_", "take_words_"), key=str) == sorted(
        pick(corpus_pipeline.STAGES[-1][1](spark, plain, ""), "shard", "position_key", "take_words"), key=str)
    assert {r["shard"] for r in out.collect()} == {1}       # the documents' own column stays


def test_benchmark_items_in_capitals_of_other_scripts(spark):
    items = {1: "ΤΟ ΠΛΟΙΟ ΤΗΣ ΓΡΑΜΜΗΣ ΦΕΥΓΕΙ ΝΩΡΙΣ ΚΑΘΕ ΜΕΡΑ ΑΠΟ ΤΟΥΣ ΠΑΛΙΟΥΣ ΛΙΜΕΝΕΣ ΤΗΣ ΠΟΛΗΣ", 2: "İSTANBUL BOĞAZI İLE HALİÇ ARASINDA KALAN YARIMADADA İLK KENT",
             3: "СТАРЫЙ МОСТ ЧЕРЕЗ РЕКУ СТОИТ НА ТОМ ЖЕ МЕСТЕ УЖЕ ТРИСТА ЛЕТ ПОДРЯД", 4: "Straßenbahnen fahren täglich außer sonntags über die große weiße Brücke"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before it {t} and after it") for i, t in items.items()] + [(i + 10, f"x {t.lower()} y") for i, t in items.items() if i in (3, 4)]
                                 + [(20, "nothing of the kind stands in this text at all")], "doc_id long, text string")
    found = {(r["id"], r["item_id"], r["edits"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert {(i, i, 0) for i in items} <= found and {(13, 3, 0), (14, 4, 0)} <= found and not any(i == 20 for i, *_ in found)


@pytest.mark.parametrize("name", ["op1_url_filter", "op2_mixing", "op9_fingerprints"])
def test_native_queries_run_no_python(spark, monkeypatch, name):
    """Every plan that is written on the way counts, not only the last."""
    from kestrel.llm import common

    plans, real = [], common.staged

    def watched(df: DataFrame, label: str) -> DataFrame:
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    from kestrel.llm import fingerprint, mixing, url_filter

    for module in (common, url_filter, mixing, fingerprint):
        if hasattr(module, "staged"):
            monkeypatch.setattr(module, "staged", watched)
    plans.append(QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString())
    assert not [op for op in PYTHON for plan in plans if op in plan]
