"""A training corpus from raw documents: quality, near dedup, substring dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm import bagminhash, decontaminate, mixing, quality, substring
from kestrel.llm.common import fresh, staged, text_of
from kestrel.llm.queries import trusted_positives
from kestrel.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (6).

    Null and empty texts get an empty text's score; repeated rows share their
    fate; null ids are judged like others but are never positives; without
    positives all go; an empty table stays empty.
    """
    return quality.keep_quality(docs, trusted_positives(spark, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5): the one with the smallest id.

    Null ids come last; among texts of one id the smallest digest decides, and
    of rows equal in id and text one stays. Null texts count as empty ones. An
    empty table stays empty.
    """
    c = [fresh(docs, n) for n in ("_d1", "_d2", "_id", "_n")]
    d1, d2, key, n = c
    rows = bagminhash.near_duplicates(docs)
    kept = (rows.groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "d1", "d2")).alias("k"))
            .select(F.col("k.id").alias("id"), "k.d1", "k.d2"))
    text = text_of("text")
    mine = docs.withColumns({d1: F.xxhash64(text), d2: F.xxhash64(F.lit(1), text), key: F.col("doc_id").cast("long")})
    joined = mine.join(kept, (mine[d1] == kept["d1"]) & (mine[d2] == kept["d2"]) & mine[key].eqNullSafe(kept["id"]), "left_semi")
    # rows equal in id and text: the shuffle of the join serves this window too
    first = joined.withColumn(n, F.row_number().over(Window.partitionBy(d1, d2, key).orderBy(key)))
    return first.where(F.col(n) == 1).select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds (4); ``n_chars`` follows the text.

    No row is dropped: null texts stay null, a text that an earlier row repeats
    in full may become short or empty, of equal rows one counts as the earlier.
    An empty table stays empty.
    """
    out = substring.dedup_substrings(docs)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (3).

    Null and empty texts hold none and stay; every copy of a leaking row goes;
    an empty table stays empty, an empty benchmark drops nothing.
    """
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix (2): a row per copy taken, in the shuffled order of every shard.

    Adds ``shard``, ``position_key``, ``take_words`` (lengthened by ``_`` where the documents have such a column). The text of the document
    where a source's target ends is cut after its last word taken; ``n_chars``
    follows the text.
    """
    mixed = mixing.mixed_documents(docs)
    shard, position, take = (fresh(docs, c) for c in ("shard", "position_key", "take_words"))
    # every piece is a word with the blanks before it
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.col(take) < mixing.words("text")
    out = {"text": F.when(part, F.array_join(F.slice(pieces, F.lit(1), F.col(take).cast("int")), "")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(part, F.length(out["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return mixed.withColumns(out).orderBy(shard, position)


STAGES = [
    ("quality classifier", quality_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

# the learned and hashed stages have no SQL form; tests/llm/test_pipeline_stages.py and test_mixing_stage.py hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
