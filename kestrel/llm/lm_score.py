"""LM scoring (8): cross-entropy difference of two bigram models with one vocabulary.

The target model counts trusted documents, the background model all documents.
Both use the same vocabulary, every word that the whole corpus has at least
``MIN_COUNT`` times plus 16 classes for the rarer words by their shape, and the
same smoothing. A document's score is the mean over its tokens of (target loss -
background loss): below zero reads like the target.

Vocabulary, counts and losses are staged tables that grow with the corpus; they
are joined by word key and never gathered. Only words and pairs that make up at
least 1 / ``HOT_ROWS`` of all tokens, so at most ``HOT_ROWS`` rows, are
broadcast: what they serve needs no join and no key is hot in the joins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import staged, text_of

MIN_COUNT = 2        # rarer words are known by their shape only
SHAPES = 16
EDGE = 0             # token 0 opens and closes every document; tokens 1 to SHAPES are the shape classes
HOT_ROWS = 20_000
WEIGHT = 0.7         # weight of the bigram estimate against the unigram estimate
ADD = 0.5            # added to every unigram count


@dataclass(frozen=True)
class Model:
    """Staged tables: ``words`` (word, ub, ut) of the vocabulary, ``classes`` (token, ub, ut), ``mixed`` (c1, c2, b, t), ``losses`` (h1, h2, b, lt, lb)."""

    words: DataFrame
    classes: DataFrame
    mixed: DataFrame
    losses: DataFrame | None
    types: int
    nb: int
    nt: int

    @property
    def value(self) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary on the driver, for ``tokens``: to look into small models; scoring doesn't use it."""
        words = np.sort(self.words.select("word").toArrow().column("word").to_numpy().view(np.uint64))
        return words, np.arange(1, len(words) + 1, dtype=np.int64)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of every token: 60 bits of the word's hash and 4 of its shape, then the closing edge of each document."""
    doc, starts, ends = tv.word_spans(data, offsets)
    key = np.zeros(len(doc), dtype=np.uint64)
    if len(doc):
        first, last = data[starts], data[ends - 1]
        kind = lambda b: np.where((b >= 97) & (b <= 122), 0, np.where(b >= 128, 1, np.where((b == 46) | (b == 44), 2, 3)))
        h = tv.span_hashes(data, starts, ends) & ~np.uint64(15)
        key = np.where(h < 32, np.uint64(32), h) | (kind(first) * 4 + kind(last)).astype(np.uint64)
    n = len(offsets) - 1
    where = np.searchsorted(doc, np.arange(n), side="right")
    return np.insert(doc, where, np.arange(n)), np.insert(key, where, EDGE)


def tokens(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of every token by a vocabulary of word keys in memory: words by id or shape, edges 0."""
    doc, key = word_keys(data, offsets)
    token = np.where(key == EDGE, EDGE, 1 + len(vocabulary) + (key & np.uint64(15)).astype(np.int64))
    if len(vocabulary):
        slot = np.minimum(np.searchsorted(vocabulary, key), len(vocabulary) - 1)
        hit = vocabulary[slot] == key
        token[hit] = ids[slot[hit]]
    return doc, token


def _previous(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.zeros_like(key)
    out[1:] = np.where(doc[1:] == doc[:-1], key[:-1], np.uint64(EDGE))
    return out


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def pair_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``h1, h2, n``: neighbouring word keys, counted per chunk of texts."""

    def run(batches):
        for batch in batches:
            for _, _, data, off in tv.chunks(batch.column(0), lower=True):
                doc, key = word_keys(data, off)
                (h1, h2), n = _distinct(_previous(doc, key), key)
                yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(n)], names=["h1", "h2", "n"])

    return docs.select(text_of(text_col).alias("text")).mapInArrow(run, "h1 long, h2 long, n long")


def _lookup(df: DataFrame, table: DataFrame, on: dict[str, str], values: dict[str, str], weight: str, floor: float) -> DataFrame:
    """``df`` plus ``values`` (new name: column of ``table``), null without a match.

    Rows of ``table`` whose ``weight`` reaches ``floor`` are broadcast; rows of
    ``df`` that they serve are dealt by a hash of the pair in the join with the others.
    """
    side = lambda t, p: t.select(*[F.col(k).alias(f"{p}{k}") for k in on.values()], *[F.col(v).alias(f"{p}_{n}") for n, v in values.items()])
    first = next(iter(on.values()))
    hot, cold = side(table.where(F.col(weight) >= floor), "_hot_"), side(table.where(F.col(weight) < floor), "_cold_")
    d = df.join(F.broadcast(hot), [F.col(c) == F.col(f"_hot_{k}") for c, k in on.items()], "left")
    for c, k in on.items():
        d = d.withColumn(f"_key_{k}", F.when(F.col(f"_hot_{first}").isNull(), F.col(c)).otherwise(F.xxhash64("h1", "h2")))
    d = d.join(cold, [F.col(f"_key_{k}") == F.col(f"_cold_{k}") for k in on.values()], "left")
    return d.select(*df.columns, *[F.when(F.col(f"_hot_{first}").isNotNull(), F.col(f"_hot__{n}")).otherwise(F.col(f"_cold__{n}")).alias(n) for n in values])


def _classed(pairs: DataFrame, model: Model) -> DataFrame:
    """``pairs`` (``h1, h2, ...``) plus the tokens ``c1, c2`` and their counts ``ub1, ut1, ub2, ut2``."""
    for i in ("1", "2"):
        h = F.col("h" + i)
        pairs = _lookup(pairs, model.words, {"h" + i: "word"}, {"wb": "ub", "wt": "ut"}, "ub", model.nb / HOT_ROWS)
        token = F.when(F.col("wb").isNotNull() | (h == EDGE), h).otherwise(h.bitwiseAND(15) + 1)
        pairs = pairs.withColumn("c" + i, token)
        few = model.classes.select(F.col("token").alias("_token"), F.col("ub").alias("_ub"), F.col("ut").alias("_ut"))
        pairs = pairs.join(F.broadcast(few), F.col("c" + i) == F.col("_token"), "left")  # SHAPES + 1 rows
        pairs = pairs.withColumns({"ub" + i: F.coalesce("wb", "_ub", F.lit(0)), "ut" + i: F.coalesce("wt", "_ut", F.lit(0))})
        pairs = pairs.drop("wb", "wt", "_token", "_ub", "_ut")
    return pairs


def _by_shape() -> Column:
    return F.col("c1").between(1, SHAPES) | F.col("c2").between(1, SHAPES)


def _losses(classed: DataFrame, model: Model) -> DataFrame:
    """``h1, h2, b, lt, lb`` of classed pairs with their own counts ``b, t``; pairs that training hasn't seen get their token's unigram loss."""
    x = _lookup(classed, model.mixed, {"c1": "c1", "c2": "c2"}, {"mb": "b", "mt": "t"}, "b", model.nb / HOT_ROWS)
    of = lambda own, all_: F.when(_by_shape(), F.coalesce(all_, F.lit(0))).otherwise(F.col(own))
    x = x.withColumns({"pb": of("b", "mb"), "pt": of("t", "mt")})

    def loss(pair: str, context: str, n: str, total: int):
        alone = (F.col(n) + ADD) / (total + ADD * model.types)
        # a token is as often the first of a pair as it is the second
        big = F.when(F.col(context) > 0, F.col(pair) / F.col(context)).otherwise(alone)
        return -F.log(F.when(F.col("pb") + F.col("pt") > 0, WEIGHT * big + (1 - WEIGHT) * alone).otherwise(alone))

    return x.select("h1", "h2", "b", loss("pt", "ut1", "ut2", model.nt).alias("lt"), loss("pb", "ub1", "ub2", model.nb).alias("lb"))


def train(docs: DataFrame, target: DataFrame, text_col: str = "text", vocabulary_size: int | None = None) -> Model:
    """Count both corpora and stage the tables of the model.

    The vocabulary holds every word of at least ``MIN_COUNT`` occurrences, or
    the ``vocabulary_size`` most frequent of them if that is given.
    """
    b, t = pair_counts(docs, text_col), pair_counts(target, text_col)
    both = b.select("h1", "h2", F.col("n").alias("b"), F.lit(0).cast("long").alias("t")).unionByName(
        t.select("h1", "h2", F.lit(0).cast("long").alias("b"), F.col("n").alias("t")))
    pairs = staged(both.groupBy("h1", "h2").agg(F.sum("b").alias("b"), F.sum("t").alias("t")), "pairs")
    unigrams = staged(pairs.groupBy(F.col("h2").alias("word")).agg(F.sum("b").alias("ub"), F.sum("t").alias("ut")), "unigrams")
    words = unigrams.where((F.col("word") != EDGE) & (F.col("ub") >= MIN_COUNT))
    if vocabulary_size is not None:
        words = words.orderBy(F.desc("ub"), "word").limit(vocabulary_size)
    words = staged(words, "vocabulary")
    others = unigrams.join(words.select("word"), "word", "left_anti")
    token = F.when(F.col("word") == EDGE, F.lit(EDGE).cast("long")).otherwise(F.col("word").bitwiseAND(15) + 1)
    classes = staged(others.groupBy(token.alias("token")).agg(F.sum("ub").alias("ub"), F.sum("ut").alias("ut")), "classes")
    nb, nt = (x or 0 for x in unigrams.agg(F.sum("ub"), F.sum("ut")).first())
    model = Model(words, classes, None, None, words.count() + 1 + SHAPES, nb, nt)
    classed = staged(_classed(pairs, model), "classed")
    mixed = staged(classed.where(_by_shape()).groupBy("c1", "c2").agg(F.sum("b").alias("b"), F.sum("t").alias("t")), "mixed")
    model = Model(words, classes, mixed, None, model.types, nb, nt)
    return Model(words, classes, mixed, staged(_losses(classed, model), "losses"), model.types, nb, nt)


def _pair_key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tv.mix(h1 * np.uint64(0x9E3779B97F4A7C15) + h2)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, target_loss, background_loss, score`` of every row; losses are means per token.

    The closing edge is a token, so a null or empty text has one token and a
    defined score. Pairs that training hasn't seen fall back to their token's
    unigram loss. Frequent pairs are summed where the text is read, the others
    go as one row per document and pair to the losses.
    """
    top = model.losses.where(F.col("b") >= max(1, model.nb / HOT_ROWS)).toArrow()  # at most HOT_ROWS rows
    h1, h2 = (top.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
    by = np.argsort(_pair_key(h1, h2))
    hot = docs.sparkSession.sparkContext.broadcast((_pair_key(h1, h2)[by], h1[by], h2[by], top.column("lt").to_numpy()[by], top.column("lb").to_numpy()[by]))

    def run(batches):
        keys, p1, p2, lt, lb = hot.value
        for batch in batches:
            uid, ids = batch.column("uid"), batch.column("id")
            for a, b, data, off in tv.chunks(batch.column("text"), lower=True):
                doc, key = word_keys(data, off)
                (doc, h1, h2), n = _distinct(doc, _previous(doc, key), key)
                served = np.zeros(len(doc), dtype=bool)
                sums = np.zeros((3, b - a))
                if len(keys):
                    slot = np.minimum(np.searchsorted(keys, _pair_key(h1, h2)), len(keys) - 1)
                    served = (p1[slot] == h1) & (p2[slot] == h2)
                    for i, w in enumerate((np.ones(len(keys)), lt, lb)):
                        sums[i] = np.bincount(doc[served], weights=(w[slot] * n)[served], minlength=b - a)
                # one row per document with what the frequent pairs gave, then its other pairs
                rest = ~served
                row = np.concatenate((np.arange(b - a), doc[rest]))
                head = np.arange(len(row)) < b - a
                fill = lambda x, y: np.concatenate((x, y))
                none = np.zeros(rest.sum())
                yield pa.RecordBatch.from_arrays([
                    uid.take(pa.array(a + row)), ids.take(pa.array(np.where(head, a + row, 0), mask=~head)),
                    pa.array(fill(np.zeros(b - a, dtype=np.int64), h1[rest].view(np.int64)), mask=head),
                    pa.array(fill(np.zeros(b - a, dtype=np.int64), h2[rest].view(np.int64)), mask=head),
                    pa.array(fill(sums[0].astype(np.int64), n[rest])), pa.array(fill(sums[1], none)), pa.array(fill(sums[2], none))],
                    names=["uid", "id", "h1", "h2", "n", "st", "sb"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("uid", F.monotonically_increasing_id())
    rows = staged(src.mapInArrow(run, "uid long, id long, h1 long, h2 long, n long, st double, sb double"), "document-pairs")
    heads, others = rows.where(F.col("h1").isNull()), rows.where(F.col("h1").isNotNull()).select("uid", "h1", "h2", "n")
    joined = others.join(model.losses.select("h1", "h2", "lt", "lb"), ["h1", "h2"], "left")
    summed = lambda df: df.groupBy("uid").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("lt")).alias("st"), F.sum(F.col("n") * F.col("lb")).alias("sb"),
        F.sum(F.when(F.col("lt").isNull(), 1).otherwise(0)).alias("unseen"))
    parts = staged(summed(joined), "sums")
    all_parts = parts.select("uid", "n", F.coalesce("st", F.lit(0.0)).alias("st"), F.coalesce("sb", F.lit(0.0)).alias("sb"))
    if not parts.where("unseen > 0").isEmpty():
        new = others.join(model.losses.select("h1", "h2"), ["h1", "h2"], "left_anti")
        pairs = new.select("h1", "h2").distinct().withColumns({"b": F.lit(0).cast("long"), "t": F.lit(0).cast("long")})
        back = staged(_losses(_classed(pairs, model), model), "losses")
        more = summed(new.join(back.select("h1", "h2", "lt", "lb"), ["h1", "h2"]))
        all_parts = all_parts.unionByName(more.select("uid", F.lit(0).cast("long").alias("n"), "st", "sb"))
    every = heads.select("uid", "id", "n", "st", "sb").unionByName(all_parts.withColumn("id", F.lit(None).cast("long")))
    out = every.groupBy("uid").agg(F.max("id").alias("id"), F.sum("n").alias("n_tokens"), F.sum("st").alias("st"), F.sum("sb").alias("sb"))
    target, background = F.col("st") / F.col("n_tokens"), F.col("sb") / F.col("n_tokens")
    return out.select("id", "n_tokens", target.alias("target_loss"), background.alias("background_loss"), (target - background).alias("score"))
