"""Mixing sources to target weights (2): a multivariate-hypergeometric splitting tree.

Every source is a random order of its documents, cut into blocks. Its quota of
block draws (whole passes over the source and a last, partial one) is split
exactly among the output shards: at every node of a binary tree the left half
takes a multivariate-hypergeometric sample of the node's draws. Each shard then
gets disjoint runs of the permuted blocks and orders its documents by a hash of
its own. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, staged, text_of

WEIGHTS = (5, 2, 1)        # by rank of the source, repeating
MAX_EPOCHS = 3
BLOCK_DOCS = 64
SHARD_LEVELS = 4           # 2**4 output shards
SEED = "mix-1"
KEY_BITS = 60
MAX_BROADCAST_SOURCES = 10_000
EQUAL_ROWS = 1_000         # equal rows numbered by one task at a time


def words(text_col: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, rows, source_size, target`` from one row of ``source, rows, source_size`` per source.

    Sources in code-point order, null last, get the weights in turn. Targets
    share the total size by weight; none exceeds ``max_epochs`` times its
    source, and what that frees is shared again: the sources whose cap per
    weight is least are capped, the others get one rate for all weights.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("w", pick).withColumn("cap", F.col("source_size") * max_epochs)
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    s = s.withColumn("full", F.col("cap") / F.col("w") <= rate)
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0))
    return s.select("source", "rows", "source_size", "w",
                    F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * rest / free).alias("target"))


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Draw how many of ``drawn`` out of ``total`` items are among the ``marked`` ones, by inversion of ``u``.

    Ratios of neighbouring probabilities are summed over the support within 12
    standard deviations and 12 of the mean; what lies beyond is below 1e-30.
    """
    n, k, d = (x.cast("double") for x in (total, marked, drawn))
    mean = F.when(n > 0, d * k / n).otherwise(0.0)
    spread = 12 * F.sqrt(F.when(n > 1, mean * (1 - k / n) * (n - d) / (n - 1)).otherwise(0.0)) + 12
    low = F.greatest(F.lit(0.0), d - (n - k), F.floor(mean - spread).cast("double")).cast("long")
    high = F.least(k, d, F.ceil(mean + spread).cast("double")).cast("long")
    zero = F.lit(0.0)

    def bind(value: Column, body) -> Column:  # a lambda variable: what stands inside a lambda is computed for every element
        return F.transform(F.array(value), body)[0]

    def draw(x: Column) -> Column:
        steps = F.sequence(x["low"], F.greatest(x["low"], x["high"]))

        def log_ratio(i: Column) -> Column:  # log of P(i) / P(i - 1)
            return F.when(i <= x["low"], zero).otherwise(F.log((x["k"] - i + 1) * (x["d"] - i + 1) / (i * (x["n"] - x["k"] - x["d"] + i))))

        def grown(s: Column, i: Column, peak: Column) -> Column:
            return s["sum"] + F.exp(s["lp"] + log_ratio(i) - peak)

        peak = F.aggregate(steps, F.struct(zero.alias("lp"), zero.alias("top")), lambda s, i: F.struct(
            (s["lp"] + log_ratio(i)).alias("lp"), F.greatest(s["top"], s["lp"] + log_ratio(i)).alias("top")), lambda s: s["top"])

        def invert(peak: Column) -> Column:
            mass = F.aggregate(steps, F.struct(zero.alias("lp"), zero.alias("sum")), lambda s, i: F.struct(
                (s["lp"] + log_ratio(i)).alias("lp"), grown(s, i, peak).alias("sum")), lambda s: s["sum"])
            return bind(mass * x["u"], lambda goal: F.aggregate(
                steps, F.struct(zero.alias("lp"), zero.alias("sum"), x["low"].alias("at")), lambda s, i: F.struct(
                    (s["lp"] + log_ratio(i)).alias("lp"), grown(s, i, peak).alias("sum"),
                    F.when(s["sum"] < goal, i).otherwise(s["at"]).alias("at")), lambda s: s["at"]))

        return bind(peak, invert)

    return bind(F.struct(n.alias("n"), k.alias("k"), d.alias("d"), low.alias("low"), high.alias("high"), u.alias("u")), draw)


def split_quotas(quotas: DataFrame, levels: int = SHARD_LEVELS, seed: str = SEED) -> DataFrame:
    """``source, shard, draws`` from ``source, draws``: exact quotas of ``2**levels`` shards.

    Shards differ by at most one draw; per source the shards' draws sum to the
    source's. One source after the other is sampled at a node, given what the
    earlier ones took. The table has one row per source.
    """
    nodes = quotas.select("source", F.lit(0).cast("long").alias("node"), F.col("draws").cast("long").alias("draws"))
    for level in range(levels):
        per_source = Window.partitionBy("node").orderBy(F.col("source").isNull(), "source")
        rows = nodes.withColumns({"total": F.sum("draws").over(Window.partitionBy("node")), "rank": F.row_number().over(per_source)})
        rows = rows.withColumn("u", (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), "node", "rank"), 11) + F.lit(0.5)) / F.lit(float(1 << 53)))
        arrays = rows.groupBy("node").agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("rank", "source", "draws", "u"))).alias("xs"))
        start = F.struct(F.col("total").alias("n"), F.ceil(F.col("total") / 2).cast("long").alias("d"),
                         F.array().cast("array<bigint>").alias("out"))

        def step(s: Column, x: Column) -> Column:
            return F.transform(F.array(_hypergeometric(s["n"], x["draws"], s["d"], x["u"])), lambda h: F.struct(
                (s["n"] - x["draws"]).alias("n"), (s["d"] - h).alias("d"), F.concat(s["out"], F.array(h)).alias("out")))[0]

        arrays = arrays.withColumn("left", F.aggregate("xs", start, step, lambda s: s["out"]))
        each = arrays.select("node", F.explode(F.arrays_zip("xs", "left")).alias("z")).select("node", "z.xs.source", "z.xs.draws", "z.left")
        nodes = each.select("source", F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("draws")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("draws") - F.col("left")).alias("draws")))).alias("h")).select("source", "h.node", "h.draws")
        nodes = staged(nodes.coalesce(1), "quotas")
    return nodes.select("source", F.col("node").cast("int").alias("shard"), "draws")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, block_docs: int = BLOCK_DOCS, levels: int = SHARD_LEVELS, seed: str = SEED) -> DataFrame:
    """What the mix takes of every row.

    ``id, source, tie, key, size, source_size, target, taken, block, shards``.
    ``key`` orders a source's documents at random; ``taken`` counts words,
    repeats included; ``shards`` has the output shard of each copy, one per
    pass that takes words of the row. The last pass stops at the word where the
    source's target (rounded) is met, so its last document may be cut there and
    sources meet their targets exactly. ``tie`` is the digest of the text.

    The key is drawn from the id, the digest and the number of the row among its
    equals, so neither an id nor a text on many rows fills a block.

    Null and empty texts have no words and are never taken. A null source is a
    source of its own. Rows equal in id, source and text are interchangeable:
    they are counted before the shuffle and numbered again in pieces of
    ``EQUAL_ROWS``. An empty table gives an empty result.
    """
    each = ["id", "source", "tie", "size"]
    equal = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), F.md5(text_of(text_col)).alias("tie"),
                        words(text_col).alias("size")).groupBy(*each).agg(F.count(F.lit(1)).alias("c"))
    pieces = equal.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(c - 1) div {EQUAL_ROWS}")))).repartition("id", "tie", "piece")
    numbered = pieces.withColumn("nth", F.explode(F.sequence(F.col("piece") * EQUAL_ROWS + 1, F.least(F.col("c"), (F.col("piece") + 1) * EQUAL_ROWS))))
    name = F.concat(F.lit(seed + "/"), F.col("tie"), F.lit("/"), F.col("nth").cast("string"), F.lit("/"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    key = F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long")
    rows = staged(numbered.select(*each, key.alias("key")), "sizes")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, max_epochs)
                     .withColumn("blocks", F.ceil(F.col("rows") / block_docs).cast("long"))
                     .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                     .withColumn("rest", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("passes") * F.col("source_size")))
                     .coalesce(1), "targets")
    small = targets.count() <= MAX_BROADCAST_SOURCES  # beyond it a shuffled join, whose hot keys Spark splits

    def with_source(df: DataFrame, table: DataFrame) -> DataFrame:
        table = table.withColumnRenamed("source", "_s")
        cond = df["source"].eqNullSafe(table["_s"])
        return df.join(F.broadcast(table) if small else table, cond).drop("_s")

    # blocks are equal ranges of the random key: disjoint, and already in random order
    block = F.least(F.col("blocks") - 1, F.expr(f"key div ({1 << KEY_BITS} div blocks)"))
    placed = with_source(rows, targets).withColumn("block", block)
    sums = placed.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    order = Window.partitionBy("source").orderBy("block")  # one row per block of `block_docs` documents
    sums = sums.withColumn("block_start", F.sum("block_size").over(order) - F.col("block_size"))
    # draws: every block (empty ones too) once per pass, those of the last pass up to the one that holds its end
    last = with_source(sums, targets.select("source", "rest")).where("block_start < rest").groupBy("source").agg((F.max("block") + 1).alias("more"))
    t2, l2 = targets.select("source", "blocks", "passes"), last.withColumnRenamed("source", "_s")
    quotas = t2.join(l2, t2["source"].eqNullSafe(l2["_s"]), "left").select(
        "source", (F.col("blocks") * F.col("passes") + F.coalesce("more", F.lit(0))).alias("draws"))
    shards = split_quotas(staged(quotas.coalesce(1), "draws"), levels, seed)
    upto = Window.partitionBy("source").orderBy("shard")
    ends = (shards.withColumn("end", F.sum("draws").over(upto)).groupBy("source")
            .agg(F.sort_array(F.collect_list("end")).alias("ends")))  # one number per shard
    s2 = sums.withColumnRenamed("source", "_s").withColumnRenamed("block", "_b").drop("block_size")
    full = placed.join(s2, placed["source"].eqNullSafe(s2["_s"]) & (placed["block"] == s2["_b"])).drop("_s", "_b")
    inside = Window.partitionBy("source", "block").orderBy("key", "id", "tie")  # one block
    full = full.withColumn("before", F.col("block_start") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    full = full.withColumn("part", part).withColumn("taken", F.col("passes") * F.col("size") + F.col("part"))
    copies = F.when(F.col("size") > 0, F.col("passes") + (F.col("part") > 0).cast("long")).otherwise(0)
    full = with_source(full.withColumn("copies", copies), ends)
    shard = lambda e: F.size(F.filter("ends", lambda x: x <= e * F.col("blocks") + F.col("block")))
    where = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), shard)).otherwise(F.array().cast("array<int>"))
    return full.select("id", "source", "tie", "key", "size", "source_size", "target", "taken", "block", where.alias("shards"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: a row of ``docs`` per copy taken, plus ``shard``, ``position_key``, ``take_words``.

    Within a shard the rows are in random order by ``position_key`` (the local
    shuffle; write with ``partitionBy('shard')`` and sort by it). ``take_words``
    is below the row's words only for the document where a source's target ends.
    Rows equal in id, source and text are matched to their takes one by one. Where ``docs`` has a
    column of one of these names, the added one gets ``_`` at its end. Rows of null or empty text aren't taken; an empty table gives none.
    """
    takes = mix(docs, id_col, text_col, source_col, **options)
    inner = ("_id", "_size", "_source", "_n", "_tie", "_tid", "_ttie", "_tsource", "_tn", "_taken", "_key", "_shards", "_copy", "shard", "position_key", "take_words")
    c = {x: fresh(docs, x) for x in inner}
    nth = lambda cols, order: F.row_number().over(Window.partitionBy(*cols).orderBy(order))
    t = takes.where(F.size("shards") > 0).select(F.col("id").alias(c["_tid"]), F.col("tie").alias(c["_ttie"]), F.col("source").alias(c["_tsource"]),
                                                 F.col("key").alias(c["_key"]), F.col("shards").alias(c["_shards"]), F.col("taken").alias(c["_taken"]))
    t = t.withColumn(c["_tn"], nth([c["_tid"], c["_ttie"], c["_tsource"]], F.desc(c["_taken"])))
    d = docs.withColumns({c["_id"]: F.col(id_col).cast("long"), c["_size"]: words(text_col), c["_tie"]: F.md5(text_of(text_col)), c["_source"]: F.col(source_col)})
    d = d.withColumn(c["_n"], nth([c["_id"], c["_tie"], c["_source"]], F.col(c["_id"])))
    cond = (d[c["_id"]].eqNullSafe(t[c["_tid"]]) & (d[c["_tie"]] == t[c["_ttie"]]) & d[c["_source"]].eqNullSafe(t[c["_tsource"]])
            & (d[c["_n"]] == t[c["_tn"]]))
    j = d.join(t, cond).select(*docs.columns, c["_size"], c["_taken"], c["_key"], F.posexplode(c["_shards"]).alias(c["_copy"], c["shard"]))
    take = F.least(F.col(c["_size"]), F.col(c["_taken"]) - F.col(c["_copy"]) * F.col(c["_size"]))
    return j.select(*docs.columns, c["shard"], F.xxhash64(c["_key"], c["shard"], c["_copy"]).alias(c["position_key"]), take.alias(c["take_words"]))
