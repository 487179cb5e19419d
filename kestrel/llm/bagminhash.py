"""MinHash near-dedup (5): BagMinHash signatures, banding, exact multiset check.

A document is the multiset of its five-word shingles. Every shingle carries a
hierarchy of independent Poisson processes over its discretised weight: one on
[0, 1), one on [1, 2), [2, 4), [4, 8), ... each of the rate of its length. A
point has a time, a position inside its interval and one of ``m`` components.
A weight ``w`` sees the points at positions below ``w``; the signature holds the
earliest time of each component. Two multisets agree in a component with the
probability of their weighted Jaccard similarity. Points later than a bound
that fills nearly all components are never made; documents with an empty
component are redone with the bound doubled, so signatures are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import staged, text_of
from .components import connected_components

SHINGLE_WORDS = 5
COMPONENTS = 64
BAND_ROWS = 4
THRESHOLD = 0.8
LEADERS = 4            # leaders of a one-band bucket by hash order, besides its smallest node
SMALL_BUCKET = 16       # buckets of so many nodes at most compare all pairs between components
MEMBERS_PER_TASK = 512  # members of one leader that are compared in one group
COUNTERS = 1 << 20      # counters that tell rare shingles from common ones; they set the order of prefixes, not the result


def weighted_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (first row, last row + 1, document, shingle hash, weight) per chunk, sorted by document and hash."""
    for a, b, data, off in tv.chunks(texts):
        doc, sh = tv.shingles(*tv.words(data, off), b - a, width)
        order = np.lexsort((sh, doc))
        doc, sh = doc[order], sh[order]
        new = np.ones(len(sh), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (sh[1:] != sh[:-1])
        at = np.flatnonzero(new)
        yield a, b, doc[at], sh[at], np.diff(np.append(at, len(sh)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures, ``n_docs`` x ``m`` times; rows of empty multisets are infinite."""
    sig = np.full((n_docs, m), np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs) if len(doc) else np.zeros(n_docs)
    bound = m * (math.log(m) + 3) / np.maximum(total, 1)
    open_docs = total > 0
    while open_docs.any():
        sel = open_docs[doc]
        _points(doc[sel], element[sel], weight[sel], bound, sig, m)
        open_docs = (total > 0) & np.isinf(sig).any(axis=1)
        bound = bound * 2
    return sig


def _points(doc, element, weight, bound, sig, m) -> None:
    """Lower ``sig`` by every accepted point that comes before its document's bound."""
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1  # dyadic intervals that the weight touches
    at = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, np.exp2(level - 1.0))
    rate = np.where(level == 0, 1.0, low)
    with np.errstate(over="ignore"):
        key = tv.mix(element[at] + level.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    owner, room, limit = doc[at], weight[at] - low, bound[doc[at]]
    time = np.zeros(len(at))
    flat = sig.reshape(-1)
    while len(key):
        with np.errstate(over="ignore"):
            key = tv.mix(key + np.uint64(0xE7037ED1A0B428DB))
        time = time - np.log(tv.uniform(key)) / rate
        live = time < limit
        key, time, owner, rate, room, limit = (x[live] for x in (key, time, owner, rate, room, limit))
        draw = tv.mix(key ^ np.uint64(0x8EBC6AF09C88C6E3))
        taken = tv.uniform(draw) * rate < room
        component = (tv.mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(flat, owner[taken] * m + component[taken], time[taken])


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` components."""
    bits = np.ascontiguousarray(sig).view(np.uint64)
    keys = np.zeros((sig.shape[0], sig.shape[1] // rows), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            keys = tv.mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, r::rows][:, : keys.shape[1]] + np.uint64(r + 1))
    return keys.view(np.int64)


def signature_table(docs: DataFrame, id_col: str, text_col: str, m: int = COMPONENTS, rows: int = BAND_ROWS) -> DataFrame:
    """uid, id, d1, d2 (digest of the text), bands (null for a text without words) of every row."""

    def run(batches):
        for batch in batches:
            out = np.empty(batch.num_rows, dtype=object)
            for a, b, doc, sh, weight in weighted_sets(batch.column("text")):
                sig = signatures(doc, sh, weight, b - a, m)
                keys = band_keys(sig, rows)
                filled = ~np.isinf(sig).any(axis=1)
                for i in range(a, b):
                    out[i] = keys[i - a] if filled[i - a] else None
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("d1"), batch.column("d2"), pa.array(out, type=pa.list_(pa.int64()))],
                names=["id", "d1", "d2", "bands"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    src = src.select("id", "text", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2"))
    table = src.mapInArrow(run, "id long, d1 long, d2 long, bands array<long>")
    return staged(table.withColumn("uid", F.monotonically_increasing_id()), "signatures")


def multiset_overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted hash multisets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = np.minimum(ca[i], cb[j]).sum()
    return float(shared / (len(a) + len(b) - shared))


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int = SHINGLE_WORDS) -> DataFrame:
    """``node, hashes`` (sorted 32-bit shingle hashes with repeats) of the nodes of ``wanted`` (``node, d1, d2, rep_id``).

    The merge hint keeps one plan for every size: both sides are dealt by the
    digest, however small the wanted nodes are.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    src = src.select("id", "text", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2"))
    cond = [src["d1"] == wanted["d1"], src["d2"] == wanted["d2"], src["id"].eqNullSafe(wanted["rep_id"])]
    joined = src.hint("merge").join(wanted, cond).select("node", "text")

    def hashed(batches):
        for batch in batches:
            out = [b""] * batch.num_rows
            for a, b, data, off in tv.chunks(batch.column("text")):
                doc, sh = tv.shingles(*tv.words(data, off), b - a, width)
                sh = (sh >> np.uint64(32)).astype(np.uint32)
                sh = sh[np.lexsort((sh, doc))]
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    out[a + i] = sh[cut[i]: cut[i + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, type=pa.binary())], names=["node", "hashes"])

    return staged(joined.mapInArrow(hashed, "node long, hashes binary"), "sets")


def verify(sets: DataFrame, edges: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Keep the edges (a, b) whose multisets reach ``threshold``; adds the similarity.

    One row per edge goes to the edge's leader ``b``. A leader with many members
    is repeated for each group of about ``MEMBERS_PER_TASK`` of them, so no
    group grows with the data.
    """
    degree = edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK).cast("int").alias("groups"))
    member = (edges.join(degree, "b")
              .select(F.col("a").alias("node"), F.col("b").alias("leader"),
                      F.pmod(F.xxhash64("a"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("kind")))
    leader = degree.select(F.col("b").alias("node"), F.col("b").alias("leader"),
                           F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("kind"))
    roles = staged(member.unionByName(leader), "roles")
    rows = sets.hint("merge").join(roles, "node").select("leader", "part", "kind", "node", "hashes")
    rows = rows.repartition("leader", "part").sortWithinPartitions("leader", "part", "kind")

    def compare(batches):
        current, mine = None, None
        for batch in batches:
            a, b, sim = [], [], []
            cols = [batch.column(i) for i in range(5)]
            for leader, part, kind, node, raw in zip(*(c.to_pylist() for c in cols[:4]), cols[4]):
                other = np.frombuffer(raw.as_buffer(), dtype=np.uint32)
                if kind == 0:
                    current, mine = (leader, part), other.copy()
                elif (leader, part) == current:
                    small, large = sorted((len(mine), len(other)))
                    if small >= threshold * large:
                        s = multiset_overlap(mine, other)
                        if s >= threshold:
                            a.append(node), b.append(leader), sim.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())],
                                             names=["a", "b", "similarity"])

    return rows.mapInArrow(compare, "a long, b long, similarity double").dropDuplicates(["a", "b"])


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``node, c, size, pos, element, short`` of every element in the prefix of a node's set (``node, c, hashes``).

    Elements are (shingle, occurrence), ordered from rare to common. Of two sets
    that reach ``threshold`` the first common element lies in the prefix of the
    larger one and in the ``short`` prefix of the smaller one. Rarity is read
    from a fixed number of shared counters: equal counters only make prefixes
    less selective.
    """

    def count(batches):
        seen = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("hashes"):
                seen += np.bincount(np.unique(np.frombuffer(raw.as_buffer(), dtype=np.uint32)) % COUNTERS, minlength=COUNTERS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["slot", "n"])

    found = sets.select("hashes").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    common = np.zeros(COUNTERS, dtype=np.int64)
    common[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(common)

    def cut(batches):
        for batch in batches:
            parts = []
            for i, raw in enumerate(batch.column("hashes")):
                h = np.frombuffer(raw.as_buffer(), dtype=np.uint32)
                n = len(h)
                if not n:
                    continue
                nth = np.arange(n) - np.searchsorted(h, h)
                order = np.lexsort((nth, h, shared.value[h % COUNTERS]))[: n - math.ceil(threshold * n - 1e-6) + 1]
                element = ((h[order].astype(np.uint64) << np.uint64(32)) | nth[order].astype(np.uint64)).view(np.int64)
                pos = np.arange(len(order))
                parts.append((np.full(len(order), i), np.full(len(order), n), pos, element, pos <= n - math.ceil(2 * threshold / (1 + threshold) * n - 1e-6)))
            row, size, pos, element, short = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, dtype=np.int64)] * 4 + [np.zeros(0, dtype=bool)]
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(row)), batch.column("c").take(pa.array(row)), pa.array(size), pa.array(pos),
                                              pa.array(element), pa.array(short)], names=["node", "c", "size", "pos", "element", "short"])

    return sets.select("node", "c", "hashes").mapInArrow(cut, "node long, c long, size long, pos long, element long, short boolean")


def similar_candidates(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b``: every pair of nodes of different components ``c`` that can reach ``threshold``, by a prefix join.

    Nodes of an element's largest component meet only nodes of other ones, so
    the join makes no pairs inside a large component. The two sides of a
    common element are dealt over a grid of parts of ``MEMBERS_PER_TASK`` rows.
    """
    rows = staged(prefixes(sets, threshold), "prefixes")
    per = rows.groupBy("element", "c").agg(F.count(F.lit(1)).alias("n"), F.count_if("short").alias("k"))
    per = per.groupBy("element").agg(F.max_by("c", F.struct("n", "c")).alias("top"), F.sum("n").alias("n"), F.sum("k").alias("k"),
                                     F.count(F.lit(1)).alias("parts")).where("parts > 1 and k > 0")
    groups = lambda x: F.ceil(F.col(x) / MEMBERS_PER_TASK).cast("int")
    rows = staged(rows.join(per.select("element", "top", groups("n").alias("gn"), groups("k").alias("gk")), "element")
                  .withColumn("top", F.col("c") == F.col("top")), "prefixes")
    part = lambda g: F.pmod(F.xxhash64("node"), F.col(g)).cast("int")
    every = lambda g: F.explode(F.sequence(F.lit(0), F.col(g) - 1))
    # cells: 0 both outside the largest component, 1 the larger set inside it, 2 the smaller one inside it
    cells = lambda inside, outside: F.explode(F.when(F.col("top"), F.array(F.lit(inside))).otherwise(F.array(F.lit(0), F.lit(outside))))
    x = (rows.where("short").withColumn("cell", cells(2, 1)).withColumn("px", part("gk")).withColumn("py", every("gn"))
         .select("element", "cell", "px", "py", "node", "c", "size", "pos"))
    y = (rows.withColumn("cell", cells(1, 2)).withColumn("py", part("gn")).withColumn("px", every("gk"))
         .select("element", "cell", "px", "py", F.col("node").alias("node2"), F.col("c").alias("c2"), F.col("size").alias("size2"), F.col("pos").alias("pos2")))
    need = F.ceil((F.col("size") + F.col("size2")) * (threshold / (1 + threshold)) - 1e-6)
    fits = ((F.col("c") != F.col("c2")) & (F.struct("size", "node") < F.struct("size2", "node2"))
            & (F.col("size") >= threshold * F.col("size2") - 1e-6)
            & (F.col("size") - F.col("pos") >= need) & (F.col("size2") - F.col("pos2") >= need))
    same = (x["element"] == y["element"]) & (x["cell"] == y["cell"]) & (x["px"] == y["px"]) & (x["py"] == y["py"])
    return x.join(y, same & fits).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    m: int = COMPONENTS, rows: int = BAND_ROWS) -> DataFrame:
    """Class of every row: ``id, d1, d2, uid, cls, class_id, class_size, copies``.

    Classes are the connected components of the links of at least ``threshold``
    weighted Jaccard similarity between distinct texts; equal texts share a
    class. ``cls`` names the class (never null), ``class_id`` is its smallest
    id (null only if all are), ``copies`` counts the rows with the same text.

    1. Equal texts collapse to one node. 2. Every bucket of one, two or four
    neighbouring bands has leaders, one-band buckets up to ``LEADERS + 1``; each
    member is compared with them. 3. In buckets whose members then still lie in
    different components, those of at most ``SMALL_BUCKET`` nodes compare every
    pair between components. The nodes of larger ones go through an exact
    prefix join of their shingles: every pair of them that can reach the
    threshold and lies in different components is compared.

    So every link within a bucket ends in one class, whatever the bucket's size.
    Only a link without a common bucket can be missed (2 in 10,000 at the
    threshold).

    Null texts count as empty; all texts without words but equal bytes form one
    class, others stay alone. Null ids are allowed, repeated rows are copies.
    An empty table gives an empty result. Other columns are ignored.
    """
    table = signature_table(docs, id_col, text_col, m, rows)
    nodes = staged(table.groupBy("d1", "d2").agg(F.min("uid").alias("node"), F.min("id").alias("rep_id"),
                                                  F.count(F.lit(1)).alias("copies")), "nodes")
    reps = table.join(nodes.select(F.col("node").alias("uid")), "uid", "left_semi").where(F.col("bands").isNotNull())
    bands = m // rows
    key = lambda j: F.get("bands", j % bands)
    keyed = reps.select(F.col("uid").alias("node"), F.explode(F.array(*[
        F.struct(F.lit(j).alias("band"), key(j).alias("k1"), F.xxhash64(key(j), key(j + 1)).alias("k2"),
                 F.xxhash64(key(j), key(j + 1), key(j + 2), key(j + 3)).alias("k4")) for j in range(bands)])).alias("x")).select("node", "x.*")
    count = keyed.groupBy("band", "k1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(keyed.join(count, ["band", "k1"]), "buckets")  # only buckets of two nodes or more
    # of every bucket the smallest node and, in one-band buckets, the first by LEADERS hash orders
    lead = shared.groupBy("band", "k1").agg(F.array_distinct(F.array(F.min("node"), *[
        F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(LEADERS)])).alias("leads"))
    wide = shared.select("band", "k1", F.col("node").alias("a")).join(lead, ["band", "k1"]).select("a", F.explode("leads").alias("b"))
    stars = [wide]
    for k in ("k2", "k4"):
        head = shared.groupBy("band", k).agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b <> other").drop("other")
        stars.append(shared.select("band", k, F.col("node").alias("a")).join(head, ["band", k]).select("a", "b"))
    first = staged(reduce(DataFrame.unionByName, stars).where("a <> b").distinct(), "edges")
    sets = shingle_sets(docs, nodes.join(shared.select("node").distinct(), "node", "left_semi"), id_col, text_col)
    comp = staged(connected_components(verify(sets, first, threshold).select("a", "b")), "components")
    tagged = shared.join(comp, "node", "left").select("band", "k1", "n", "node", F.coalesce("component", "node").alias("c"))
    mixed = tagged.groupBy("band", "k1").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").drop("lo", "hi")
    left = staged(tagged.join(mixed, ["band", "k1"]), "mixed")
    x = left.where(F.col("n") <= SMALL_BUCKET)
    y = x.select("band", "k1", F.col("node").alias("b2"), F.col("c").alias("c2"))
    small = x.join(y, ["band", "k1"]).where("node > b2 and c <> c2").select(F.col("node").alias("a"), F.col("b2").alias("b"))
    crowd = staged(left.where(F.col("n") > SMALL_BUCKET).select("node", "c").distinct(), "crowd")
    if not crowd.isEmpty():
        small = small.unionByName(similar_candidates(sets.join(crowd, "node"), threshold).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    rest = staged(small.distinct().join(first, ["a", "b"], "left_anti"), "edges")
    if not rest.isEmpty():
        # the new links join components of step 2
        root = lambda side: comp.select(F.col("node").alias(side), F.col("component").alias("c" + side))
        more = (verify(sets, rest, threshold).join(root("a"), "a", "left").join(root("b"), "b", "left")
                .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        joined = staged(connected_components(more), "components")
        over = joined.select(F.col("node").alias("component"), F.col("component").alias("over"))
        moved = comp.join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component"))
        comp = moved.unionByName(joined.join(comp, "node", "left_anti"))
    classes = nodes.join(comp, "node", "left").withColumn("cls", F.coalesce("component", "node"))
    summary = classes.groupBy("cls").agg(F.min("rep_id").alias("class_id"), F.sum("copies").alias("class_size"))
    classes = classes.join(summary, "cls").select("d1", "d2", "cls", "class_id", "class_size", "copies")
    return table.select("id", "d1", "d2", "uid").join(classes, ["d1", "d2"])
