"""Hard-negative mining (11): best-first search of STR-packed R-trees.

Vectors become integer points. Spark deals them into shards of neighbouring
points (sort-tile-recursive cuts of the first two coordinates; a shard above
``SHARD_ROWS`` points, such as one of equal vectors, is split by row hash) and each shard is packed by a task
into an R-tree: within a label, points are tiled coordinate by coordinate, so
nodes are boxes with per-coordinate bounds. A box and an anchor give an
interval of inner products; the search takes boxes from a queue in order of
their upper ends and drops those outside the score windows, strictly below the
k-th score so far, or equal to it with only larger ids.

Anchors travel to every shard as ordinary rows behind the shard's points, so a
task holds one tree and one Arrow batch of anchors, however many there are;
only the best k of each shard go on to the merge.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SHARD_ROWS = 50_000     # points of a tree at most, about; 64 components take 26 MB
SPREAD_ROWS = 2_000     # points a shard should have at least when rows are dealt over the cores
LEAF = 64               # points of a leaf
FANOUT = 16             # children of an inner node
SCALE = 256.0
LIMIT = 2 ** 53         # components are cut to +-LIMIT, scores to the long range
EXACT = 2 ** 53         # up to here sums of products are exact in double precision

BROADCAST_SHARDS = 100_000  # up to so many shards their list of sizes (24 bytes a row) is broadcast
_LONG = np.iinfo(np.int64)


def integer_points(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``id, label, v`` of the rows that take part, ``v`` being ``floor(256 x)`` of every component ``x``.

    Rows with a null label, a null vector or a null, infinite or NaN component are left out.
    """
    x = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # the cut comes first, as a double beyond the long range has no floor
    whole = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * F.lit(SCALE), F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("long"))
    return rows.where(F.col("label").isNotNull() & x.isNotNull() & fine).withColumn("v", whole)


def shards(points: DataFrame, n: int, n_shards: int) -> DataFrame:
    """The ``n`` points with ``shard``: tiles of the first coordinate, then of the second within each, large ones split by row hash."""
    if n_shards <= 1:
        return points.withColumn("shard", F.lit(0).cast("long"))
    slabs = max(1, round(n_shards ** 0.5))
    tiles = -(-n_shards // slabs)
    at = lambda i: F.coalesce(F.try_element_at("v", F.lit(i)), F.lit(0))
    cut = lambda x, k: F.percentile_approx(x, F.array(*[F.lit(i / k) for i in range(1, k)]), 1000)
    rank = lambda cuts, x: F.size(F.filter(cuts, lambda c: c < x))
    small = F.broadcast if n_shards <= BROADCAST_SHARDS else lambda df: df
    out = points.withColumns({"x": at(1), "y": at(2), "slab": F.lit(0), "tile": F.lit(0)})
    if slabs > 1:
        out = out.withColumn("x_cuts", out.agg(cut("x", slabs)).scalar()).withColumn("slab", rank(F.col("x_cuts"), F.col("x"))).drop("x_cuts")
    if tiles > 1:
        out = out.join(small(out.groupBy("slab").agg(cut("y", tiles).alias("y_cuts"))), "slab").withColumn("tile", rank(F.col("y_cuts"), F.col("y")))
    sizes = out.groupBy("slab", "tile").agg(F.ceil(F.count(F.lit(1)) * F.lit(0.8 * n_shards / n)).alias("pieces"))
    piece = F.pmod(F.xxhash64("rk"), F.col("pieces"))
    return out.join(small(sizes), ["slab", "tile"]).withColumn("shard", F.xxhash64("slab", "tile", piece)).select(*points.columns, "shard")


def _str_order(v: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of points: tiles of the widest coordinate, then of the next within each, down to leaves."""
    spread = np.argsort(-(v.max(axis=0) - v.min(axis=0)), kind="stable") if v.shape[1] else np.zeros(0, dtype=np.int64)
    levels = min(len(spread), 4)

    def order(idx: np.ndarray, level: int) -> np.ndarray:
        if level == levels or len(idx) <= LEAF:
            return idx
        idx = idx[np.argsort(v[idx, spread[level]], kind="stable")]
        leaves = -(-len(idx) // LEAF)
        slabs = max(1, round(leaves ** (1 / (levels - level))))
        size = -(-leaves // slabs) * LEAF
        return np.concatenate([order(idx[i: i + size], level + 1) for i in range(0, len(idx), size)])

    return order(np.arange(len(v)), 0)


class RTree:
    """Points packed label by label; ``levels[0]`` are the leaves, each level above groups ``FANOUT`` nodes."""

    def __init__(self, rk: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, v: np.ndarray):
        by_label = np.lexsort((v[:, 0] if v.shape[1] else rk, labels))
        cuts = np.flatnonzero(np.diff(labels[by_label])) + 1
        order = np.concatenate([part[_str_order(v[part])] if len(part) > LEAF else part for part in np.split(by_label, cuts)])
        self.rk, self.known, self.labels, self.v = rk[order], known[order], labels[order], v[order]
        self.rank = np.where(self.known, ids[order], _LONG.max)     # null ids come last
        self.biggest = float(np.abs(v).max()) if v.size else 0.0
        at = np.arange(0, len(order), LEAF)
        self.levels = [(np.minimum.reduceat(self.v, at), np.maximum.reduceat(self.v, at), np.minimum.reduceat(self.labels, at),
                        np.maximum.reduceat(self.labels, at), np.minimum.reduceat(self.rank, at))]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last, least = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at),
                                np.maximum.reduceat(last, at), np.minimum.reduceat(least, at)))

    def search(self, anchor: np.ndarray, label: int, own: int, same: bool, windows: list[tuple[int, int]], k: int) -> list[list[tuple]]:
        """Per window the best ``k`` (score, id, rk) whose label equals (or differs from) ``label``.

        Higher scores first, ties by smaller id; the row ``own`` itself doesn't count.
        """
        d = self.v.shape[1]
        a = np.zeros(d)
        a[: min(d, len(anchor))] = anchor[:d]
        exact = self.biggest * float(np.abs(a).max() if d else 0) * max(d, 1) < EXACT
        if not exact:       # big components: the same sums in whole numbers of any size
            a = np.array([int(x) for x in a], dtype=object)
        plus, minus = np.maximum(a, 0), np.minimum(a, 0)
        as_needed = (lambda m: m) if exact else (lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape))
        best: list[list[tuple]] = [[] for _ in windows]

        def wanted(w: int, low: int, high: int, least: int) -> bool:
            lo, hi = windows[w]
            if high < lo or low > hi:
                return False
            if len(best[w]) < k:
                return True
            score, last = -best[w][-1][0], best[w][-1][1]
            return min(high, hi) > score or min(high, hi) == score and least < last

        def push(level: int, nodes: slice) -> None:
            low, high, first, last, least = (x[nodes] for x in self.levels[level])
            low, high = as_needed(low), as_needed(high)
            upper, lower = high @ plus + low @ minus, low @ plus + high @ minus
            other = (first > label) | (last < label) if same else (first == label) & (last == label)
            for i in np.flatnonzero(~other):
                heapq.heappush(queue, (-int(upper[i]), int(lower[i]), level, nodes.start + int(i), int(least[i])))

        queue: list[tuple] = []
        top = len(self.levels) - 1
        push(top, slice(0, len(self.levels[top][0])))
        while queue:
            upper, lower, level, node, least = heapq.heappop(queue)
            open_ = [w for w in range(len(windows)) if wanted(w, lower, -upper, least)]
            if not open_:
                continue
            if level:
                push(level - 1, slice(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0]))))
                continue
            rows = slice(node * LEAF, min((node + 1) * LEAF, len(self.v)))
            scores = as_needed(self.v[rows]) @ a
            fits = (self.labels[rows] == label) == same
            fits &= self.rk[rows] != own
            for w in open_:
                lo, hi = windows[w]
                floor = max(lo, -best[w][-1][0]) if len(best[w]) == k else lo
                pick = np.flatnonzero(fits & (scores >= floor) & (scores <= hi))
                if len(pick):
                    at = pick + rows.start
                    new = [(-int(s), int(i), not n, int(r)) for s, i, n, r in zip(scores[pick], self.rank[at], self.known[at], self.rk[at])]
                    best[w] = sorted(best[w] + new)[:k]
        return [[(-s, None if unknown else i, r) for s, i, unknown, r in b] for b in best]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of longs as rows of doubles; shorter ones are filled up with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(n), int(n.max(initial=0))))
    rows = np.repeat(np.arange(len(n)), n)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    d = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, d - p.shape[1]))) for p in parts])


FOUND = "anchor_rk long, window int, found_id long, found_rk long, score long"


def _search(batches: Iterator[pa.RecordBatch], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, role, rk, id, label, v, lows, highs`` sorted by shard and role: points (0) first, then anchors (1)."""
    shard, parts, tree = None, [], None
    for batch in batches:
        shard_of, role = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((np.diff(shard_of) != 0) | (np.diff(role) != 0)) + 1
        out: list[tuple] = []
        for a, b in zip([0, *cuts], [*cuts, len(role)]):
            if a == b:
                continue
            if shard_of[a] != shard:
                shard, parts, tree = shard_of[a], [], None
            part = batch.slice(a, b - a)
            rk = part.column(2).to_numpy(zero_copy_only=False)
            ids = part.column(3).fill_null(0).to_numpy(zero_copy_only=False)
            labels = part.column(4).to_numpy(zero_copy_only=False)
            if role[a] == 0:
                parts.append((rk, ids, part.column(3).is_valid().to_numpy(zero_copy_only=False), labels, _matrix(part.column(5))))
                continue
            if tree is None:
                if not parts:
                    continue
                tree = RTree(*[np.concatenate([p[i] for p in parts]) for i in range(4)], _stack([p[4] for p in parts]))
                parts = []
            anchors = _matrix(part.column(5))
            lows, highs = part.column(6).to_pylist(), part.column(7).to_pylist()
            for i in range(b - a):
                windows = list(zip(lows[i], highs[i]))
                for w, best in enumerate(tree.search(anchors[i], labels[i], rk[i], same, windows, k)):
                    out += [(rk[i], w, found, r, min(max(score, _LONG.min), _LONG.max)) for score, found, r in best]
        cols = list(zip(*out)) or [[]] * 5
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["anchor_rk", "window", "found_id", "found_rk", "score"])


def nearest(points: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The best ``k`` points per anchor and window: ``anchor_rk, window, rank, found_id, found_rk, score``.

    ``points`` have ``shard`` and the columns ``rk, id, label, v``, ``anchors`` the columns ``rk, id, label, v`` with arrays ``lows``
    and ``highs`` of inclusive score bounds. Every anchor meets every shard, as one row each.
    """
    # the query set against all shards, of which there is one per SHARD_ROWS points
    listed = points.select("shard").distinct().agg(F.collect_list("shard")).scalar()
    asked = anchors.withColumn("shard", F.explode(listed))
    cols = ["shard", "role", "rk", "id", "label", "v", "lows", "highs"]
    none = F.lit(None).cast("array<long>")
    rows = (points.withColumns({"role": F.lit(0), "lows": none, "highs": none}).select(*cols)
            .unionByName(asked.withColumn("role", F.lit(1)).select(*cols)))
    found = (rows.repartition("shard").sortWithinPartitions("shard", "role")
             .mapInArrow(lambda it: _search(it, same, k), FOUND))
    order = Window.partitionBy("anchor_rk", "window").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_rk")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(points: DataFrame, anchor, k_positive: int = 5, k_negative: int = 5, low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``points`` are the rows of ``integer_points`` (labels already as wanted),
    ``anchor`` a condition on their ``id`` and ``label``. An anchor's positives are its first
    ``k_positive`` other rows of the same label by integer inner product
    (higher first, ties by smaller id); for each the first ``k_negative`` rows of
    another label with ``low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score``.

    Edge cases: repeated rows are rows of their own (equal in rank by id, each may be chosen);
    a null id is no anchor unless the condition says so, and comes last in ties;
    vectors of unequal length are filled up with zeros; a negative positive
    score leaves an empty window (the bounds cross); components beyond
    ``LIMIT`` are cut to it, scores to the long range; anchors without positive
    or negative give no row; no points, no rows.
    """
    spark = points.sparkSession
    # rows that are equal in everything differ by a running number of the scan, fixed by the staged table
    points = staged(points.withColumn("rk", F.monotonically_increasing_id()).select("rk", "id", "label", "v"), "negative-points")
    n = points.count()
    cores = spark.sparkContext.defaultParallelism
    n_shards = max(-(-n // SHARD_ROWS), min(2 * cores, n // SPREAD_ROWS), 1)
    points = staged(shards(points, n, n_shards), "negative-shards")
    anchors = points.where(anchor).drop("shard")
    everything = lambda x: F.array(F.lit(x).cast("long"))
    positives = staged(nearest(points, anchors.withColumns({"lows": everything(_LONG.min), "highs": everything(_LONG.max)}), True, k_positive),
                       "negative-positives")
    # floor and ceiling of whole numbers: -(-a div b)
    s = F.col("score").cast("decimal(30,0)")
    low = F.ceil(s * low_percent / 100).cast("long")
    high = F.floor(s * high_percent / 100).cast("long")
    per_anchor = positives.groupBy("anchor_rk").agg(F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("w"))
    asked = (anchors.join(per_anchor, anchors["rk"] == per_anchor["anchor_rk"])
             .withColumns({"lows": F.transform("w", lambda x: x["low"]), "highs": F.transform("w", lambda x: x["high"])}))
    found = nearest(points, asked.select("rk", "id", "label", "v", "lows", "highs"), False, k_negative)
    pairs = positives.select("anchor_rk", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("rk").alias("anchor_rk"), F.col("id").alias("anchor_id"))
    return (found.join(pairs, ["anchor_rk", "window"]).join(ids, "anchor_rk")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
