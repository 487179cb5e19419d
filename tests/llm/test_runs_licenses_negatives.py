"""Operators 11 to 13 against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import hard_negatives, license_scan, periodic_runs
from kestrel.llm.queries import QUERIES

RNG = np.random.default_rng(12)
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every maximal run by definition: all periods, all stretches."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def tiled(k):
    parts = [np.zeros(0, dtype=int)]
    for _ in range(RNG.integers(0, 7)):
        block = np.tile(RNG.integers(0, k, RNG.integers(1, 25)), RNG.integers(1, 9))
        parts += [block[: RNG.integers(0, len(block) + 1)], RNG.integers(0, k + RNG.integers(0, 30), RNG.integers(0, 20))]
    return np.concatenate(parts)


def test_runs_equal_brute_force():
    for _ in range(60):
        texts = [tiled(RNG.integers(1, 6)) for _ in range(RNG.integers(1, 8))]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        got = periodic_runs.find_runs(np.concatenate(texts).astype(np.int32), offsets)
        want = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t.tolist())]
        assert [tuple(r) for r in got.tolist()] == want


def test_sums_of_squares_are_exact():
    for h in (1, 2, 8, 64):
        x = RNG.integers(0, 40, 9 * h).astype(np.uint64)
        got = periodic_runs.lag_products(x, h)
        want = [[int(sum(int(x[i * h + j]) * int(x[i * h + j + h + lag]) for j in range(h))) for i in range(7)] for lag in range(h + 1)]
        assert got.tolist() == want


def test_fibonacci_and_uniform_texts():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert len(periodic_runs.find_runs(np.array(b, dtype=np.int32), np.array([0, len(b)]))) == 0   # no run of exponent 4
    one = np.ones(200_000, dtype=np.int32)
    assert periodic_runs.find_runs(one, np.array([0, len(one)])).tolist() == [[0, 0, 200_000, 1]]
    assert len(periodic_runs.find_runs(one[:5], np.array([0, 5]))) == 0 and len(periodic_runs.find_runs(one[:0], np.array([0, 0, 0]))) == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(one, np.array([0, 5]), min_exponent=3)


DOCS = [(i, " ".join(f"w{x}" for x in tiled(4)), "x") for i in range(1, 60)]
DOCS += [(i, " ".join(f"w{x}" for x in RNG.integers(0, 9, i % 70)), "x") for i in range(60, 200)]
DOCS += [(None, "a b c d " * 9, "n"), (None, None, "n"), (500, None, "n"), (501, "", "n"), (502, " \t\n ", "n"), (503, "a b c\x0bd　e " * 8, "n"),
         (504, "x y " * 30_000 + "z", "n"), (505, "same " * 5, "n"), (505, "same " * 5, "n"), (506, "é à " * 9, "n")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "k", "r", 1) for i, t, s in DOCS], "doc_id long, text string, source string, id string, runs string, n_words int")


def planted(doc_id, text):
    words = SPACE.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op12_equals_brute_force(spark, docs, monkeypatch):
    from kestrel.llm import queries

    monkeypatch.setattr(queries, "read_table", lambda *a: docs)
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, "").collect()), key=str)
    want, repeated = [], 0
    for doc_id, text, _ in DOCS:
        words = planted(doc_id, text)
        repeated += words != SPACE.findall(text or "")
        runs = brute_runs(words) if len(words) < 10_000 else [(0, 60_000, 2)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(runs), *row, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                     digest(" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert repeated > 5
    assert got == sorted(want, key=str)


def test_runs_report_spans_and_text(spark, docs):
    rows = periodic_runs.periodic_runs(docs.where("doc_id = 506")).collect()
    assert [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows] == [(18, [(0, 18, 2)], "é à")]
    assert periodic_runs.periodic_runs(docs.where("false")).collect() == []
    assert [(r["id"], r["n_words"], r["runs"], r["collapsed"]) for r in periodic_runs.periodic_runs(docs.where("doc_id = 500")).collect()] == [(500, 0, [], "")]


# ---- license scans


def scan(spark, texts, templates=license_scan.TEMPLATES):
    df = spark.createDataFrame([(i, t, "c", "d") for i, t in enumerate(texts)], "doc_id long, text string, labels string, matches string")
    return license_scan.summary(license_scan.license_matches(df, templates=templates)).orderBy("id").collect()


def test_templates_equal_their_regular_expressions(spark):
    words = sorted({w for t in license_scan.TEMPLATES for w in license_scan.tokens(license_scan.MARK.sub(" ", t.markup))} | {"foo", "4", "2", "cc", "c"})
    texts = []
    for t in license_scan.TEMPLATES:
        plain = license_scan.MARK.sub(lambda m: f" {(m[3] or '').split('|')[0].replace('..', ' ')} ", t.markup)
        base = license_scan.tokens(plain)
        texts += [" ".join(base).title(), "-".join(["xx", *base, "yy"]), " ".join(base[:-1]), " ".join(base[1:])]
        for _ in range(12):
            mine = list(base)
            mine[RNG.integers(len(mine))] = str(RNG.choice(words))
            texts.append(" ".join([*RNG.choice(words, 3), *mine, *RNG.choice(words, 3)]))
    rows = scan(spark, texts)
    for text, row in zip(texts, rows):
        t = " ".join(license_scan.tokens(text)) + " "
        want = {x.name for x in license_scan.TEMPLATES if re.search("(?:^| )" + license_scan.as_regex(x.markup), t)}
        assert {m["template"] for m in row["matches"]} == want, text
    assert len({m["template"] for r in rows for m in r["matches"]}) == len(license_scan.TEMPLATES)


def test_optional_and_replaceable_regions(spark):
    t = (license_scan.Template("t", "l", 'alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> <<var;words="1..3">> omega <<var;match="x y|z">>'),)
    accepted = ["alpha k omega z", "Alpha BETA k. Omega x-y", "alpha beta gamma a b c omega z", "alpha beta omega z", "alpha omega omega z"]
    refused = ["alpha omega z", "alpha a b c d e omega z", "alpha k omega x", "alpha k omegas z", "k omega z", "", None]
    assert [bool(r["matches"]) for r in scan(spark, accepted + refused, t)] == [True] * len(accepted) + [False] * len(refused)
    for bad in ("a <<beginOptional>> b", "a <<endOptional>>", "<<beginOptional>>a<<endOptional>>", 'a <<var;words="3..1">>', "a <<unknown>>", ""):
        with pytest.raises(ValueError):
            license_scan.parse(bad)


def test_scan_edge_cases(spark):
    long = "word " * 300_000 + "MIT License " + "word " * 10
    rows = scan(spark, [None, "", " . ", "mit-LICENSE mit license", "mıt license MIT license ÉMIT license", long, "mit license", "mit license"])
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["score"]) for r in rows] == [
        (0, 0, None, None, "", 0.0), (0, 0, None, None, "", 0.0), (0, 0, None, None, "", 0.0), (4, 2, 0, 2, "mit", 0.75),
        (5, 0, None, None, "", 0.0), (300_012, 1, 300_000, 300_000, "mit", 0.75), (2, 1, 0, 0, "mit", 0.75), (2, 1, 0, 0, "mit", 0.75)]
    assert scan(spark, []) == []


def test_words_of_one_hash_are_told_apart(monkeypatch):
    import pyarrow as pa

    auto = license_scan.Scanner((license_scan.Template("t", "t", "mit license"),))
    right = auto.encode
    monkeypatch.setitem(license_scan._scanners, auto.templates, auto)
    # every unknown word gets the code of "license", as if their hashes were equal
    monkeypatch.setattr(auto, "encode", lambda h: np.where(right(h) == 0, auto.codes["license"], right(h)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["mit other mit license", "mit thing"])], ["id", "text"])
    out = next(license_scan._batches(iter([batch]), auto.templates)).to_pylist()
    assert [[(m["start"], m["end"]) for m in r["matches"]] for r in out] == [[(2, 4)], []]


# ---- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, rk string, shard string, v string, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "a", "b", "c", 0.5) for i, v, y in rows], VECTORS)


def brute_negatives(rows, anchor):
    points = [(i, y, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], k) for k, (i, v, y) in enumerate(rows)
              if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    inner = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, y, v, k in points:
        if i is None or not anchor(i):
            continue
        scored = [(inner(v, w), j, z) for j, z, w, m in points if m != k]
        for ps, pid, _ in sorted((s for s in scored if s[2] == y), key=order)[:5]:
            fits = sorted((s for s in scored if s[2] != y and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:5]
            out += [(i, pid, r + 1, nid, ps, ns) for r, (ns, nid, _) in enumerate(fits)]
    return sorted(out, key=str)


def mined(df):
    got = hard_negatives.hard_negatives(hard_negatives.integer_points(df), F.col("id") % 5 == 0)
    return sorted(map(tuple, got.collect()), key=str)


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "LEAF", 4)
    monkeypatch.setattr(hard_negatives, "FANOUT", 3)
    hot = [0.5, 0.25, -0.5, 1.0]
    rows = [(i, (hot if i % 3 == 0 else RNG.normal(size=4).round(2).tolist()), int(RNG.integers(0, 4))) for i in range(400)]
    rows += [(400, None, 1), (405, hot, None), (410, [1.0, None], 1), (415, [float("nan")], 1), (420, [float("inf"), 1.0], 1), (425, [], 2), (430, [1.0], 2),
             (435, [1.0] * 6, 3), (None, hot, 1), (None, hot, 2), (440, hot, 1), (440, hot, 1), (445, [3e4, -2e4, 0.0, 1.0], 0)]
    got = mined(vectors(spark, rows))
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and len(got) > 1000


def test_negatives_with_big_components_and_tiny_tables(spark):
    rows = [(0, [1e7, 3.0], 0), (1, [1e7, 1.0], 0), (2, [1e7, 2.0], 1), (3, [9e6, 7.0], 1), (4, [1e30, 0.0], 2)]
    got = mined(vectors(spark, rows[:4]))
    assert got == brute_negatives(rows[:4], lambda i: i % 5 == 0) and got
    assert all(abs(r[5]) <= 2 ** 63 for r in mined(vectors(spark, rows)))     # beyond LIMIT components are cut, no overflow
    assert mined(vectors(spark, rows[:1])) == [] and mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(0, [-1.0], 0), (1, [1.0], 0), (2, [-1.0], 1)])) == []      # a negative positive score


def test_boxes_bound_the_scores_and_prune():
    v = RNG.normal(size=(3000, 3)).round(2) * 256
    labels = RNG.integers(0, 3, 3000)
    tree = hard_negatives.RTree(np.arange(3000), np.arange(3000), np.ones(3000, dtype=bool), labels, np.floor(v))
    assert sorted(tree.rk.tolist()) == list(range(3000))
    for low, high, first, last, least in tree.levels[:1]:
        for i in range(len(low)):
            part = slice(i * hard_negatives.LEAF, (i + 1) * hard_negatives.LEAF)
            assert (tree.v[part] >= low[i]).all() and (tree.v[part] <= high[i]).all() and (tree.rank[part] >= least[i]).all()
            assert (tree.labels[part] >= first[i]).all() and (tree.labels[part] <= last[i]).all()
    seen = []
    real = tree.v
    class Watched:
        shape = real.shape
        def __getitem__(self, k):
            seen.append(k)
            return real[k]
        def __len__(self):
            return len(real)
    tree.v = Watched()
    best = tree.search(real[7], int(tree.labels[7]), int(tree.rk[7]), True, [(-10 ** 18, 10 ** 18)], 5)[0]
    scores = sorted((-int(real[i] @ real[7]), int(tree.rk[i])) for i in range(3000) if tree.labels[i] == tree.labels[7] and i != 7)
    assert [(-s, r) for s, _, r in best] == scores[:5]
    assert len(seen) < len(tree.levels[0][0]) / 4      # most leaves are never read
