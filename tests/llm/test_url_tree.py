"""The template tree against a plain walk of the same rules; sections that only other hosts' labels speak of."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm import url_filter as uf
from kestrel.sources.tables import read_table

from ..conftest import SF001


def half_up(x: float) -> int:
    return math.floor(x + 0.5)


def share(good: int, labels: int, p: int) -> float:
    return (good + 2 * (0.5 + (p / 100 - 0.5) * 2 / (labels + 2))) / (labels + 2)


def slow_tree(urls):
    """``{(host, segs): (template, purity)}`` of ``(host, segs, label)`` rows; priors in hundredths."""
    state = {}
    for host, segs, label in urls:
        r = state.setdefault((host, segs), {"n": 0, "good": 0, "bad": 0, "t": "", "p": 50})
        r["n"] += 1
        r["good"] += label == 1
        r["bad"] += label == 0
    mean = lambda rows: half_up(sum(r["p"] * r["n"] for r in rows) / sum(r["n"] for r in rows))
    open_rows, level = dict(state), 0
    while open_rows:
        here = {k: r for k, r in open_rows.items() if len(k[1]) > level}
        told = defaultdict(lambda: [0, 0])
        for (_, segs), r in here.items():
            name = segs[level]
            if r["good"] + r["bad"] and re.search(r"[^\W\d_]", name) and "{n}" not in name:
                told[name][0] += r["good"]
                told[name][1] += r["bad"]

        def prior(name, good, bad, p):
            if name not in told:
                return p
            g, b = told[name][0] - good, told[name][1] - bad
            return half_up(100 * (g + 2 * p / 100) / (g + b + 2)) if g + b else p

        branches = defaultdict(list)
        for (host, segs), r in here.items():
            branches[host, r["t"]].append((segs, r))
        open_rows = {}
        for (host, template), rows in branches.items():
            if len(rows) == 1:
                segs, r = rows[0]
                r["p"] = prior(segs[level], r["good"], r["bad"], r["p"])
                r["t"] = template + "/" + "/".join(x if r["n"] >= 2 else "*" for x in segs[level:])
                continue
            total, values = sum(r["n"] for _, r in rows), defaultdict(list)
            for segs, r in rows:
                values[segs[level]].append(r)
            named = {}
            for name, members in values.items():
                n, good, bad = (sum(r[c] for r in members) for c in ("n", "good", "bad"))
                literal = n >= 2 and (n >= min(0.05 * total, 20) or good + bad >= 3)
                beside = max(0, sum(told[name]) - good - bad) if name in told else 0
                named[name] = {"child": name if literal or name in told else "*", "n": n, "good": good, "bad": bad, "e": beside,
                               "p": prior(name, good, bad, mean(members))}
            kids = defaultdict(list)
            for v in named.values():
                kids[v["child"]].append(v)
            siblings = []
            for child, vs in kids.items():
                good, bad, p = sum(v["good"] for v in vs), sum(v["bad"] for v in vs), mean(vs)
                weight = good + bad + 2 ** math.floor(math.log2(max(v["e"] for v in vs) + 1)) - 1
                siblings.append((weight > 0, share(good, good + bad, p), weight, good, p, child))
            siblings.sort()
            islands, last = [], None
            for s in siblings:
                new = last is None or s[0] != last[0] or (s[0] and abs(s[1] - last[1]) > 1.96 * math.sqrt(
                    s[1] * (1 - s[1]) / (s[2] + 2) + last[1] * (1 - last[1]) / (last[2] + 2)))
                if new:
                    islands.append([])
                islands[-1].append(s[5])
                last = s
            names = {}
            for island in islands:
                island.sort()
                name = "|".join(island[:21]) + (f"|+{len(island) - 21}" if len(island) > 21 else "")
                names.update(dict.fromkeys(island, name))
            for segs, r in rows:
                v = named[segs[level]]
                r["t"], r["p"] = template + "/" + names[v["child"]], v["p"]
                open_rows[host, segs] = r
        level += 1
    pooled = defaultdict(list)
    for (host, _), r in state.items():
        pooled[host, r["t"]].append(r)
    purity = {}
    for k, rows in pooled.items():
        good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
        purity[k] = share(good, good + bad, mean(rows))
    return {(host, segs): (r["t"], purity[host, r["t"]]) for (host, segs), r in state.items()}


def compare(spark, rows):
    df = spark.createDataFrame([(h, list(s), x) for h, s, x in rows], "host string, segs array<string>, label int")
    got = {(r["host"], tuple(r["segs"])): (r["template"], r["purity"]) for r in uf.template_tree(df).collect()}
    want = slow_tree(rows)
    assert got.keys() == want.keys()
    for k, (t, p) in want.items():
        assert got[k][0] == t and abs(got[k][1] - p) < 1e-9, (k, got[k], (t, p))
    return got


def test_tree_of_random_urls_against_the_plain_walk(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(700):
        host = rng.choice(["a.x", "b.x", "c.y", "d.y", "e.y"])
        sec = rng.choice(["news", "shop", "win", "{n}", "", "blog", "wïn"])
        segs = (sec, *[rng.choice(["{n}", "new", "old", f"w{rng.randint(0, 30)}", "item-{n}"]) for _ in range(rng.randint(0, 3))])
        label = None if host in ("d.y", "e.y") and rng.random() < 0.97 or rng.random() < 0.3 else int(rng.random() < {"win": 0.05, "shop": 0.4}.get(sec, 0.9))
        rows.append((host, segs, label))
    compare(spark, rows)


def test_tree_of_the_pages_against_the_plain_walk(spark):
    url = F.col("url")
    rows = read_table(spark, SF001.replace("sf0.001", "sf0.01"), "pages").select(uf.host_of(url).alias("host"), uf.path_of(url).alias("path"))
    rows = rows.withColumn("m", uf.matching_rule(F.col("host"), F.col("path"))).withColumn("segs", uf.segments(F.col("path")))
    label = {"allow": 1, "block": 0, None: None}
    compare(spark, [(r["host"], tuple(r["segs"]), label[r["m"]["verdict"] if r["m"] else None]) for r in rows.collect()])


def test_sections_known_from_other_hosts(spark):
    rows, labels = [], []
    for h in range(6):
        for i in range(12):
            sec = ("casino", "essays")[i % 2]
            rows.append((h * 100 + i, f"http://h{h}.example/{sec}/{i}"))
            if h < 4:
                labels.append((h * 100 + i, int(sec == "essays")))
    rows += [(900, "http://solo.example/casino/9"), (901, "http://solo2.example/essays/9"), (902, "http://solo3.example/unknown/9"), (903, "http://solo4.example/")]
    got = {r["id"]: r for r in uf.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=(),
                                              labels=spark.createDataFrame(labels, "id long, label int")).collect()}
    for i, u in rows:
        assert got[i]["verdict"] == ("block" if "casino" in u else "allow"), (u, got[i])
    assert got[902]["purity"] == got[903]["purity"] == uf.NEUTRAL


@pytest.mark.parametrize("n", [1, 2])
def test_few_labels_elsewhere_block_nothing(spark, n):
    rows = [(i, f"http://h{i}.example/win/{i}") for i in range(5)]
    labels = [(i, 0) for i in range(n)]
    got = uf.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=(), labels=spark.createDataFrame(labels, "id long, label int")).collect()
    assert {r["verdict"] for r in got if r["id"] >= n} == {"allow"}
