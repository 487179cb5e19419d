"""The training-data operators on small inputs: edge cases and brute-force versions."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.llm import bagminhash, decontaminate, fingerprint, lm_score, mixing, quality, substring, token_counts, url_filter, warc
from kestrel.llm import textvec as tv
from kestrel.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, bands string, d1 string, id string, rk string"
RNG = np.random.default_rng(7)
WORDS = np.array(["w%03d" % i for i in range(700)])


def prose(n: int) -> str:
    return " ".join(RNG.choice(WORDS, n))


BASE, OTHER, PASSAGE = prose(200), prose(150), prose(70)
ITEM = prose(40)
NEAR = " ".join("changed" if i == 90 else w for i, w in enumerate(BASE.split()))


def table(spark, rows):
    """Rows (doc_id, text, source) plus columns whose names clash with inner ones."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", "y", "z", "q", "r") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, [
        (1, BASE, "a"), (2, NEAR, "a"), (3, BASE, "b"), (3, BASE, "b"), (4, OTHER, None), (5, None, "a"), (6, "", "b"), (7, " \n ", "c"),
        (8, "one two", "c"), (None, prose(60), "a"), (10, prose(80) + " " + PASSAGE + " " + prose(30), "a"),
        (11, prose(50) + " " + PASSAGE + " " + prose(90), "b"), (12, prose(30) + " " + ITEM.upper().replace(" ", "  ") + " " + prose(30), "a"),
        (13, "ab " * 40_000, "c"), (14, "éß漢字 " * 30, "a"), (15, prose(3000), "b"),
    ])


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def words_of(text):
    return [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]


def test_words_match_the_pattern():
    import re

    texts = ["a b", None, "", "  x\ty\n", "é à", "z", " ", "\x0bq\x0c"]
    for a, b, data, off in tv.chunks(pa.array(texts), chunk_bytes=4):
        doc, start, end = tv.word_spans(data, off)
        got = [[bytes(data[s:e]).decode() for d, s, e in zip(doc, start, end) if d == i] for i in range(b - a)]
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts[a:b]]


def weighted_jaccard(x, y):
    cx, cy = ([Counter(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in (words_of(x), words_of(y))])
    both = sum((cx & cy).values())
    return both / (sum(cx.values()) + sum(cy.values()) - both) if cx and cy else float(x == y)


def test_bagminhash_estimates_weighted_jaccard():
    x = "a b c d e f g h i j " * 6 + prose(60)
    y = "a b c d e f g h i j " * 2 + " ".join(x.split()[60:]) + " " + prose(20)
    _, _, doc, sh, weight = next(bagminhash.weighted_sets(pa.array([x, y])))
    sig = bagminhash.signatures(doc, sh, weight, 2, m=2048)
    assert np.isfinite(sig).all()
    assert abs((sig[0] == sig[1]).mean() - weighted_jaccard(x, y)) < 0.05


def test_near_duplicates(spark, docs, empty):
    rows = bagminhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    cls = {r["id"]: r["cls"] for r in rows}
    assert cls[1] == cls[2] == cls[3] and next(r for r in rows if r["id"] == 2)["class_id"] == 1
    assert len({cls[i] for i in (1, 4, 7, 8, 10, 11, 12, 13, 14, 15, None)}) == 11
    assert cls[5] == cls[6] != cls[7]
    assert next(r for r in rows if r["id"] == 3)["copies"] == 3
    assert bagminhash.near_duplicates(empty).count() == 0


def test_near_duplicates_miss_no_link(spark):
    base = [prose(120).split() for _ in range(6)]
    rows = [(i, " ".join(w if RNG.random() > 0.015 else "x%d" % i for w in base[i % 6]), "s") for i in range(90)]
    got = {r["id"]: r["cls"] for r in bagminhash.near_duplicates(table(spark, rows)).collect()}
    text = {i: t for i, t, _ in rows}
    for a, b in itertools.combinations(text, 2):
        if weighted_jaccard(text[a], text[b]) >= 0.8:
            assert got[a] == got[b]
        if a % 6 != b % 6:
            assert got[a] != got[b]


def test_near_duplicates_in_one_hot_bucket(spark):
    """Thousands of texts that are mostly one boilerplate (0.76 alike) and hold families of two at 0.80 to 0.9."""
    boiler, rows = prose(160), []
    for f in range(1200):
        own = ["f%du%d" % (f, i) for i in range(24)]
        for j in range(2):
            cut = 7 + f % 12
            rows.append((2 * f + j, " ".join([boiler, *own[:cut], *("%sv%d" % (w, j) for w in own[cut:])]), "s"))
    sets = [{tuple(w[i: i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t, _ in rows)]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    where = {x: np.array(at) for x, at in where.items()}
    size, links = np.array([len(s) for s in sets]), []
    for i, s in enumerate(sets):
        both = np.bincount(np.concatenate([where[x] for x in s]), minlength=len(sets))
        links += [(i, int(j)) for j in np.flatnonzero(both >= 0.8 * (size + size[i] - both)) if j > i]
    assert len(links) == 1200 and all(b == a + 1 and a % 2 == 0 for a, b in links)
    got = {r["id"]: r["cls"] for r in bagminhash.near_duplicates(table(spark, rows)).collect()}
    assert [(a, b) for a, b in links if got[a] != got[b]] == [] and len(set(got.values())) == 1200


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_substring_dedup(spark, docs, empty):
    out = {r["doc_id"]: r["text"] for r in substring.dedup_substrings(docs).collect()}
    assert out[10].count(PASSAGE) == 1 and PASSAGE not in out[11]
    for i in (1, 4, 5, 6, 7, 8, 12, 15, None):
        assert out[i] == next(r["text"] for r in docs.collect() if r["doc_id"] == i)
    assert len(out[2]) < 300 and len(out[13]) < 1000  # a near copy and a text that repeats itself
    assert 0 < len(out[14]) < 150 and set(out[14].split()) == {"éß漢字"}  # so does this one; characters stay whole
    spans = substring.repeated_spans(docs).where("id = 11").collect()
    assert len(spans) == 1 and spans[0]["first_id"] == 10
    assert substring.dedup_substrings(docs).columns == docs.columns
    assert substring.dedup_substrings(empty).count() == 0


def test_cuts_resist_insertions():
    text = prose(2000).encode()

    def chunks(t):
        d = np.frombuffer(t, dtype=np.uint8)
        e = substring.cut_points(d, np.array([0, len(d)]))
        return {t[a:b] for a, b in zip([0, *e[:-1]], e)}

    a, b = chunks(text), chunks(text[:5000] + b"inserted" + text[5000:])
    assert b"".join(sorted(a)) and len(a - b) <= 4
    h = substring.gear(np.frombuffer(text, dtype=np.uint8))
    slow = 0
    for c in text[:300]:
        slow = ((slow << 1) + int(substring._GEAR[c])) & 0xFFFF
    assert slow == h[299]


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        nxt = [i]
        for j, d in enumerate(text, 1):
            nxt.append(min(row[j - 1] + (c != d), row[j] + 1, nxt[j - 1] + 1))
        row = nxt
    return min(row)


def test_leaks_against_edit_distance(spark):
    items = [prose(25) for _ in range(4)]
    rows, n = [], 0
    for item in items:
        for edits in (0, 2, 5, 12, 40):
            t = list(item)
            for at in RNG.choice(len(t), edits, replace=False):
                t[at] = RNG.choice(["", "#", t[at] + "+"])
            rows.append((n, prose(30) + " " + "".join(t) + " " + prose(30), "s"))
            n += 1
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(table(spark, rows), bench).collect()}
    for doc, text, _ in rows:
        for i, item in enumerate(items):
            k = decontaminate.edits_allowed(len(item))
            d = edit_distance_in(item, text)
            assert ((doc, i) in got) == (d <= k)
            if d <= k:
                assert got[doc, i] == d


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "short"), (4, ""), (5, ITEM + "\n"), (None, prose(30))], "item_id long, text string")
    rows = decontaminate.leaks(docs, bench).collect()
    assert [(r["id"], r["item_id"], r["edits"]) for r in rows] == [(12, 1, 0)]
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1 and kept.where("doc_id = 12").isEmpty()
    assert decontaminate.leaks(docs, bench, index_bytes=200).count() == 1  # in blocks
    assert decontaminate.decontaminate(empty, bench).count() == 0 and decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_quality_learns_from_positives_only(spark):
    clean = [(i, prose(int(RNG.integers(20, 200))).capitalize() + ".", "s") for i in range(300)]
    junk = [(1000 + i, " | ".join(RNG.choice(WORDS, 60)) + " $$$ !!", "s") for i in range(80)]
    docs = table(spark, clean + junk + [(2000, None, "s"), (2001, "", "s")])
    known = spark.createDataFrame([(i,) for i in range(0, 300, 2)], "doc_id long")
    model = quality.train(docs, known)
    assert abs(model.prior - 300 / 382) < 0.1
    score = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in score.values()) and score[2000] == score[2001]
    assert np.mean([score[i] >= 0.7 for i in range(1, 300, 2)]) > 0.95 and np.mean([score[1000 + i] < 0.7 for i in range(80)]) > 0.95
    kept = quality.keep_quality(docs, known)
    assert kept.columns == docs.columns
    assert quality.keep_quality(docs, known.limit(0)).count() == 0 and quality.keep_quality(docs.limit(0), known).count() == 0


def test_token_counts(spark, docs, empty):
    enc = token_counts._encoding(token_counts.TOKENIZER)
    want = Counter((r["doc_id"], len(enc.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    for block in (7, 1 << 16):  # documents over many blocks, many documents in a block
        got = token_counts.token_counts(docs.repartition(3), block_tokens=block)
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == want
    assert token_counts.token_counts(empty).count() == 0


def test_lm_scores_against_counts(spark, docs, empty):
    target = docs.where("doc_id in (1, 2, 3)")
    model = lm_score.train(docs, target, vocabulary_size=50)
    got = {r["id"]: r for r in lm_score.score_documents(docs, model).collect()}
    words, ids = model.value[0], model.value[1]

    def stream(text):
        data = np.frombuffer((text or "").lower().encode(), dtype=np.uint8)
        return [int(t) for t in lm_score.tokens(data, np.array([0, len(data)]), words, ids)[1]]

    all_rows = [(r["doc_id"], stream(r["text"])) for r in docs.collect()]
    types = len(words) + 1 + lm_score.SHAPES

    def losses(rows):
        pair, context, uni = Counter(), Counter(), Counter()
        for _, s in rows:
            for a, b in zip([0, *s], s):
                pair[a, b] += 1
                context[a] += 1
                uni[b] += 1
        n = sum(uni.values())
        p1 = lambda b: (uni[b] + lm_score.ADD) / (n + lm_score.ADD * types)
        return lambda a, b: -np.log(lm_score.WEIGHT * (pair[a, b] / context[a] if context[a] else p1(b)) + (1 - lm_score.WEIGHT) * p1(b))

    target_loss, background_loss = losses([r for r in all_rows if r[0] in (1, 2, 3)]), losses(all_rows)
    for i, s in all_rows:
        pairs = list(zip([0, *s], s))
        assert got[i]["n_tokens"] == len(s)
        assert got[i]["target_loss"] == pytest.approx(np.mean([target_loss(a, b) for a, b in pairs]), abs=1e-4)
        assert got[i]["background_loss"] == pytest.approx(np.mean([background_loss(a, b) for a, b in pairs]), abs=1e-4)
    assert got[1]["score"] < 0 < got[13]["score"]  # in the target; unlike it, but common in the background
    assert lm_score.score_documents(empty, lm_score.train(empty, empty)).count() == 0


def test_fingerprints(spark, docs, empty):
    order = sorted(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect(),
                   key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    want = []
    for r, nxt in zip(order, order[1:] + order[:1]):
        half = len(r["t"]) // 2
        edited = r["t"][: len(r["t"]) - half] + nxt["t"][:half]
        want.append((r["doc_id"], len(r["t"]), hashlib.sha256(edited.encode()).hexdigest()))
    for parts in (1, 4):
        df, _ = fingerprint.with_next(docs, buckets=parts)
        assert df.where("guest = 0").count() == docs.count()
    rows = fingerprint.fingerprint_edits(docs).collect()
    assert Counter((r["id"], r["n_chars"], r["edited_sha256"]) for r in rows) == Counter(want)
    sketch = {r["id"]: r["sketch"] for r in rows}
    assert sketch[1] == sketch[3] and sketch[5] == [] and len(sketch[15]) == fingerprint.K
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprint.fingerprint_edits(empty).count() == 0
    assert fingerprint.fingerprint_edits(docs.where("doc_id = 4")).first()["near_next"] == 1.0  # its own next


def test_sketches_merge_and_estimate(spark):
    w = prose(6000).split()
    parts = [("x", " ".join(w[:3004])), ("x", " ".join(w[3000:])), ("whole", " ".join(w)), ("half", " ".join(w[:3000]))]
    df = fingerprint.with_sketch(spark.createDataFrame(parts, "k string, text string"), "text", "s")
    merged = {r["k"]: r["s"] for r in fingerprint.merge(df, ["k"], "s").collect()}
    assert merged["x"] == merged["whole"]
    pair = spark.createDataFrame([(merged["half"], merged["whole"])], "a array<long>, b array<long>")
    r = pair.select(fingerprint.resemblance("a", "b").alias("r"), fingerprint.containment("a", "b").alias("c"),
                    fingerprint.distinct_shingles("b").alias("n")).first()
    assert abs(r["r"] - 0.5) < 0.15 and r["c"] > 0.75 and abs(r["n"] / 5996 - 1) < 0.3


def test_warc_round_trip(spark, scratch):
    big = "".join(chr(97 + i % 26) for i in range(5000)) + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/\n", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (None, "u", big),
            (7, "u", "é" * 2000), (7, "u", "é" * 2000), (8, "u", "x" * 999), (9, "u", "x" * 999), (10, "u", "\n\r\n" * 900)]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, sha1 string").repartition(2)
    path = f"{scratch}/warc"
    warc.write_archives(warc.plan_records(pages, "page_id", "html", "url"), path, segment_bytes=700)
    out = warc.read_archives(spark, path, chunk_bytes=300).collect()
    assert max(r["size"] for r in out) <= 300
    back = {}
    for r in sorted(out, key=lambda r: (r["file"], r["record_no"], r["chunk_no"])):
        key = (r["file"], r["record_no"])
        back.setdefault(key, [r["page_id"], r["record_type"], b""])[2] += r["data"]
        if r["last"] and r["record_type"] == "response":
            assert hashlib.sha1(back[key][2]).hexdigest() == r["running_sha1"] == r["digest"][5:]
    got = Counter((i, kind, data) for i, kind, data in back.values())
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and i != 2
        want[i, "revisit" if revisit else "response", b"" if revisit else data] += 1
    assert got == want
    full = {r["id"]: r for r in warc.archive_pages(pages).collect()}
    assert full[1]["refers_to"] == full[None]["refers_to"] == 2 and full[2]["refers_to"] is None
    assert full[1]["payload_bytes"] == len(big) and full[1]["payload_digest"] == hashlib.sha1(big.encode()).hexdigest()
    assert warc.archive_pages(pages.limit(0)).count() == 0


def slow_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for verdict, rule in url_filter.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x#y", "https://example.net", "https://example.net/de/1", "x://b.example.com/de/2", "x://b.example.com/fr/2",
            "http://c.org/fr/1", "http://norg/fr/1", "http://net/", "http://q.net?a=/en/", None, "no scheme", "http://É.net/", "", "a://b://c.net/x"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(1, urls[1], "h")], "page_id long, url string, host string")
    rows = url_filter.judge_urls(pages).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path, best = slow_rule(urls[r["id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
        assert r["verdict"] == (best[1] if best else "allow")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_template_tree(spark):
    rows, labels = [], []
    for i in range(200):
        kind = ("shop", "news", "blog", "deal")[i % 4]
        rows.append((i, f"http://h.example/{kind}/{i}/slug{i * 7}x" if kind != "shop" else f"http://h.example/shop/{prose(1)}{i}"))
        if i % 3:
            labels.append((i, int(kind in ("news", "blog"))))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    lab = spark.createDataFrame(labels, "id long, label int")
    got = {r["id"]: r for r in url_filter.judge_urls(pages, rules=(), labels=lab).collect()}
    for i, url in rows:
        assert got[i]["verdict"] == ("allow" if i % 4 in (1, 2) else "block")
    assert got[1]["template"].startswith("/blog|news/") and got[0]["template"].startswith("/deal|shop/")
    none = url_filter.judge_urls(pages, rules=(), labels=lab.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and {r["purity"] for r in none} == {0.5}


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        t = {s: most * sizes[s] if s in capped else w[s] * rest / free for s in names}
        over = {s for s in names if t[s] > most * sizes[s] + 1e-9}
        if not over:
            return t
        capped |= over


def test_mixing(spark, docs, empty):
    rows = mixing.mix(docs, block_docs=2, levels=2).collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words_of(r["text"]))
    want = slow_targets(sizes)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (len(r["shards"]) - 1) * r["size"] < r["taken"] + (r["taken"] == 0)
    for s, t in want.items():
        assert taken[s] == round(t)
    again = mixing.mix(docs.repartition(3), block_docs=2, levels=2).collect()
    assert Counter(map(str, again)) == Counter(map(str, rows))
    out = mixing.mixed_documents(docs, block_docs=2, levels=2).collect()
    assert sum(r["take_words"] for r in out) == sum(taken.values())
    assert mixing.mix(empty).count() == 0


def test_split_quotas_are_exact_and_hypergeometric(spark):
    quotas = {"a": 700, "b": 250, None: 49, "c": 1}
    df = spark.createDataFrame(list(quotas.items()), "source string, draws long")
    rows = mixing.split_quotas(df, levels=3).collect()
    per_source, per_shard = Counter(), Counter()
    for r in rows:
        per_source[r["source"]] += r["draws"]
        per_shard[r["shard"]] += r["draws"]
        assert r["draws"] >= 0
    assert dict(per_source) == quotas and max(per_shard.values()) - min(per_shard.values()) <= 1
    u = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    x = np.array([r[0] for r in u.select(mixing._hypergeometric(F.lit(50), F.lit(20), F.lit(10), F.col("u"))).collect()])
    assert abs(x.mean() - 4) < 0.01 and abs(x.var() - 10 * 0.4 * 0.6 * 40 / 49) < 0.03
