"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bagminhash, decontaminate, fingerprint, hard_negatives, license_scan, lm_corpus, mixing, periodic_runs, quality, substring, token_counts, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def held_out(id_col: str):
    """crc32 of the id as text, mod 4, is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def trusted_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids labelled 1 in the fold that labels may be learnt from."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return labels.where((F.col("quality") == 1) & ~held_out("doc_id")).select("doc_id")


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template", "purity")


MIX_SQL = r"""
WITH e AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS nth
  FROM documents),
d AS (
  SELECT doc_id, source, tie, size,
         CAST('0x' || substr(md5('mix-1/' || tie || '/' || nth || '/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM e),
s AS (
  SELECT source, sum(size) AS z, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, (sum(z) OVER () - coalesce(sum(3 * z) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM s WINDOW o AS (ORDER BY 3 * z / CAST(w AS DOUBLE), source IS NULL, source)),
c AS (SELECT *, 3 * z / CAST(w AS DOUBLE) <= rate AS capped FROM r),
t AS (
  SELECT source, z, CASE WHEN capped THEN CAST(3 * z AS DOUBLE)
         ELSE w * (sum(z) OVER () - coalesce(sum(CASE WHEN capped THEN 3 * z END) OVER (), 0))
              / CAST(sum(CASE WHEN NOT capped THEN w END) OVER () AS DOUBLE) END AS target
  FROM c),
p AS (
  SELECT *, CASE WHEN z > 0 THEN CAST(floor(target / z) AS BIGINT) ELSE 0 END AS passes FROM t),
f AS (
  SELECT d.doc_id, d.size, p.z, p.target, p.passes, greatest(0, CAST(round(target) AS BIGINT) - passes * z) AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(z AS BIGINT) AS source_size, target,
       CAST(passes * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM f
"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "start", "end", "edits", "item_chars")


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = substring.repeated_spans(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return spans.select(F.col("id").alias("doc_id"), F.col("first_id").alias("first_doc_id"), F.col("start").alias("start_byte"),
                        F.col("end").alias("end_byte"), "words")


@query("op5_minhash_near_dup")
def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bagminhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return rows.select(F.col("id").alias("doc_id"), "class_id", "class_size", "copies")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    model = quality.train(docs, trusted_positives(spark, sf_dir))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).select("doc_id", "n_tokens")


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_corpus.score_corpus(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), trusted_positives(spark, sf_dir))
    return scored.select(F.col("id").alias("doc_id"), "n_tokens", "target_loss", "background_loss", "score")


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.fingerprint_edits(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint.as_text("sketch").alias("fingerprint"),
                       fingerprint.as_text("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next")


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS bytes FROM pages),
h AS (SELECT html, max(page_id) AS head FROM p WHERE bytes >= 1000 GROUP BY html)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN head IS NULL OR page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM p LEFT JOIN h ON bytes >= 1000 AND p.html = h.html
"""


@query("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive_pages(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return rows.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


NEGATIVES_SQL = """
WITH p AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM p AS a JOIN p AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT pos.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s ON pos.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"])
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = hard_negatives.integer_points(vectors.withColumn("label", flipped))
    return hard_negatives.hard_negatives(points, F.col("id") % 100 == 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts of every tenth id (by crc32) from a word on repeated with a period of their own.

    ``h = crc32(id)``, ``g = h div 10``; where ``h % 10 = 0`` each word ``i`` from ``a = g % n`` on becomes word
    ``a + (i - a) % p``, ``p = 1 + (n - a) div (3 + g % 8)``. Null ids and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("w"))
    n = F.size("w")
    a = (F.col("g") % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
    unit = F.slice("w", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return rows.select("doc_id", F.when(n > 0, F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs.periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))
    # runs come by start, then period, so the first of equal exponent is the contract's
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (runs.withColumn("best", best)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def _license_sql() -> str:
    """The scan as regular expressions over the words, each with a blank after it."""
    base = [t for t in license_scan.TEMPLATES if t.base]
    found = ",\n         ".join(
        f"CASE WHEN regexp_matches(t, '(^| ){license_scan.as_regex(t.markup)}') "
        f"THEN {{'label': '{t.label}', 'm': {license_scan.mandatory_words(license_scan.parse(t.markup))}}} END" for t in license_scan.TEMPLATES)
    place = " OR ".join("(" + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(license_scan.tokens(t.markup))) + ")" for t in base)
    mine = ", ".join(f"CASE WHEN regexp_matches(t, '(^| ){license_scan.as_regex(t.markup)}') THEN '{t.label}' END" for t in base)
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{license_scan.WORD}') AS w FROM documents),
t AS (SELECT doc_id, w, array_to_string(w, ' ') || ' ' AS t, [i FOR i IN range(len(w)) IF {place}] AS places FROM d),
m AS (
  SELECT *, [x FOR x IN [{found}] IF x IS NOT NULL] AS found,
         [x FOR x IN [{mine}] IF x IS NOT NULL] AS base FROM t)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct([x.label FOR x IN found])), ','), '') AS labels,
       1 - pow(2.0, -coalesce(list_max([x.m FOR x IN found]), 0)) AS score
FROM m
"""


@query("op13_license_scan", _license_sql())
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.summary(license_scan.license_matches(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
