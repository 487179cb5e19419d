"""Registered queries: features (M1-M3, H15) and scalar string/date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import fda_to_iso, iso_to_fda, unify_dates
from ..functions.text import clean_tokens, html_title, slug, strip_markup
from ..operators import features
from ..operators.clean import drop_blank
from .fixtures import Views
from .oracle_views import WS, sql_strip, with_views
from .q_scoring import ABSTRACT_FEATURE_CTES, abstracts_processed_df
from .registry import query


# a document is a row: its number, not its id, tells it apart
TFIDF_CTES = {**ABSTRACT_FEATURE_CTES,
              "doc": "SELECT row_number() OVER () AS doc, pmid, toks FROM abs_tok",
              "tf": "SELECT doc, pmid, term, count(*) AS tf FROM (SELECT doc, pmid, unnest(toks) AS term FROM doc) GROUP BY ALL",
              "vocab": """SELECT term, df FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1)
                          WHERE df >= 2 ORDER BY total DESC, term LIMIT 2000""",
              "weights": """SELECT doc, pmid, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS tfidf FROM (
                              SELECT tf.doc, tf.pmid, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM abs_tok)) / (1 + v.df)) + 1) AS w
                              FROM tf JOIN vocab v ON v.term = tf.term)"""}


def _vectors(spark, sf_dir):
    """The non-blank abstracts' (pmid, idx, val) and their vocabulary; a document is a row."""
    texts = drop_blank(Views(spark, sf_dir).abstracts(), "abstract").select("pmid", "abstract")
    docs = features.spread(texts).select("pmid", clean_tokens("abstract").alias("tokens"))
    vocab = features.vocabulary(docs, "tokens")
    return features.tfidf_vectors(docs, "tokens", vocab, texts.count()), vocab


@query("tfidf_top_terms", with_views(
    """SELECT pmid, row_number() OVER (PARTITION BY doc ORDER BY tfidf DESC, term) AS rank, term, tfidf FROM weights""",
    "abstracts_v", extra=TFIDF_CTES))
def q_tfidf_top_terms(spark, sf_dir):
    vectors, vocab = _vectors(spark, sf_dir)
    return features.ranked_terms(vectors, ["pmid"], vocab)


@query("tfidf_weights", with_views("SELECT pmid, term, tfidf FROM weights", "abstracts_v", extra=TFIDF_CTES))
def q_tfidf_weights(spark, sf_dir):
    vectors, vocab = _vectors(spark, sf_dir)
    return features.ranked_terms(vectors, ["pmid"], vocab).select("pmid", "term", "tfidf")


@query("pca_covariance", """
WITH e AS (SELECT [coalesce(x, 0) FOR x IN CAST(embedding AS DOUBLE[])] AS e FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT max(len(e)) AS d FROM e),
p AS (SELECT row_number() OVER () AS r, e FROM (SELECT CASE WHEN embedding IS NULL THEN [] ELSE [coalesce(x, 0) FOR x IN CAST(embedding AS DOUBLE[])] END AS e
                                                FROM embeddings)),
x AS (SELECT r, i, coalesce(e[i + 1], 0) AS v FROM p, (SELECT unnest(range(d)) AS i FROM d))
SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS covariance FROM x AS a JOIN x AS b ON a.r = b.r AND a.i <= b.i GROUP BY a.i, b.i""")
def q_pca_covariance(spark, sf_dir):
    emb = Views(spark, sf_dir).table("embeddings", ["embedding"])
    dim = emb.select(F.max(F.size("embedding"))).first()[0]
    return features.covariance_entries(emb, "embedding", dim)


@query("pca_2d")
def q_pca_2d(spark, sf_dir):
    emb = Views(spark, sf_dir).table("embeddings", ["vec_id", "embedding", "label"])
    return features.pca_2d(emb, ["vec_id", "label"], "embedding")


@query("abstract_pca")
def q_abstract_pca(spark, sf_dir):
    docs = features.spread(drop_blank(Views(spark, sf_dir).abstracts(), "abstract").select("pmid", "abstract"))
    return features.tfidf_pca(docs.select("pmid", clean_tokens("abstract").alias("tokens")), "pmid", "tokens")


@query("mean_pool", """
SELECT label, CAST(pos - 1 AS BIGINT) AS pos, avg(CAST(x AS DOUBLE)) AS mean_value, count(*) AS n_frames
FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
GROUP BY label, pos""")
def q_mean_pool(spark, sf_dir):
    emb = Views(spark, sf_dir).table("embeddings", ["label", "embedding"])
    return features.mean_pool(emb, "label", "embedding")


@query("rms_normalise", """
SELECT vec_id, CAST(pos - 1 AS BIGINT) AS pos, x * 0.1 / (sqrt(ss / n) + 1e-9) AS value
FROM (SELECT vec_id, unnest(e) AS x, unnest(generate_series(1, len(e))) AS pos,
             list_sum(list_transform(e, lambda v: v * v)) AS ss, len(e) AS n
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))""")
def q_rms_normalise(spark, sf_dir):
    emb = Views(spark, sf_dir).table("embeddings", ["vec_id", "embedding"])
    return features.rms_rows(emb, "vec_id", "embedding")


def _sql_strip_markup(expr: str) -> str:
    out = expr
    out = f"regexp_replace({out}, '(?is)<script\\b[^>]*>.*?</script[^>]*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?is)<style\\b[^>]*>.*?</style[^>]*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<!--.*?-->', ' ', 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        out = f"replace({out}, '{ent}', '{ch}')"
    out = f"regexp_replace({out}, '{WS}+', ' ', 'g')"
    return sql_strip(out)


@query("strip_html", f"""
SELECT page_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT page_id, {_sql_strip_markup('html')} AS t FROM pages)""")
def q_strip_html(spark, sf_dir):
    pages = Views(spark, sf_dir).table("pages", ["page_id", "html"])
    t = pages.select("page_id", strip_markup("html").alias("text"))
    return t.withColumn("n_chars", F.length("text").cast("long"))


@query("slug", r"""
SELECT page_id, title, substr(regexp_replace(title, '[^\p{L}\p{N}]', '_', 'g'), 1, 60) AS slug
FROM (SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages)""")
def q_slug(spark, sf_dir):
    pages = Views(spark, sf_dir).table("pages", ["page_id", "html"])
    t = pages.select("page_id", html_title("html").alias("title"))
    return t.withColumn("slug", slug("title"))


@query("unify_dates", """
SELECT event_id, raw,
       CASE WHEN event_id % 3 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE date_trunc('second', ts) END AS unified,
       CASE WHEN event_id % 3 = 0 THEN strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS iso_date,
       CASE WHEN event_id % 3 = 0 THEN strftime(CAST(ts AS DATE), '%Y%m%d') END AS fda_date
FROM (SELECT event_id, ts,
             CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y%m%d')
                               WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                               ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') END AS raw
      FROM events)""")
def q_unify_dates(spark, sf_dir):
    ev = Views(spark, sf_dir).table("events", ["event_id", "ts"])
    m = F.col("event_id") % 3
    raw = (F.when(m == 0, F.date_format("ts", "yyyyMMdd"))
           .when(m == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .otherwise(F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))))
    t = ev.select("event_id", raw.alias("raw"))
    t = t.select("event_id", "raw", unify_dates("raw").cast("timestamp_ntz").alias("unified"),
                 fda_to_iso("raw").alias("iso_date"))
    return t.withColumn("fda_date", iso_to_fda("iso_date"))
