"""DuckDB versions of the fixture views, as CTEs for ``oracle_sql()``.

Written from the view definitions (FIXTURES.md), independently of the Spark
plans. ``with_views(sql, names)`` prepends the CTEs a query needs, in
dependency order.
"""

from __future__ import annotations

from ..functions.constants import STOPWORDS

VIEW_SQL: dict[str, str] = {
    "registry_v": """
SELECT p_partkey AS cosing_ref_no,
       CASE WHEN p_partkey % 5 = 0 THEN upper(p_name)
            WHEN p_partkey % 7 = 0 THEN concat(' ', p_name, ' ') ELSE p_name END AS inci_name,
       CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS function,
       CASE p_type WHEN 'PROMO' THEN 'banned' WHEN 'ECONOMY' THEN 'restricted'
                   WHEN 'STANDARD' THEN 'allowed' WHEN 'LARGE' THEN 'see annex'
                   WHEN 'SMALL' THEN 'unknown' ELSE NULL END AS regulatory_status
FROM part""",
    "abstracts_v": """
SELECT CAST(doc_id AS VARCHAR) AS pmid, source AS ingredient_term, text AS abstract FROM documents
UNION ALL
SELECT CAST(-1 - doc_id AS VARCHAR), source, '  ' FROM documents WHERE doc_id % 37 = 0""",
    "reports_v": """
SELECT event_id AS seq,
       CAST(event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS VARCHAR) AS safetyreportid,
       event_type AS ingredient_term,
       replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '') AS receivedate,
       props AS raw_payload, ts AS src_ts, value AS src_value
FROM events
UNION ALL
SELECT -1 - 2 * event_id, '', event_type, replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', ''), props, ts, value
FROM events WHERE event_id % 101 = 0
UNION ALL
SELECT -2 - 2 * event_id, CAST(-2 - 2 * event_id AS VARCHAR), event_type, 'garbage', props, ts, value
FROM events WHERE event_id % 50 = 0""",
    "stored_v": """
SELECT safetyreportid, ingredient_term, receivedate FROM reports_v
WHERE seq % 4 <> 0 AND seq % 10 <> 9 AND safetyreportid <> ''""",
    "incoming_v": """
SELECT r.seq, r.safetyreportid, r.ingredient_term, r.receivedate,
       CASE WHEN r.seq % 5 = 0
            THEN replace(CAST(CAST(r.src_ts AS DATE) + 1 AS VARCHAR), '-', '') END AS receiptdate
FROM reports_v r WHERE r.seq % 3 <> 0""",
    "safety_v": """
SELECT event_id, CAST(ts AS DATE) AS full_date,
       event_id % (SELECT greatest(count(*), 1) FROM part) AS cosing_ref_no,
       user_id % 25 AS n_nationkey, event_type = 'error' AS is_serious
FROM events""",
    "labels_text_v": """
SELECT o_orderkey AS product_code, o_orderpriority AS category,
       CASE WHEN o_orderkey % 2 = 0 THEN label ELSE replace(label, ', ', chr(10)) END AS label_text
FROM (SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderkey % 19 = 0 THEN items || ', unlisted blend' ELSE items END AS label
      FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(p_name, ', ' ORDER BY l_linenumber, l_partkey) AS items
                             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) x
           ON l_orderkey = o_orderkey)
UNION ALL
SELECT -1 - o_orderkey, o_orderpriority, ' ' FROM orders WHERE o_orderkey % 23 = 0""",
    "synonyms_v": """
SELECT * FROM (VALUES ('hot plate','red plate'), ('small widget','red widget'), ('hot ring','small ring'),
                      ('blue bolt','red bolt'), ('large rod','small rod'), ('red gear','blue gear'))
     t(common_name, std_name)""",
    "evidence_v": """
SELECT CAST(doc_id AS VARCHAR) AS pmid, doc_id % (SELECT greatest(count(*), 1) FROM part) AS cosing_ref_no
FROM documents""",
    "reporter_v": """
SELECT n_nationkey, n_name AS reporter_country, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "transcripts_v": """
SELECT conv_id, max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) = 1 AS captioned
FROM conversations GROUP BY conv_id""",
    "manifest_v": """
SELECT doc_id AS product_code, source AS category FROM documents""",
    "available_v": """
SELECT doc_id AS product_code FROM labels""",
}

VIEW_DEPS: dict[str, list[str]] = {
    "stored_v": ["reports_v"],
    "incoming_v": ["reports_v"],
}

# Python's white space, spelled out for RE2 (same class as the Spark side).
WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def sql_strip(expr: str) -> str:
    """DuckDB: strip Python white space at both ends."""
    return f"regexp_replace(regexp_replace({expr}, '^{WS}+', ''), '{WS}+$', '')"


def stopword_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS) + "]"


def sql_clean_tokens(expr: str) -> str:
    """DuckDB: letters-only lower-case tokens of 3+ characters, stop-words removed."""
    return (f"list_filter(regexp_extract_all(lower({expr}), '[a-z]{{3,}}'), "
            f"lambda t: NOT list_contains({stopword_list()}, t))")


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prepend the CTEs ``names`` (plus their dependencies) and ``extra`` CTEs."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEW_SQL[n].strip()})" for n in ordered]
    parts += [f"{k} AS ({v.strip()})" for k, v in (extra or {}).items()]
    if not parts:
        return sql.strip()
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()
