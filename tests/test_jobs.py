"""The batch jobs end to end on a small landing zone written by the test."""
import json
import os

from kestrel import jobs


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def _landing(raw):
    _write(os.path.join(raw, "registry.csv"),
           "INCI name,Restriction,Function,COSING Ref No\n"
           "RETINOL,restricted,skin conditioning,1\n"
           "Ascorbic Acid,allowed,antioxidant,2\n"
           "HYDROQUINONE,banned,bleaching,3\n"
           " retinol ,allowed,duplicate,4\n"
           "Crème X,,\"multi\nline\",5\n", encoding="latin-1")
    article = ("<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Abstract><AbstractText>{text}"
               "</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>")
    _write(os.path.join(raw, "text", "pubmed_retinol.xml"), "<PubmedArticleSet>" + "".join(
        article.format(pmid=p, text=t) for p, t in [(11, "Retinol improves skin texture in trials."),
                                                     (12, "Topical retinol and skin irritation."),
                                                     (13, "   ")]) + "</PubmedArticleSet>")
    _write(os.path.join(raw, "text", "pubmed_vitamin_c.xml"), "<PubmedArticleSet>" + article.format(
        pmid=21, text="Vitamin C serum stability and skin brightening.") + "</PubmedArticleSet>")
    reports = {
        "openfda_retinol_2024-01-10.json": [
            {"safetyreportid": "100", "receivedate": "20240102", "serious": "1", "occurcountry": "US"},
            {"safetyreportid": "101", "receivedate": "20240103", "serious": "2", "occurcountry": "FR"},
            {"safetyreportid": "101", "receivedate": "20240103", "receiptdate": "20240105"}],
        "openfda_vitamin_c_2024-01-10.json": [
            {"safetyreportid": "200", "receivedate": "20240104", "occurcountry": "US"},
            {"safetyreportid": "201", "receivedate": "29990101"}],
    }
    for name, recs in reports.items():
        _write(os.path.join(raw, "structured", name), json.dumps(recs))
    pages = {"obf_face_page1.json": {"products": [
                {"code": "p1", "categories": "face", "ingredients_text": "Aqua, Retinol\nVitamin C"},
                {"code": "p2", "categories": "face", "ingredients_text": "hydroquinone, hydroquinone"}]},
             "obf_face_page2.json": {"products": [
                {"code": "p1", "categories": "face", "ingredients_text": "Aqua, Retinol"},
                {"categories": "body", "ingredients_text": " "}]}}
    for name, page in pages.items():
        _write(os.path.join(raw, "structured", name), json.dumps(page))


def test_run_all_and_rerun(spark, scratch):
    raw, wh_dir = os.path.join(scratch, "raw"), os.path.join(scratch, "warehouse")
    _landing(raw)
    answers = jobs.run_all(spark, raw, wh_dir, "2024-01-25", buckets=3)
    wh = jobs.Warehouse(spark, wh_dir, buckets=3)

    reg = {r.inci_name_std: r for r in wh.read("cosing_staging").collect()}
    assert set(reg) == {"retinol", "ascorbic acid", "hydroquinone", "crème x"}
    assert reg["retinol"].regulatory_status == "restricted"          # first row in the file wins
    assert reg["crème x"].regulatory_status == "unknown"
    assert sorted(r.pmid for r in wh.read("pubmed_evidence").collect()) == ["11", "12", "21"]
    events = {r.safetyreportid: r for r in wh.read("adverse_events").collect()}
    assert set(events) == {"100", "101", "200"}                      # the future-dated report is dropped
    assert str(events["101"].receivedate) == "2024-01-05"           # amended inside the batch
    assert events["200"].ingredient_term == "vitamin c"
    prods = {r.product_code: r for r in wh.read("products").collect()}
    assert prods["p1"].ingredients_text == "Aqua, Retinol"           # the later page replaced the document
    assert abs(prods["p2"].risk_score - 1.0) < 1e-12                 # banned twice
    assert len(prods) == 3 and [k for k in prods if k not in ("p1", "p2")][0].__len__() == 64  # sha-256 key
    counts = {r.table_name: r.n_rows for r in answers["table_row_counts"].collect()}
    assert counts == {"cosing_staging": 4, "pubmed_evidence": 3, "adverse_events": 3, "products": 3,
                      "etl_watermarks": 2}
    q1 = {(r.inci_name_std, r.year): r.events for r in answers["q1_events_by_ingredient_year"].collect()}
    assert q1 == {("retinol", 2024): 2, ("ascorbic acid", 2024): 1}
    q3 = {r.inci_name_std: r.total_adverse_events for r in answers["q3_drill_across"].collect()}
    assert q3["retinol"] == 2 and q3["hydroquinone"] is None
    q3w = {r.inci_name_std: r.total_adverse_events for r in answers["q3_as_written"].collect()}
    assert q3w["retinol"] == 4                                         # 2 events x 2 evidence rows
    fact = wh.read("fact_safety_event")
    # 101's stored payload is its amendment (no country), so two events have a reporter
    assert fact.filter("reporter_key IS NOT NULL").count() == 2 and fact.filter("is_serious").count() == 1
    assert str(events["101"].loaded_at) == "2024-01-25 00:00:00"
    assert os.path.isdir(os.path.join(wh_dir, "reports", "top_keywords"))

    # the same landing files again: nothing new is loaded, every report is a no-op
    before = wh.read("pubmed_evidence").count()
    jobs.load_abstracts(wh, os.path.join(raw, "text"))
    assert wh.read("pubmed_evidence").count() == before
    counts = {r.change: r.n for r in jobs.load_reports(wh, os.path.join(raw, "structured"), "2024-01-25").collect()}
    assert counts == {"insert": 0, "update": 0, "noop": 0}              # no file is read again
    again = {r.safetyreportid: str(r.receivedate) for r in wh.read("adverse_events").collect()}
    assert again == {"100": "2024-01-02", "101": "2024-01-05", "200": "2024-01-04"}
    wm = {r.source_name: r.last_value for r in wh.read("etl_watermarks").collect()}
    assert wm == {"pubmed": "21", "openfda": "2024-01-05"}

    # backfill of a date range reads only the matching date folders
    from kestrel.operators import cdc
    window = cdc.backfill(wh.read("adverse_events"), "receivedate", "2024-01-02", "2024-01-04")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(receivedate" in plan
    assert sorted(r.safetyreportid for r in jobs.backfill_events(wh, "2024-01-02", "2024-01-04").collect()) == \
        ["100", "200"]
