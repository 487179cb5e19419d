"""File sources (S1-S4, S7) on files the tests write themselves."""
import json
import os

from kestrel.sources import files


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def test_registry_csv_latin1_multiline(spark, scratch):
    p = os.path.join(scratch, "cosing.csv")
    _write(p, 'INCI name,Restriction,Function,COSING Ref No,Update Date\n'
              '"CRÈME, ACID",banned,"skin\nconditioning",1,01/02/2020\n'
              'NIACINAMIDE,,humectant,2,\n', encoding="latin-1")
    df = files.read_registry(spark, p)
    assert df.columns == ["inci_name", "regulatory_status", "function", "cosing_ref_no", "update_date"]
    rows = sorted(df.collect(), key=lambda r: r.cosing_ref_no)
    assert rows[0].inci_name == "CRÈME, ACID"
    assert rows[0].function == "skin\nconditioning"
    assert rows[1].regulatory_status is None


def test_abstracts_xml_first_pmid_first_abstract(spark, scratch):
    d = os.path.join(scratch, "text")
    xml = ("<PubmedArticleSet>"
           "<PubmedArticle><MedlineCitation><PMID>11</PMID><Article><Abstract>"
           "<AbstractText>Skin <i>barrier</i> repair</AbstractText><AbstractText>second</AbstractText>"
           "</Abstract></Article></MedlineCitation><CommentsCorrections><PMID>99</PMID></CommentsCorrections>"
           "</PubmedArticle>"
           "<PubmedArticle><MedlineCitation><Article><ArticleTitle>t</ArticleTitle></Article></MedlineCitation>"
           "</PubmedArticle>"
           "</PubmedArticleSet>")
    _write(os.path.join(d, "pubmed_azelaic_acid.xml"), xml)
    _write(os.path.join(d, "pubmed_kojic_acid.xml"),
           "<PubmedArticleSet><PubmedArticle><PMID>31</PMID><AbstractText>A &amp; B &nbsp;C & D &#233;"
           "</AbstractText></PubmedArticle></PubmedArticleSet>")
    _write(os.path.join(d, "notes.txt"), "<PubmedArticle><PMID>5</PMID></PubmedArticle>")
    rows = files.read_abstracts(spark, d).collect()
    assert len(rows) == 3
    by = {r.pmid: r for r in rows}
    assert by["31"].abstract == "A & B &nbsp;C & D é"          # malformed entities kept as text, no failure
    assert by["11"].abstract == "Skin barrier repair"
    assert by["11"].ingredient_term == "azelaic acid"
    assert by[None].abstract == ""


def test_reports_json_arrays_term_from_file(spark, scratch):
    d = os.path.join(scratch, "structured")
    recs = [{"safetyreportid": "1", "receivedate": "20240105", "patient": {"age": 40}},
            {"safetyreportid": "2", "receivedate": "20240106", "receiptdate": "20240107"}]
    _write(os.path.join(d, "openfda_vitamin_c_2024-02-01.json"), json.dumps(recs))
    _write(os.path.join(d, "_openfda_watermark.json"), json.dumps({"vitamin c": "2024-01-01"}))
    df = files.read_reports(spark, d)
    rows = sorted(df.collect(), key=lambda r: r.safetyreportid)
    assert [r.safetyreportid for r in rows] == ["1", "2"]
    assert {r.ingredient_term for r in rows} == {"vitamin c"}
    assert rows[1].receiptdate == "20240107"
    assert files.corrupt_report_files(df).count() == 0
    _write(os.path.join(d, "openfda_retinol_2024-02-01.json"), '[{"safetyreportid": "3", ')
    bad = files.corrupt_report_files(files.read_reports(spark, d)).collect()
    assert [r.source_file for r in bad] == ["openfda_retinol_2024-02-01.json"]
    assert files.read_reports(spark, d).filter("raw is not null").count() == 2


def test_product_pages_variant(spark, scratch):
    d = os.path.join(scratch, "pages")
    page = {"products": [{"code": "123", "image_front_url": "", "image_url": "u1", "categories": "face"},
                         {"image_front_url": "u2", "ingredients_text": "aqua, glycerin"}]}
    _write(os.path.join(d, "obf_face_page1.json"), json.dumps(page))
    rows = sorted(files.read_product_pages(spark, d).collect(), key=lambda r: r.product_code)
    assert [r.product_code for r in rows] == ["123", "unknown"]
    assert [r.image_url for r in rows] == ["u1", "u2"]
    assert rows[1].ingredients_text == "aqua, glycerin"


def test_media_manifests(spark, scratch):
    v = os.path.join(scratch, "youtube_manifest.csv")
    _write(v, 'video_id,title,published_at,query,has_caption,caption_path\n'
              'a1,"Hello, ""world""",2026-05-07T15:07:12Z,skincare review,False,\n'
              'b2,Plain,2023-03-03T06:36:33Z,skincare review,True,/c/b2.txt\n')
    df = files.read_media_manifest(spark, v, files.VIDEO_MANIFEST, "has_caption", "published_at")
    rows = {r.video_id: r for r in df.collect()}
    assert rows["a1"].title == 'Hello, "world"'
    assert rows["a1"].has_caption is False and rows["b2"].has_caption is True
    assert str(rows["a1"].published_at_ts) .startswith("2026-05-07 15:07:12")
    p = os.path.join(scratch, "podcast_manifest.csv")
    _write(p, 'show_name,episode_title,published,audio_path,download_ok\n'
              'Show,Ep 1,"Wed, 17 Jun 2026 05:00:00 GMT",/a/ep1.mp3,True\n'
              'Show,Ep 2,"Tue, 09 Jun 2026 05:00:00 +0000",/a/ep2.mp3,False\n')
    df = files.read_media_manifest(spark, p, files.PODCAST_MANIFEST, "download_ok", "published")
    ts = sorted(str(r.published_ts) for r in df.collect())
    assert ts[0].startswith("2026-06-09 05:00:00") and ts[1].startswith("2026-06-17 05:00:00")


def test_watermark_file_drives_replay_windows(spark, scratch):
    from pyspark.sql import functions as F
    from kestrel.operators import windows
    p = os.path.join(scratch, "structured", "_openfda_watermark.json")
    _write(p, json.dumps({"retinol": "2024-08-24", "arbutin": "2021-06-17", "bad": "soon"}))
    wm = files.read_watermark_file(spark, p)
    got = {r.source_name: (r.last_value, str(r.since) if r.since else None) for r in wm.collect()}
    assert got == {"retinol": ("2024-08-24", "2024-08-24"), "arbutin": ("2021-06-17", "2021-06-17"),
                   "bad": ("soon", None)}
    plan = windows.date_windows(
        wm.withColumn("since", windows.window_start_rule(F.col("source_name"), F.col("since"),
                                                         F.lit("2025-01-01").cast("date"), ())),
        "source_name", "since", "2025-01-01")
    counts = {r.source_name: r.n for r in plan.groupBy("source_name").agg(F.count("*").alias("n")).collect()}
    assert counts["retinol"] == 2 and counts["arbutin"] == 15 and counts["bad"] > 400   # 'bad' replays from 1900
