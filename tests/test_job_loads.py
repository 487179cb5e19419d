"""The jobs' loads: splittable abstracts, rejects, reruns, one commit for data and watermarks, lasting keys, media, per-term batch."""
import json
import os

import pytest

from kestrel import jobs
from kestrel.operators import clean
from kestrel.sources import files

ARTICLE = "<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article><Abstract><AbstractText>{}</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text if isinstance(text, str) else json.dumps(text))


def xml(*articles):
    return "<?xml version='1.0'?><PubmedArticleSet>" + "".join(ARTICLE.format(p, t) for p, t in articles) + "</PubmedArticleSet>"


def rejects(wh):
    return sorted(((r.source, r.source_file, r.record_key, r.reason) for r in wh.read("rejects").collect()), key=str)


def test_a_large_file_of_articles_is_read_by_several_tasks(spark, scratch):
    write(f"{scratch}/pubmed_retinol.xml", xml(*[(i, f"Text {i} of <i>mixed</i> content &amp; more, R&D") for i in range(400)]))
    write(f"{scratch}/pubmed_empty.xml", "<PubmedArticleSet></PubmedArticleSet>")
    write(f"{scratch}/pubmed_zero_bytes.xml", "")
    write(f"{scratch}/pubmed_cut.xml", xml((900, "whole"), (901, "cut short"))[:-80])
    write(f"{scratch}/pubmed_bad.xml", xml((910, "<b>open"), (911, "fine"), (911, "fine again")))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        records = files.abstract_records(spark, scratch)
        per_file = {r.source_file: r.n for r in records.selectExpr("source_file", "spark_partition_id() AS p", "file_offset AS o").distinct()
                    .groupBy("source_file").count().withColumnRenamed("count", "n").collect()}
        assert per_file["pubmed_retinol.xml"] > 3                            # several splits, and tasks
        rows = files.abstract_fields(records).where("ingredient_term = 'retinol'").orderBy("source_file", "file_offset", "row_no").collect()
        assert [r.pmid for r in rows] == [str(i) for i in range(400)]        # landing order is file order
        assert rows[7].abstract == "Text 7 of mixed content & more, R&D"
        other = {r.pmid for r in files.abstract_fields(records).where("ingredient_term <> 'retinol'").collect()}
        assert other == {"900", "911"}
        bad = sorted((r.source_file, r.reason) for r in files.malformed_abstracts(records).collect())
        assert bad == [("pubmed_bad.xml", "article not well-formed"), ("pubmed_cut.xml", "article not well-formed"), ("pubmed_empty.xml", "no article in the file")]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_abstract_load_rejects_reruns_and_rolls_back(spark, scratch):
    raw, wh = f"{scratch}/text", jobs.Warehouse(spark, f"{scratch}/wh", buckets=3)
    write(f"{raw}/pubmed_retinol.xml", xml((5, "first five here"), (3, "three words here"), (5, "second five here"), ("x7", "not numeric id"), ("", "without any id")))
    write(f"{raw}/pubmed_vitamin_c.xml", xml((5, "five in another file"), (8, "eight words here"), (9, "<b>broken")))
    write(f"{raw}/pubmed_none.xml", "<PubmedArticleSet/>")

    def boom():
        raise RuntimeError("simulated failure between data and watermark")

    with pytest.raises(RuntimeError):
        jobs.load_abstracts(wh, raw, before_commit=boom)
    assert wh.log.last_version() == 0                                        # data, watermark, ledger and rejects: none
    assert jobs.load_abstracts(wh, raw) == 3
    evidence = {r.pmid: r.ingredient_term for r in wh.read("pubmed_evidence").collect()}
    assert evidence == {"5": "retinol", "3": "retinol", "8": "vitamin c"}    # the first in landing order wins
    assert {r.source_name: r.last_value for r in wh.watermarks().collect()} == {"pubmed": "8"}
    assert rejects(wh) == sorted([
        ("pubmed", "pubmed_none.xml", None, "no article in the file"), ("pubmed", "pubmed_retinol.xml", "x7", "id not numeric"),
        ("pubmed", "pubmed_retinol.xml", None, "id missing"), ("pubmed", "pubmed_vitamin_c.xml", None, "article not well-formed")], key=str)
    version = wh.log.last_version()
    assert jobs.load_abstracts(wh, raw) == 0 and wh.log.last_version() == version     # a rerun opens no file
    write(f"{raw}/pubmed_zinc.xml", xml((4, "below the watermark"), (12, "above the watermark")))
    with pytest.raises(RuntimeError):
        jobs.load_abstracts(wh, raw, before_commit=boom)
    assert {r.pmid for r in wh.read("pubmed_evidence").collect()} == {"5", "3", "8"}
    assert {r.last_value for r in wh.watermarks().collect()} == {"8"}        # old data with the old watermark
    assert jobs.load_abstracts(wh, raw) == 1
    assert {r.pmid for r in wh.read("pubmed_evidence").collect()} == {"5", "3", "8", "12"}
    assert {r.last_value for r in wh.watermarks().collect()} == {"12"}
    n = wh.read("abstracts_processed").count()
    write(f"{raw}/pubmed_zinc.xml", xml((13, "landed again under its name")))           # replaces its own rows
    assert jobs.load_abstracts(wh, raw) == 1 and wh.read("abstracts_processed").count() == n - 1
    assert sorted(r.pmid for r in wh.read("abstracts_processed").where("source_file = 'pubmed_zinc.xml'").collect()) == ["13"]


def test_report_load_rejects_and_idle_rerun(spark, scratch):
    raw, wh = f"{scratch}/structured", jobs.Warehouse(spark, f"{scratch}/wh", buckets=3)
    write(f"{raw}/openfda_retinol_2024-01-10.json", [
        {"safetyreportid": "1", "receivedate": "20240102"}, {"safetyreportid": "2", "receivedate": "29990101"},
        {"safetyreportid": "3", "receivedate": "soon"}, {"receivedate": "20240102"}, {"safetyreportid": "", "receivedate": "20240102"},
        {"safetyreportid": "1", "receivedate": "20240102", "receiptdate": "20240104"}])
    write(f"{raw}/openfda_zinc_2024-01-10.json", "{broken")
    counts = {r.change: r.n for r in jobs.load_reports(wh, raw, "2024-02-01").collect()}
    assert counts == {"insert": 1, "update": 1, "noop": 0}
    assert sorted(r[3] for r in rejects(wh)) == [
        "date in the future", "date missing or unparseable", "file not a JSON array", "id missing", "id missing"]
    processed = wh.read("reports_processed").collect()
    assert [(r.safetyreportid, r.receivedate, json.loads(r.raw)["receivedate"]) for r in processed] == [("1", "20240102", "20240102")]
    version = wh.log.last_version()
    assert {r.n for r in jobs.load_reports(wh, raw, "2024-02-01").collect()} == {0} and wh.log.last_version() == version
    write(f"{raw}/openfda_retinol_2024-01-11.json", [{"safetyreportid": "1", "receivedate": "20240102", "receiptdate": "20240104"},
                                                     {"safetyreportid": "7", "receivedate": "20240106"}])
    counts = {r.change: r.n for r in jobs.load_reports(wh, raw, "2024-02-02").collect()}
    assert counts == {"insert": 1, "update": 0, "noop": 1}                   # only the new file was judged
    stored = {r.safetyreportid: (str(r.receivedate), str(r.loaded_at)[:10]) for r in wh.read("adverse_events").collect()}
    assert stored == {"1": ("2024-01-04", "2024-02-01"), "7": ("2024-01-06", "2024-02-02")}     # load time moves with a change only
    assert {r.source_name: r.last_value for r in wh.watermarks().collect()} == {"openfda": "2024-01-06"}


def test_pages_without_products_are_rejected(spark, scratch):
    raw, wh = f"{scratch}/structured", jobs.Warehouse(spark, f"{scratch}/wh", buckets=2)
    write(f"{raw}/obf_face_page1.json", {"products": [{"code": "p1", "ingredients_text": "Aqua"}, {"code": "p1", "ingredients_text": "Zinc"}]})
    write(f"{raw}/obf_face_page2.json", {"message": "no list"})
    write(f"{raw}/obf_face_page3.json", "[[[")
    assert jobs.load_product_pages(wh, raw) == 3
    assert [(r.product_code, r.ingredients_text) for r in wh.read("products_raw").collect()] == [("p1", "Zinc")]
    assert [r[1] for r in rejects(wh)] == ["obf_face_page2.json", "obf_face_page3.json"]
    assert jobs.load_product_pages(wh, raw) == 0


def test_per_term_batch(spark, scratch):
    raw, wh = f"{scratch}/ids", jobs.Warehouse(spark, f"{scratch}/wh", buckets=2)
    write(f"{raw}/pmids_retinol.txt", "11\n12\n 11 \n\nabc\n")
    write(f"{raw}/pmids_vitamin_c.txt", "12\n" + "\n".join(str(i) for i in range(100, 400)))
    assert jobs.load_ids_per_term(wh, raw) == 2
    rows = {r.pmid: (r.ingredient_term, r.abstract_length) for r in wh.read("pubmed_evidence").collect()}
    assert rows["11"] == ("retinol", 333) and rows["12"] == ("retinol", 333)        # 1000 over three rows; the first term's row wins
    assert rows["150"] == ("vitamin c", 5) and len(rows) == 302                  # at least 5
    marks = {r.source_name: r.last_value for r in wh.watermarks().collect()}
    assert marks == {"batch_retinol": "12", "batch_vitamin c": "399"}
    assert [(r[2], r[3]) for r in rejects(wh)] == [("abc", "id not numeric")]
    write(f"{raw}/pmids_retinol_b.txt", "9\n")
    write(f"{raw}/pmids_retinol.txt", "11\n12\n13\n")
    assert jobs.load_ids_per_term(wh, raw) == 2                                   # a new term and a file landed again
    rows = {r.pmid: (r.ingredient_term, r.abstract_length) for r in wh.read("pubmed_evidence").collect()}
    assert rows["13"] == ("retinol", 1000) and rows["9"] == ("retinol b", 1000) and len(rows) == 304
    assert jobs.load_ids_per_term(wh, f"{scratch}/nowhere") == 0


def test_media_inventories_and_missingness_of_all_sources(spark, scratch):
    wh = jobs.Warehouse(spark, f"{scratch}/wh", buckets=2)
    write(f"{scratch}/audio_video/youtube_manifest.csv", "video_id,title,published_at,query,has_caption,caption_path\n"
          'v1,"One, two",2026-05-07T15:07:12Z,q,True,x\nv2,Two,2023-03-03T06:36:33Z,q,False,\nv1,again,2026-05-07T15:07:12Z,q,True,x\nv3,Lost caption,2023-03-03T06:36:33Z,q,True,x\n')
    write(f"{scratch}/audio_video/v1_caption.txt", "some words said")
    write(f"{scratch}/audio_video/podcast_manifest.csv", "show_name,episode_title,published,audio_path,download_ok\n"
          'S,E1,"Wed, 17 Jun 2026 05:00:00 GMT",a.mp3,True\nS,E2,"Tue, 09 Jun 2026 05:00:00 GMT",b.mp3,False\n')
    write(f"{scratch}/images/manifest.csv", "product_code,category,image_path,ingredients_text,image_ok\np1,face,x,Aqua,True\np2,face,x,Aqua,True\np3,face,,Aqua,False\np1,face,x,Aqua,True\n")
    write(f"{scratch}/images/p1.jpg", "not decoded")
    write(f"{scratch}/images/p3.jpg", "not listed as ok")
    jobs.load_media(wh, scratch)
    media = {r["item"]: (r.kind, r.has_transcript, r.transcript_len, str(r.published)[:10]) for r in wh.read("media_items").collect()}
    assert media == {"v1": ("video", True, 15, "2026-05-07"), "v2": ("video", False, 0, "2023-03-03"), "v3": ("video", False, 0, "2023-03-03"),
                     "a.mp3": ("podcast", False, 0, "2026-06-17")}
    assert {r.product_code: r.available for r in wh.read("image_items").collect()} == {"p1": True, "p2": False, "p3": False}
    write(f"{scratch}/text/pubmed_zinc.xml", xml((1, "zinc text words"), ("", "no id")))
    write(f"{scratch}/structured/openfda_zinc_2024-01-10.json", [{"safetyreportid": "1", "receivedate": "20240102"}])
    write(f"{scratch}/structured/obf_face_page1.json", {"products": [{"code": "p1", "ingredients_text": "Aqua"}]})
    write(f"{scratch}/registry.csv", "INCI name,Restriction,Function\nZINC,allowed,x\nAQUA,,y\n")
    jobs.load_registry(wh, f"{scratch}/registry.csv", clean.synonym_table(spark))
    jobs.load_abstracts(wh, f"{scratch}/text")
    jobs.load_reports(wh, f"{scratch}/structured", "2024-02-01")
    jobs.load_product_pages(wh, f"{scratch}/structured")
    jobs.write_reports(wh)
    got = {r.source: (r.n_rows, r.pct_missing_key_field) for r in spark.read.option("header", True).option("inferSchema", True)
           .csv(f"{scratch}/wh/reports/missingness_summary").collect()}
    assert got == {"pubmed_text": (2, 50.0), "obf_images": (1, 66.7), "audio_video": (4, 75.0), "cosing": (2, 50.0), "openfda": (1, 0.0)}


def test_dimension_keys_last(spark, scratch):
    wh = jobs.Warehouse(spark, f"{scratch}/wh", buckets=2)
    syn = clean.synonym_table(spark)
    registry = "INCI name,Restriction,Function\n"
    pages = {"products": [{"code": c, "ingredients_text": "Zinc"} for c in ("m", "q")]}
    write(f"{scratch}/text/pubmed_zinc.xml", xml((1, "zinc text words")))

    def run(day, names, report):
        write(f"{scratch}/registry.csv", registry + "".join(f"{n},allowed,x\n" for n in names))
        write(f"{scratch}/structured/openfda_zinc_{day}.json", [report])
        write(f"{scratch}/structured/obf_face_page{day[-1]}.json", pages)
        jobs.load_registry(wh, f"{scratch}/registry.csv", syn)
        jobs.load_abstracts(wh, f"{scratch}/text")
        jobs.load_reports(wh, f"{scratch}/structured", "2031-02-01")
        jobs.load_product_pages(wh, f"{scratch}/structured")
        jobs.score(wh, syn)
        jobs.build_star(wh, syn, "2024-02-01")
        return [{r[1]: r[0] for r in wh.read(d).select(k, m).collect()} for d, (_, m, k) in jobs.KEY_MAPS.items()]

    first = run("2024-01-10", ["ZINC", "MICA"], {"safetyreportid": "1", "receivedate": "20240102", "occurcountry": "US"})
    assert [sorted(x.values()) for x in first] == [[1, 2], [1, 2], [1]]
    pages["products"].append({"code": "a", "ingredients_text": "Mica"})
    second = run("2024-01-11", ["ALOE", "ZINC"], {"safetyreportid": "2", "receivedate": "20310102", "occurcountry": "AT"})
    assert second[0] == {"zinc": first[0]["zinc"], "aloe": 3}                  # 'mica' left, its key isn't given away
    assert second[1] == {**first[1], "a": 3} and second[2] == {**first[2], "AT": 2}
    missing = {(r.fact, r.foreign_key): (r.n_rows, r.n_missing) for r in wh.read("star_missing_keys").collect()}
    assert missing[("fact_safety_event", "date_key")] == (2, 1)               # 2031 lies outside the calendar: counted
    assert missing[("fact_safety_event", "ingredient_key")] == (2, 0)
    wh.log.expire(keep=1)
    assert {r.inci_name_std: r.ingredient_key for r in wh.read("dim_ingredient").collect()} == second[0]
