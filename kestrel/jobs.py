"""Batch jobs over a landing zone, in the order the original scripts run.

Each job takes the landed files that its ledger doesn't hold yet, runs
DataFrame operators and commits data, watermarks, ledger and rejects together
(``sinks.publish``) under one warehouse folder, so a failure leaves all of them
as they were and a rerun without new files opens no file and changes nothing.

    <raw>/registry.csv                 -> cosing_staging                          (K1 full load)
    <raw>/text/pubmed_*.xml            -> abstracts_processed, pubmed_evidence    (K2 incremental by id)
    <raw>/ids/pmids_<term>.txt         -> pubmed_evidence                         (K10 a watermark per term)
    <raw>/structured/openfda_*.json    -> adverse_events, reports_processed       (CD1/CD2 change capture)
    <raw>/structured/obf_*_page*.json  -> products_raw                            (K5 replace upsert)
    <raw>/audio_video/*.csv, captions  -> media_items; <raw>/images/manifest.csv -> image_items   (S7, J9, J11)
    then products + evidence scores, text coordinates, reports (CSV), the star schema and Q1-Q3.

Keyed tables are bucketed, so a load reads and rewrites the buckets of its own
keys only. What a load can't use (malformed files and articles, non-numeric ids,
implausible dates, missing ids) becomes rows of ``rejects``, committed with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.constants import DIM_DATE_FROM, DIM_DATE_TO
from .functions.dates import parse_fda_date
from .operators import cdc, clean, eda, features, keys, load, scoring
from .plans import star
from .sinks import fs, publish
from .sinks.publish import Change
from .sources import files

WATERMARKS, LEDGER, REJECTS = "etl_watermarks", "landed_files", "rejects"
WATERMARK_SCHEMA = "source_name string, last_value string"
LEDGER_SCHEMA = "source string, path string, length long, modified timestamp"
REJECT_SCHEMA = "source string, source_file string, record_pos long, record_key string, reason string, detail string"
EVENTS_SCHEMA = "safetyreportid string, ingredient_term string, receivedate date, raw_payload string, loaded_at timestamp"
EVIDENCE_SCHEMA = "pmid string, ingredient_term string, abstract_length long"
PROCESSED_SCHEMA = ("pmid string, abstract string, ingredient_term string, source_file string, file_offset long, row_no long, "
                    "clean_text string, abstract_length long")
REPORTS_SCHEMA = "safetyreportid string, receivedate string, receiptdate string, ingredient_term string, raw string"
PRODUCTS_SCHEMA = "product_code string, category string, ingredients_text string, image_url string, document string"


class Warehouse:
    """Published tables under one folder with one commit log, so a job's tables change together."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = publish.DEFAULT_BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.log = publish.CommitLog(spark, self.root)

    def exists(self, table: str) -> bool:
        return self.log.snapshot(table) is not None

    def read(self, table: str) -> DataFrame:
        return self.log.read(table)

    def read_or_empty(self, table: str, schema: str) -> DataFrame:
        return self.read(table) if self.exists(table) else self.spark.createDataFrame([], schema)

    def commit(self, changes: dict[str, Change], before_commit: Callable[[], None] | None = None) -> None:
        """All changes or none."""
        if not self.log.commit(changes, before_commit=before_commit):
            raise RuntimeError(f"publishing {', '.join(changes)} failed; the tables are unchanged")

    def publish(self, df: DataFrame, table: str, rules: str | None = None,
                partition_by: list[str] | None = None) -> None:
        self.commit({table: Change(df, rules=rules, partition_by=partition_by or ())})

    def watermarks(self) -> DataFrame:
        return self.read_or_empty(WATERMARKS, WATERMARK_SCHEMA)

    def watermark_change(self, updates: DataFrame) -> Change:
        return Change(load.set_watermarks(self.watermarks(), updates))

    def merge(self, table: str, batch: DataFrame, key: str, merge: Callable[[DataFrame], DataFrame], schema: str,
              rules: str | None = None, then_by: tuple[str, ...] = ()) -> Change:
        return publish.merge_by_key(self.log, table, batch, key, merge, schema, self.buckets, rules, then_by)

    def insert(self, table: str, batch: DataFrame, key: str, new_rows: Callable[[DataFrame], DataFrame], schema: str,
               rules: str | None = None) -> Change:
        return publish.insert_by_key(self.log, table, batch, key, new_rows, schema, self.buckets, rules)

    def append(self, table: str, df: DataFrame) -> Change:
        """Rows added to an unpartitioned table."""
        return Change(df, mode="insert" if self.exists(table) else "replace")

    def new_files(self, source: str, directory: str, pattern: str) -> DataFrame | None:
        """Landed files that no earlier run has loaded, as ledger rows; None when there are none.

        A file counts as loaded with its path, length and time, so one landed again under its name is new. No file is opened.
        """
        if not fs.exists(self.spark, directory):
            return None
        landed = files.landed_files(self.spark, directory, pattern)
        known = self.read_or_empty(LEDGER, LEDGER_SCHEMA).where(F.col("source") == source).drop("source")
        new = keys.materialize(landed.join(known, ["path", "length", "modified"], "left_anti")
                               .select(F.lit(source).alias("source"), "path", "length", "modified"))
        return new if new.limit(1).count() else None


def _paths(new_files: DataFrame) -> list[str]:
    """Paths for a reader, which takes them from the driver anyway: one string per new file."""
    return [r["path"] for r in new_files.select("path").collect()]


def rejected(source: str, rows: DataFrame, reason: Column | str, key: str | None = None, detail: str | None = None,
             pos: str = "record_pos") -> DataFrame:
    """Rows of ``rejects``; what they lack (position, key, detail) is null."""
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    return rows.select(F.lit(source).alias("source"), "source_file", F.col(pos).cast("long").alias("record_pos"), text(key).alias("record_key"),
                       (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), F.substring(text(detail), 1, 200).alias("detail"))


def with_landing_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """A sequence number per landed record: landing file (by name), then position in the file.

    Files are numbered with the distributed dense key over the distinct file
    names, so no row-level global sort is needed.
    """
    numbered = keys.dense_key(df.select("source_file").distinct(), ["source_file"], "_file_no")
    return df.join(numbered, "source_file").withColumn(
        out, F.col("_file_no") * F.lit(1 << 32) + F.col("record_pos")).drop("_file_no")


def load_registry(wh: Warehouse, csv_path: str, synonyms: DataFrame) -> None:
    """Registry CSV -> cleaned, standardised, first row per standard name -> full load."""
    # a multi-line CSV file is read whole by one task, so the id follows the file's row order;
    # with several files the file name orders first
    reg = files.read_registry(wh.spark, csv_path).withColumns({
        "_order": F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())})
    cleaned = clean.clean_registry(reg, synonyms, order="_order").drop("_order")
    wh.publish(publish.full_load_frame(cleaned, "inci_name"), "cosing_staging", rules="cosing_staging")


def load_abstracts(wh: Warehouse, text_dir: str, before_commit: Callable[[], None] | None = None) -> int:
    """New abstract XML -> features -> insert the PMIDs above the 'pubmed' watermark (K2); returns the new files.

    A file landed again replaces its own rows of ``abstracts_processed``.
    Rejects: files without an article, articles that don't parse, ids that are missing or not numeric.
    """
    new = wh.new_files("pubmed", text_dir, files.ABSTRACT_FILES)
    if new is None:
        return 0
    paths = _paths(new)
    records = keys.materialize(files.abstract_records(wh.spark, paths))
    processed = keys.materialize(clean.abstract_features(files.abstract_fields(records)))
    landed = records.select("source_file").distinct()
    numeric = processed.where(load.numeric_id("pmid").isNotNull())
    order = ["source_file", "file_offset", "row_no"]
    wm = load.watermark_value(wh.watermarks(), "pubmed")

    def absent(stored: DataFrame) -> DataFrame:
        batch = load.above_id_watermark(clean.drop_null_keys(numeric, "pmid"), "pmid", wm)
        return load.new_rows(stored, batch, "pmid", order).select("pmid", "ingredient_term", "abstract_length")

    changes = {
        "abstracts_processed": wh.merge("abstracts_processed", landed, "source_file", lambda stored: stored.join(landed, "source_file", "left_anti")
                                        .select(*processed.columns).unionByName(processed), PROCESSED_SCHEMA),
        "pubmed_evidence": wh.insert("pubmed_evidence", numeric, "pmid", absent, EVIDENCE_SCHEMA, "pubmed_evidence"),
        WATERMARKS: wh.watermark_change(numeric.agg(F.lit("pubmed").alias("source_name"), F.greatest(
            F.max(load.numeric_id("pmid")), wm.cast("long")).cast("string").alias("last_value")).where("last_value IS NOT NULL")),
        LEDGER: wh.append(LEDGER, new),
        REJECTS: wh.append(REJECTS, rejected("pubmed", files.malformed_abstracts(records), F.col("reason"), None, "detail", "file_offset").unionByName(
            rejected("pubmed", processed.where(load.numeric_id("pmid").isNull()),
                     F.when(F.col("pmid").isNull(), "id missing").otherwise("id not numeric"), "pmid", "abstract", "file_offset"))),
    }
    wh.commit(changes, before_commit)
    return len(paths)


def load_ids_per_term(wh: Warehouse, id_dir: str, total_length: int = 1000) -> int:
    """The per-term batch (K10, P9, K4): ids above their own term's watermark, the term's length shared out over them,
    inserted into ``pubmed_evidence`` if absent; every term's watermark moves in the same commit. Returns the new files."""
    new = wh.new_files("pmids", id_dir, files.ID_FILES)
    if new is None:
        return 0
    paths = _paths(new)
    ids = keys.materialize(files.read_id_lists(wh.spark, paths).withColumn("source_file", F.col("seq.file_name")))
    above = load.incremental_by_key(ids, wh.watermarks(), "ingredient_term", "pmid")
    batch = keys.materialize(clean.allocate_length(above.withColumn("response_len", F.lit(total_length)), "pmid", "ingredient_term", "response_len", "seq"))
    changes = {
        "pubmed_evidence": wh.insert("pubmed_evidence", batch, "pmid", lambda stored: load.new_rows(stored, batch, "pmid", ["ingredient_term", "seq"])
                                     .select("pmid", "ingredient_term", "abstract_length"), EVIDENCE_SCHEMA, "pubmed_evidence"),
        WATERMARKS: wh.watermark_change(load.next_key_watermarks(batch, "ingredient_term", "pmid")),
        LEDGER: wh.append(LEDGER, new),
        REJECTS: wh.append(REJECTS, rejected("pmids", load.non_numeric_ids(ids, "pmid"), "id not numeric", "pmid", None, "seq.file_block_start")),
    }
    wh.commit(changes)
    return len(paths)


def load_reports(wh: Warehouse, structured_dir: str, as_of: str, loaded_at: str | None = None) -> DataFrame:
    """New report JSON -> plausible dates -> change capture against the stored table -> publish.

    New ids are inserted, amended ones updated (with ``loaded_at``, by default the run date, as their load time), repeats judged against the
    record before them. ``reports_processed`` keeps the first record per id as text columns (P6, W1, P10).
    Returns this run's counts per class, all 0 without new files.
    """
    new = wh.new_files("openfda", structured_dir, files.REPORT_FILES)
    if new is None:
        return wh.spark.createDataFrame([(c, 0) for c in (cdc.INSERT, cdc.UPDATE, cdc.NOOP)], "change string, n long")
    raw = keys.materialize(with_landing_order(files.read_reports(wh.spark, _paths(new)).withColumn(
        "record_pos", F.coalesce("record_pos", F.lit(0)))).withColumn("raw_payload", F.to_json("raw")))
    read = raw.where("raw IS NOT NULL")
    known = read.where(F.col("safetyreportid").isNotNull() & (F.col("safetyreportid") != ""))
    batch = clean.plausible_dates(known, "receivedate", as_of, "_parsed")
    n_batch = batch.count()
    loaded_at = loaded_at or f"{as_of} 00:00:00"
    classes = []

    def merge(stored: DataFrame) -> DataFrame:
        classified = keys.materialize(cdc.cdc_classify(stored, batch.select(
            "seq", "safetyreportid", "ingredient_term", "receivedate", "receiptdate", "raw_payload"), expected_keys=n_batch))
        classes.append(classified)
        return cdc.cdc_apply(stored, classified, payload="raw_payload", loaded_at=loaded_at, expected_keys=n_batch).drop("last_change_seq")

    text = clean.stringify(known.select("safetyreportid", "receivedate", "receiptdate", "ingredient_term", "raw", "seq"))
    first = clean.clean_reports(text.withColumn("seq", F.col("seq").cast("long")), as_of).select(
        "safetyreportid", "receivedate", "receiptdate", "ingredient_term", "raw")
    bad_date = known.withColumn("_d", parse_fda_date("receivedate")).where(F.col("_d").isNull() | (F.col("_d") > F.lit(as_of).cast("date")))
    changes = {
        # by bucket of the id, then by date: date-range reads (backfills, windows) prune whole folders
        "adverse_events": wh.merge("adverse_events", batch, "safetyreportid", merge, EVENTS_SCHEMA, "adverse_events", ("receivedate",)),
        "reports_processed": wh.insert("reports_processed", first, "safetyreportid", lambda stored: load.new_rows(
            stored, first, "safetyreportid", ["safetyreportid"]).select(*first.columns), REPORTS_SCHEMA),
        LEDGER: wh.append(LEDGER, new),
        REJECTS: wh.append(REJECTS, rejected("openfda", raw.where("raw IS NULL"), "file not a JSON array").unionByName(
            rejected("openfda", read.where("safetyreportid IS NULL OR safetyreportid = ''"), "id missing", None, "raw_payload")).unionByName(
            rejected("openfda", bad_date, F.when(F.col("_d").isNull(), "date missing or unparseable").otherwise("date in the future"),
                     "safetyreportid", "receivedate"))),
    }
    newest = load.max_date_watermark(classes[0].withColumn("_src", F.lit("openfda")), "_src", "modified")
    old = load.watermark_value(wh.watermarks(), "openfda")
    changes[WATERMARKS] = wh.watermark_change(newest.withColumn("last_value", F.greatest("last_value", old)))
    counts = cdc.cdc_counts(classes[0]).collect()       # three rows
    wh.commit(changes)
    return wh.spark.createDataFrame(counts, "change string, n long")


def backfill_events(wh: Warehouse, from_date: str, to_date: str, table: str = "adverse_events_backfill") -> DataFrame:
    """B1 over the published events: the date range (both ends midnight, inclusive) republished as its own
    table. The range filter reaches the scan as a partition filter on ``receivedate``."""
    window = cdc.backfill(wh.read("adverse_events"), "receivedate", from_date, to_date).drop("backfill_ts")
    wh.publish(window, table, rules="adverse_events")
    return wh.read(table)


def load_product_pages(wh: Warehouse, structured_dir: str) -> int:
    """New product pages -> one document per key (the code, else a hash of the document); the last wins. Returns the new files."""
    new = wh.new_files("obf", structured_dir, files.PAGE_FILES)
    if new is None:
        return 0
    paths = _paths(new)
    read = files.read_product_pages(wh.spark, paths, with_malformed=True).withColumn("record_pos", F.coalesce("record_pos", F.lit(0)))
    pages = keys.materialize(with_landing_order(read))
    doc = F.to_json("product")
    docs = pages.where("product IS NOT NULL").select(
        load.document_key(F.try_variant_get("product", "$.code", "string"), doc).alias("product_code"),
        "category", "ingredients_text", "image_url", doc.alias("document"), "seq")
    wh.commit({
        "products_raw": wh.merge("products_raw", docs, "product_code", lambda stored: load.replace_upsert(stored, docs, "product_code", "seq"),
                                 PRODUCTS_SCHEMA),
        LEDGER: wh.append(LEDGER, new),
        REJECTS: wh.append(REJECTS, rejected("obf", pages.where("product IS NULL"), "page without a product list")),
    })
    return len(paths)


def load_media(wh: Warehouse, raw_dir: str) -> None:
    """Media inventories (S7): videos with their captions and podcast episodes -> ``media_items``; the image inventory
    against the image files at hand -> ``image_items``. Inventories are appended to by the extractor, so each is read whole;
    the first row per item counts. Absent inventories leave their table out."""
    spark, av, images = wh.spark, f"{raw_dir.rstrip('/')}/audio_video", f"{raw_dir.rstrip('/')}/images"
    order = F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())
    items = []
    if fs.exists(spark, f"{av}/youtube_manifest.csv"):
        videos = files.read_media_manifest(spark, f"{av}/youtube_manifest.csv", files.VIDEO_MANIFEST, "has_caption", "published_at")
        first = load.first_per_key(clean.drop_null_keys(videos.withColumn("_o", order), "video_id"), "video_id", ["_o"])
        captions = files.read_captions(spark, av)
        items.append(first.join(captions, "video_id", "left").select(
            F.lit("video").alias("kind"), F.col("video_id").alias("item"), "title", F.col("published_at_ts").alias("published"),
            (F.coalesce("has_caption", F.lit(False)) & F.col("transcript").isNotNull() & (F.col("transcript") != "")).alias("has_transcript"),
            F.coalesce("transcript_len", F.lit(0).cast("long")).alias("transcript_len")))
    if fs.exists(spark, f"{av}/podcast_manifest.csv"):
        episodes = files.read_media_manifest(spark, f"{av}/podcast_manifest.csv", files.PODCAST_MANIFEST, "download_ok", "published")
        first = load.first_per_key(clean.drop_null_keys(episodes.withColumn("_o", order).where("download_ok"), "audio_path"), "audio_path", ["_o"])
        items.append(first.select(F.lit("podcast").alias("kind"), F.col("audio_path").alias("item"), F.col("episode_title").alias("title"),
                                  F.col("published_ts").alias("published"), F.lit(False).alias("has_transcript"), F.lit(0).cast("long").alias("transcript_len")))
    changes = {}
    if items:
        changes["media_items"] = Change(items[0] if len(items) == 1 else items[0].unionByName(items[1]))
    if fs.exists(spark, f"{images}/manifest.csv"):
        listed = load.first_per_key(clean.drop_null_keys(files.read_image_manifest(spark, f"{images}/manifest.csv").withColumn("_o", order),
                                                         "product_code"), "product_code", ["_o"])
        there = files.landed_files(spark, images, files.IMAGE_FILES).select(F.regexp_extract("path", r"([^/]*)\.jpg$", 1).alias("product_code")).distinct()
        changes["image_items"] = Change(listed.join(there.withColumn("_there", F.lit(True)), "product_code", "left").select(
            "product_code", "category", (F.coalesce("image_ok", F.lit(False)) & F.col("_there").isNotNull()).alias("available")))
    if changes:
        wh.commit(changes)


def score(wh: Warehouse, synonyms: DataFrame) -> None:
    """Products with their risk scores (D9) and the evidence score per ingredient term (A1)."""
    registry = wh.read("cosing_staging")
    labels = wh.read("products_raw").select("product_code", "category", F.col("ingredients_text").alias("label_text"))
    risk = scoring.product_risk(labels, registry, synonyms)
    wh.publish(risk, "product_risk")
    wh.commit({"products": Change(star.products_staging(labels, wh.read("product_risk"))),
               "evidence_scores": Change(scoring.evidence_scores(wh.read("abstracts_processed")))})


def project_abstracts(wh: Warehouse) -> None:
    """The processed abstracts' two principal components of TF-IDF (M1, M2) -> ``abstract_coordinates``, over all abstracts."""
    texts = wh.read("abstracts_processed").select(F.struct("source_file", "file_offset", "row_no", "pmid", "ingredient_term").alias("doc"),
                                                  F.filter(F.split("clean_text", " "), lambda t: F.length(t) > 0).alias("tokens"))
    wh.publish(features.tfidf_pca(texts, "doc", "tokens").select("doc.*", "pca_x", "pca_y"), "abstract_coordinates")


def write_reports(wh: Warehouse) -> None:
    """EDA reports as CSV files: missingness of every source at hand, top keywords, length histogram, match check, rejects per reason."""
    proc = wh.read("abstracts_processed")
    tokens = proc.select(F.explode(F.split("clean_text", " ")).alias("token")).filter(F.length("token") > 0)
    sources = [eda.source_summary(proc, "pubmed_text", F.col("pmid").isNull())]
    if wh.exists("image_items"):
        images = wh.read("image_items")
        sources.append(eda.broken_share(images, images.where("available"), "product_code").select(
            F.lit("obf_images").alias("source"), F.col("n_available").alias("n_rows"), F.col("pct_broken").alias("pct_missing_key_field")))
    if wh.exists("media_items"):
        media = wh.read("media_items")
        sources.append(eda.caption_coverage(media, media, "item", "has_transcript").select(
            F.lit("audio_video").alias("source"), F.col("n_items").alias("n_rows"),
            F.coalesce("pct_fallback", F.lit(0.0)).alias("pct_missing_key_field")))
    sources += [eda.source_summary(wh.read("cosing_staging"), "cosing", F.col("regulatory_status") == "unknown"),
                eda.source_summary(wh.read("adverse_events"), "openfda", F.col("safetyreportid").isNull())]
    reports = {
        "missingness_summary": eda.missingness_summary(sources),
        "top_keywords": eda.top_k_counts(tokens, "token"),
        "length_histogram": eda.length_histogram(proc, "abstract_length"),
        "cross_source_check": scoring.match_check(
            wh.read("products_raw").select("product_code", F.col("ingredients_text").alias("label_text")),
            wh.read("cosing_staging")),
        "rejects": wh.read_or_empty(REJECTS, REJECT_SCHEMA).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_records")).orderBy("source", "reason"),
    }
    for name, df in reports.items():
        publish.write_report(df, f"{wh.root}/reports/{name}")


# dimension: (key map, its member column, its key column)
KEY_MAPS = {"dim_ingredient": ("keys_ingredient", "inci_name_std", "ingredient_key"),
            "dim_product": ("keys_product", "product_code", "product_key"),
            "dim_reporter": ("keys_reporter", "reporter_country", "reporter_key")}


def extend_keys(wh: Warehouse, members: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Number the members that the key maps lack (one commit for all dimensions); returns the key map per dimension.

    A member keeps its key through all later loads, also if it is absent from some.
    """
    changes = {}
    for dim, df in members.items():
        table, member, key = KEY_MAPS[dim]
        known = wh.read_or_empty(table, f"{key} long, {member} string")
        changes[table] = wh.append(table, keys.new_members(df, known, member, key))
    wh.commit(changes)
    return {dim: wh.read(KEY_MAPS[dim][0]) for dim in members}


def build_star(wh: Warehouse, synonyms: DataFrame, run_date: str, date_from: str = DIM_DATE_FROM, date_to: str = DIM_DATE_TO) -> None:
    """Dimensions and facts from the published staging tables; foreign keys by left joins.

    Surrogate keys come from lasting key maps. The calendar covers ``date_from`` to ``date_to``; dates outside
    have a null key and are counted with the other unresolved keys in ``star_missing_keys``.
    """
    events = wh.read("adverse_events")
    country = F.try_variant_get(F.try_parse_json("raw_payload"), "$.occurcountry", "string")
    reporters = events.select(country.alias("reporter_country"), F.lit(None).cast("string").alias("region")).filter(F.col("reporter_country").isNotNull())
    maps = extend_keys(wh, {"dim_ingredient": wh.read("cosing_staging"), "dim_product": wh.read("products"), "dim_reporter": reporters})
    dim_date = star.dim_date_range(wh.spark, date_from, date_to)
    dim_ing = star.dim_ingredient(wh.read("cosing_staging"), maps["dim_ingredient"])
    dim_prod = star.dim_product(wh.read("products"), key_map=maps["dim_product"])
    dim_rep = star.dim_reporter(reporters, maps["dim_reporter"])
    wh.commit({name: Change(df) for name, df in (("dim_date", dim_date), ("dim_ingredient", dim_ing), ("dim_product", dim_prod),
                                                 ("dim_reporter", dim_rep), ("dim_source", star.dim_source(wh.spark)))})
    dim_date, dim_ing = wh.read("dim_date"), wh.read("dim_ingredient")
    ing_key = dim_ing.select(F.col("inci_name_std").alias("_std"), "ingredient_key")

    def by_term(df: DataFrame) -> DataFrame:
        std = clean.standardise(df, "ingredient_term", synonyms, "_std")
        return std.join(ing_key, "_std", "left").drop("_std")

    serious = F.try_variant_get(F.try_parse_json("raw_payload"), "$.serious", "string") == "1"
    fact_events = (by_term(events).join(dim_date.select(F.col("full_date").alias("receivedate"), "date_key"), "receivedate", "left")
                   .withColumn("reporter_country", country)
                   .join(wh.read("dim_reporter").select("reporter_country", "reporter_key"), "reporter_country",
                         "left")
                   .select(F.xxhash64("safetyreportid").alias("event_key"), "date_key", "ingredient_key",
                           star.source_key("openFDA").alias("source_key"), "reporter_key", "safetyreportid",
                           serious.alias("is_serious"), F.lit(1).cast("int").alias("event_count")))
    scores = wh.read("evidence_scores").select("ingredient_term", "evidence_score")
    fact_evidence = (by_term(wh.read("pubmed_evidence")).join(scores, "ingredient_term", "left")
                     .select(F.xxhash64("pmid").alias("evidence_key"), F.lit(None).cast("int").alias("date_key"),
                             "ingredient_key", star.source_key("PubMed").alias("source_key"), "pmid",
                             F.col("abstract_length").cast("int").alias("abstract_length"),
                             F.col("evidence_score").cast("decimal(5,4)").alias("evidence_score")))
    fact_risk = star.fact_product_risk(wh.read("product_risk"), wh.read("dim_product"), dim_date, run_date)
    facts = ("fact_safety_event", "fact_ingredient_evidence", "fact_product_risk")
    wh.commit({name: Change(df) for name, df in zip(facts, (fact_events, fact_evidence, fact_risk))})
    wh.publish(star.missing_keys({name: wh.read(name) for name in facts}), "star_missing_keys")


def olap(wh: Warehouse) -> dict[str, DataFrame]:
    """Rows per staging table, then Q1-Q3 over the published star schema (Q3 in both forms)."""
    ing, dt = wh.read("dim_ingredient"), wh.read("dim_date")
    events, evidence = wh.read("fact_safety_event"), wh.read("fact_ingredient_evidence")
    staged = ("cosing_staging", "pubmed_evidence", "adverse_events", "products", "etl_watermarks")
    return {
        "table_row_counts": eda.table_row_counts({t: wh.read(t) for t in staged if wh.exists(t)}),
        "q1_events_by_ingredient_year": star.q1_events_by_ingredient_year(events, ing, dt),
        "q2_high_risk_products": star.q2_high_risk_products(wh.read("fact_product_risk"), wh.read("dim_product")),
        "q3_drill_across": star.q3_drill_across(ing, events, evidence),
        "q3_as_written": star.q3_as_written(ing, events, evidence),
    }


def run_all(spark: SparkSession, raw_dir: str, warehouse_dir: str, run_date: str,
            synonyms: DataFrame | None = None, buckets: int = publish.DEFAULT_BUCKETS) -> dict[str, DataFrame]:
    """Every job in order; returns the OLAP answers (lazy DataFrames over the published star).

    ``buckets`` lays out the keyed tables when they are first published (about their bytes / 1 GB).
    """
    syn = synonyms if synonyms is not None else clean.synonym_table(spark)
    wh, raw = Warehouse(spark, warehouse_dir, buckets), raw_dir.rstrip("/")
    load_registry(wh, f"{raw}/registry.csv", syn)
    load_abstracts(wh, f"{raw}/text")
    load_ids_per_term(wh, f"{raw}/ids")
    load_reports(wh, f"{raw}/structured", run_date)
    load_product_pages(wh, f"{raw}/structured")
    load_media(wh, raw)
    score(wh, syn)
    project_abstracts(wh)
    write_reports(wh)
    build_star(wh, syn, run_date)
    wh.log.expire()
    return olap(wh)


def main(argv: list[str] | None = None) -> None:
    """python -m kestrel.jobs RAW_DIR WAREHOUSE_DIR RUN_DATE — run every job, print the OLAP answers."""
    import sys

    from .session import build_session

    args = argv if argv is not None else sys.argv[1:]
    if len(args) != 3:
        raise SystemExit("usage: python -m kestrel.jobs RAW_DIR WAREHOUSE_DIR RUN_DATE(yyyy-MM-dd)")
    spark = build_session(app_name="kestrel-jobs")
    for name, df in run_all(spark, args[0], args[1], args[2]).items():
        print(f"== {name}")
        df.show(20, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
