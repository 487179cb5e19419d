"""Landing-file sources (S1-S4, S7, H7): raw CSV / XML / JSON as DataFrames.

Every reader is a Spark scan over a directory or glob, so files are read in
parallel by the executors; provenance comes from ``_metadata.file_name``.
Schemas are explicit (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import REGISTRY_RENAMES
from ..functions.dates import unify_dates
from ..functions.text import term_from_file
from ..operators.clean import normalise_columns
from ..sinks import fs

# Landing-file name patterns.
ABSTRACT_FILES = "pubmed_*.xml"
REPORT_FILES = "openfda_*.json"
PAGE_FILES = "obf_*_page*.json"
ID_FILES = "pmids_*.txt"
CAPTION_FILES = "*_caption.txt"
IMAGE_FILES = "*.jpg"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 CSV with a header (quoted fields may span lines); known columns
    renamed, then all names normalised (P1). Every column is read as text."""
    df = (spark.read.option("header", True).option("encoding", "ISO-8859-1").option("multiLine", True)
          .option("escape", '"').option("inferSchema", False).csv(path))
    renames = {k: v for k, v in REGISTRY_RENAMES.items() if k in df.columns}
    return normalise_columns(df.withColumnsRenamed(renames))


ARTICLE_END = "</PubmedArticle>"


def landed_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Landing files as (path, length, modified), without opening them."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def abstract_records(spark: SparkSession, paths: str | list[str], pattern: str = ABSTRACT_FILES) -> DataFrame:
    """One row per article of the XML files: ``source_file, file_offset, row_no, article, ok, ingredient_term``.

    The text source cuts the files at the article's end tag, so one large file is
    read by many tasks and no task holds more than an article.
    ``(source_file, file_offset, row_no)`` is the landing order: the start of the
    file's split, then the row within it. ``ok`` is false where the article is not well-formed
    (also a truncated last one); a file without any article has one row with a null ``article``.
    """
    parts = (spark.read.option("lineSep", ARTICLE_END).option("pathGlobFilter", pattern).text(paths)
             .select("value", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("file_offset"),
                     F.monotonically_increasing_id().alias("row_no")))
    body = F.nullif(F.regexp_extract("value", r"(?s)<PubmedArticle\b.*$", 0), F.lit(""))
    # an '&' that does not start an XML entity (an HTML entity, a bare ampersand) would make
    # the article unparseable: escape it, keeping the text literally
    article = F.regexp_replace(F.concat(body, F.lit(ARTICLE_END)), r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;")
    cut = parts.withColumn("article", article)
    found = cut.where("article IS NOT NULL").withColumn(
        "ok", F.from_xml("article", "_corrupt_record string", {"mode": "PERMISSIVE"})["_corrupt_record"].isNull())
    empty = (cut.groupBy("source_file").agg(F.count("article").alias("n")).where("n = 0")
             .select("source_file", F.lit(0).cast("long").alias("file_offset"), F.lit(0).cast("long").alias("row_no"),
                     F.lit(None).cast("string").alias("article"), F.lit(False).alias("ok")))
    return found.select(*empty.columns).unionByName(empty).withColumn("ingredient_term", term_from_file("source_file", "pubmed_"))


def abstract_fields(records: DataFrame) -> DataFrame:
    """The well-formed articles' ``pmid`` and ``abstract`` beside their landing order and term.

    XPath takes the first PMID and the first AbstractText anywhere in the
    article, mixed content joined. Absent abstract -> '', absent PMID -> null.
    """
    return records.where("ok").select(
        F.nullif(F.xpath_string("article", F.lit("(//PMID)[1]")), F.lit("")).alias("pmid"),
        F.coalesce(F.xpath_string("article", F.lit("(//AbstractText)[1]")), F.lit("")).alias("abstract"),
        "ingredient_term", "source_file", "file_offset", "row_no")


def malformed_abstracts(records: DataFrame) -> DataFrame:
    """Files without an article and articles that don't parse: ``source_file, record_pos, reason, detail``."""
    return records.where(~F.col("ok")).select(
        "source_file", "file_offset",
        F.when(F.col("article").isNull(), "no article in the file").otherwise("article not well-formed").alias("reason"),
        F.substring("article", 1, 200).alias("detail"))


def read_abstracts(spark: SparkSession, directory: str | list[str], pattern: str = ABSTRACT_FILES) -> DataFrame:
    """XML files of articles -> (pmid, abstract, ingredient_term); term = file stem minus the prefix, '_' -> ' '."""
    return abstract_fields(abstract_records(spark, directory, pattern)).select("pmid", "abstract", "ingredient_term")


def read_reports(spark: SparkSession, directory: str | list[str], pattern: str = REPORT_FILES) -> DataFrame:
    """S3: ``openfda_<term>_<yyyy-mm-dd>.json`` files, each a JSON array of records.

    Records stay whole as a VARIANT (``raw``) beside the typed fields the
    pipeline uses; the term comes from the file name (the records do not
    carry it). ``(source_file, record_pos)`` is an explicit landing order for
    first-wins rules. Files starting with '_' (the watermark file) are skipped by
    Spark, as the glob skips them. Malformed files surface as rows with a null
    ``raw`` (see ``corrupt_report_files``) instead of vanishing.
    """
    docs = (spark.read.option("multiLine", True).option("singleVariantColumn", "doc").option("mode", "PERMISSIVE")
            .option("pathGlobFilter", pattern).json(directory)
            .withColumn("_file", F.col("_metadata.file_name")))
    # one row per array element; a file that is not a JSON array keeps one row with a null record
    df = docs.select("_file", F.posexplode_outer(F.try_variant_get("doc", "$", "array<variant>"))
                     .alias("record_pos", "raw"))
    term = F.replace(F.regexp_extract("_file", r"^openfda_(.*)_\d{4}-\d{2}-\d{2}\.json$", 1), F.lit("_"), F.lit(" "))
    return df.select(
        F.try_variant_get("raw", "$.safetyreportid", "string").alias("safetyreportid"),
        F.try_variant_get("raw", "$.receivedate", "string").alias("receivedate"),
        F.try_variant_get("raw", "$.receiptdate", "string").alias("receiptdate"),
        term.alias("ingredient_term"),
        "raw", F.col("_file").alias("source_file"), F.col("record_pos").cast("long").alias("record_pos"),
    )


def corrupt_report_files(reports: DataFrame) -> DataFrame:
    """S3 report: files that did not parse (counted, not silently lost)."""
    return reports.filter(F.col("raw").isNull()).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_bad"))


def read_product_pages(spark: SparkSession, directory: str | list[str], pattern: str = PAGE_FILES,
                       with_malformed: bool = False) -> DataFrame:
    """Page JSON -> one row per element of ``products`` (fields vary per product).

    code as text, default 'unknown'; image URL = first non-empty of the front
    image and the generic image field; the product itself stays a VARIANT.
    ``with_malformed`` keeps a row with a null ``product`` for every page that has no product list.
    """
    pages = (spark.read.option("multiLine", True).option("singleVariantColumn", "page")
             .option("pathGlobFilter", pattern).json(directory)
             .withColumn("source_file", F.col("_metadata.file_name")))
    # a page without a product list keeps one row with a null product
    prods = pages.select("source_file", F.posexplode_outer(F.try_variant_get("page", "$.products", "array<variant>"))
                         .alias("record_pos", "product"))
    if not with_malformed:
        prods = prods.where("product IS NOT NULL")
    code = F.coalesce(F.nullif(F.try_variant_get("product", "$.code", "string"), F.lit("")), F.lit("unknown"))
    image = F.coalesce(F.nullif(F.try_variant_get("product", "$.image_front_url", "string"), F.lit("")),
                       F.nullif(F.try_variant_get("product", "$.image_url", "string"), F.lit("")))
    return prods.select(code.alias("product_code"),
                        F.try_variant_get("product", "$.categories", "string").alias("category"),
                        F.try_variant_get("product", "$.ingredients_text", "string").alias("ingredients_text"),
                        image.alias("image_url"), "product", "source_file",
                        F.col("record_pos").cast("long").alias("record_pos"))


def read_watermark_file(spark: SparkSession, path: str) -> DataFrame:
    """The extractor's per-term watermark file (a JSON map term -> 'yyyy-MM-dd') as rows
    (source_name, last_value, since).

    Spark's file inputs hide '_'-prefixed files even when named, so this small map (one entry per
    ingredient term) is read through the session's file system; the engine's own watermarks live in the
    published ``etl_watermarks`` table. ``since`` is the typed date, null when the text is not a date.
    """
    pairs = (spark.createDataFrame([(fs.read_text(spark, path),)], "doc string")
             .select(F.explode(F.from_json("doc", "map<string,string>")).alias("source_name", "last_value")))
    return pairs.withColumn("since", F.try_to_date("last_value", "yyyy-MM-dd"))


def read_id_lists(spark: SparkSession, directory: str, pattern: str = ID_FILES) -> DataFrame:
    """Ids per term for the per-term load: text files ``pmids_<term>.txt``, one id a line -> (pmid, ingredient_term, seq)."""
    lines = (spark.read.option("pathGlobFilter", pattern).text(directory)
             .select(F.trim("value").alias("pmid"), F.col("_metadata.file_name").alias("_file"),
                     F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("seq")))
    term = F.replace(F.regexp_extract("_file", r"^pmids_(.*)\.txt$", 1), F.lit("_"), F.lit(" "))
    return lines.where(F.col("pmid") != "").select("pmid", term.alias("ingredient_term"), "seq")


def read_captions(spark: SparkSession, directory: str, pattern: str = CAPTION_FILES) -> DataFrame:
    """Caption texts ``<video id>_caption.txt`` -> (video_id, transcript, transcript_len); one short file per item."""
    texts = (spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(directory)
             .select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_caption\.txt$", 1).alias("video_id"), F.col("value").alias("transcript")))
    return texts.withColumn("transcript_len", F.length("transcript").cast("long"))


def read_image_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The image inventory (CSV with header); ``image_ok`` to BOOLEAN."""
    df = (spark.read.schema("product_code string, category string, image_path string, ingredients_text string, image_ok string")
          .option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    return df.withColumn("image_ok", F.lower(F.trim("image_ok")) == F.lit("true"))


VIDEO_MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in
                               ["video_id", "title", "published_at", "query", "has_caption", "caption_path"]])
PODCAST_MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in
                                 ["show_name", "episode_title", "published", "audio_path", "download_ok"]])


def read_media_manifest(spark: SparkSession, path: str, schema: T.StructType, flag: str, published: str) -> DataFrame:
    """S7 + H9: CSV inventory; the status column to BOOLEAN, the date (ISO 8601 or
    RFC 822) to a UTC TIMESTAMP."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
          .csv(path))
    return df.withColumns({
        flag: F.lower(F.trim(flag)) == F.lit("true"),
        published + "_ts": unify_dates(published),
    })
