"""Domain views derived from the driver's tables.

Each view is a lazy DataFrame over the parquet scans, so every query built on
them reads the whole landed tables and grows with them. The same views are
written as DuckDB CTEs in ``plans.oracle`` (from the view definitions, not
from these plans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

# --- fixed values: fixture synonym pairs (common name -> standard name)
FIXTURE_SYNONYMS = [
    ("hot plate", "red plate"),
    ("small widget", "red widget"),
    ("hot ring", "small ring"),
    ("blue bolt", "red bolt"),
    ("large rod", "small rod"),
    ("red gear", "blue gear"),
]

# --- fixed values: fixture part type -> regulatory status
FIXTURE_STATUS_BY_TYPE = [
    ("PROMO", "banned"),
    ("ECONOMY", "restricted"),
    ("STANDARD", "allowed"),
    ("LARGE", "see annex"),
    ("SMALL", "unknown"),
]

# Run parameters of the fixtures.
AS_OF = "2024-01-25"            # P6 plausibility date
HIGH_VOLUME_FIXTURE_TERMS = ("click", "view")


def _with_extra(cond: Column) -> Column:
    """Generator: false for every row, and true for one more row where ``cond`` holds."""
    return F.explode(F.when(cond, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))


class Views:
    """Lazily built fixture views for one scale-factor directory.

    No view leaves out a source row or overwrites its text; dirty rows are
    added to the real ones.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    # -- registry ---------------------------------------------------------
    def registry(self) -> DataFrame:
        part = self.table("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
        status = None
        for ptype, word in FIXTURE_STATUS_BY_TYPE:
            status = (F.when(F.col("p_type") == ptype, word) if status is None
                      else status.when(F.col("p_type") == ptype, word))
        return part.select(
            F.col("p_partkey").alias("cosing_ref_no"),
            F.when(F.col("p_partkey") % 5 == 0, F.upper("p_name"))
             .when(F.col("p_partkey") % 7 == 0, F.concat(F.lit(" "), "p_name", F.lit(" ")))
             .otherwise(F.col("p_name")).alias("inci_name"),
            F.when(F.col("p_size") % 11 == 0, F.lit(None).cast("string"))
             .otherwise(F.col("p_brand")).alias("function"),
            status.alias("regulatory_status"),
        )

    def synonyms(self) -> DataFrame:
        return self.spark.createDataFrame(FIXTURE_SYNONYMS, "common_name string, std_name string")

    # -- abstracts ----------------------------------------------------------
    def abstracts(self) -> DataFrame:
        """Every document, and a blank abstract with a negative id for every 37th."""
        docs = self.table("documents", ["doc_id", "text", "source"])
        rows = docs.withColumn("_blank", _with_extra(F.col("doc_id") % 37 == 0))
        return rows.select(
            F.when(F.col("_blank"), -1 - F.col("doc_id")).otherwise(F.col("doc_id")).cast("string").alias("pmid"),
            F.col("source").alias("ingredient_term"),
            F.when(F.col("_blank"), F.lit("  ")).otherwise(F.col("text")).alias("abstract"),
        )

    def n_parts(self) -> Column:
        """Number of parts (1 for none), so that facts reach all of them."""
        return self.table("part", ["p_partkey"]).select(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()

    def evidence(self) -> DataFrame:
        docs = self.table("documents", ["doc_id"])
        return docs.select(F.col("doc_id").cast("string").alias("pmid"),
                           (F.col("doc_id") % self.n_parts()).alias("cosing_ref_no"))

    # -- adverse-event reports ---------------------------------------------
    def reports(self, *carried: str) -> DataFrame:
        """Every event, and rows with a blank id (every 101st) or a bad date (every 50th) under negative numbers.

        ``carried`` names event columns to keep besides the report's own.
        """
        ev = self.table("events", list(dict.fromkeys(["event_id", "ts", "event_type", "props", *carried])))
        dirt = F.array_compact(F.array(F.lit("none"), F.when(F.col("event_id") % 101 == 0, "id"),
                                       F.when(F.col("event_id") % 50 == 0, "date")))
        rows = ev.withColumn("_dirt", F.explode(dirt))
        seq = (F.when(F.col("_dirt") == "id", -1 - 2 * F.col("event_id"))
               .when(F.col("_dirt") == "date", -2 - 2 * F.col("event_id")).otherwise(F.col("event_id")))
        rid = F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)
        return rows.select(
            seq.alias("seq"),
            F.when(F.col("_dirt") == "id", F.lit("")).when(F.col("_dirt") == "date", seq.cast("string"))
             .otherwise(rid.cast("string")).alias("safetyreportid"),
            F.col("event_type").alias("ingredient_term"),
            F.when(F.col("_dirt") == "date", F.lit("garbage"))
             .otherwise(F.date_format(F.col("ts").cast("date"), "yyyyMMdd")).alias("receivedate"),
            F.col("props").alias("raw_payload"),
            *carried,
        )

    def stored(self) -> DataFrame:
        r = self.reports()
        return r.filter((F.col("seq") % 4 != 0) & (F.col("seq") % 10 != 9) & (F.col("safetyreportid") != "")) \
                .select("safetyreportid", "ingredient_term", "receivedate")

    def incoming(self) -> DataFrame:
        return self.reports("ts").filter(F.col("seq") % 3 != 0).select(
            "seq", "safetyreportid", "ingredient_term", "receivedate",
            F.when(F.col("seq") % 5 == 0,
                   F.date_format(F.date_add(F.col("ts").cast("date"), 1), "yyyyMMdd")).alias("receiptdate"),
        )

    def safety(self) -> DataFrame:
        ev = self.table("events", ["event_id", "ts", "user_id", "event_type"])
        return ev.select(
            "event_id",
            F.col("ts").cast("date").alias("full_date"),
            (F.col("event_id") % self.n_parts()).alias("cosing_ref_no"),
            (F.col("user_id") % 25).alias("n_nationkey"),
            (F.col("event_type") == "error").alias("is_serious"),
        )

    # -- product labels -----------------------------------------------------
    def labels_text(self) -> DataFrame:
        orders = self.table("orders", ["o_orderkey", "o_orderpriority"])
        li = self.table("lineitem", ["l_orderkey", "l_partkey", "l_linenumber"])
        part = self.table("part", ["p_partkey", "p_name"])
        label = (li.join(part, li.l_partkey == part.p_partkey)
                 .groupBy("l_orderkey")
                 .agg(F.array_join(F.transform(F.sort_array(F.collect_list(
                     F.struct("l_linenumber", "l_partkey", "p_name"))), lambda x: x["p_name"]), ", ")
                      .alias("label")))
        # every 19th label names one more ingredient, which no registry row has
        j = (orders.join(label, orders.o_orderkey == label.l_orderkey, "left")
             .withColumn("label", F.when(F.col("o_orderkey") % 19 == 0, F.concat("label", F.lit(", unlisted blend")))
                         .otherwise(F.col("label")))
             .withColumn("_blank", _with_extra(F.col("o_orderkey") % 23 == 0)))
        return j.select(
            F.when(F.col("_blank"), -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("product_code"),
            F.col("o_orderpriority").alias("category"),
            F.when(F.col("_blank"), F.lit(" "))
             .when(F.col("o_orderkey") % 2 == 0, F.col("label"))
             .otherwise(F.replace(F.col("label"), F.lit(", "), F.lit("\n"))).alias("label_text"),
        )

    # -- reporters, media, manifests -----------------------------------------
    def reporter(self) -> DataFrame:
        nation = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        region = self.table("region", ["r_regionkey", "r_name"])
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("reporter_country"), F.col("r_name").alias("region"))

    def transcripts(self) -> DataFrame:
        conv = self.table("conversations", ["conv_id", "role"])
        return conv.groupBy("conv_id").agg(
            (F.max(F.when(F.col("role") == "system", 1).otherwise(0)) == 1).alias("captioned"))

    def manifest(self) -> DataFrame:
        return self.table("documents", ["doc_id", "source"]).select(
            F.col("doc_id").alias("product_code"), F.col("source").alias("category"))

    def available(self) -> DataFrame:
        return self.table("labels", ["doc_id"]).select(F.col("doc_id").alias("product_code"))
