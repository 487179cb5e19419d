"""Data-quality rules (DQ1-DQ4): one aggregation pass per table.

Schema checks read ``df.columns`` (no job). Null and range counts for all
rules of a table are computed in a single ``agg`` over the data, so a
validation costs one scan however many rules there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DQ_NOT_NULL_COLUMNS, DQ_RANGE_RULES, DQ_REQUIRED_COLUMNS

PASSED, FAILED, WARNING = "PASSED", "FAILED", "WARNING"
REPORT_SCHEMA = "table_name string, check_name string, column_name string, status string, n_bad long"


class DqChecks:
    """The rules of a table bound to a frame: DQ1 from its columns, DQ2 and DQ3 as aggregates.

    ``aggregates`` are counts of violations, one per rule, to be computed in any pass over the
    rows (an ``agg``, or ``DataFrame.observe`` while they are written);
    ``rows`` turns their values into report rows. Without a table there are no rules.
    """

    def __init__(self, df: DataFrame, table: str | None, required: dict | None = None, not_null: dict | None = None,
                 ranges: dict | None = None):
        required = DQ_REQUIRED_COLUMNS if required is None else required
        not_null = DQ_NOT_NULL_COLUMNS if not_null is None else not_null
        ranges = DQ_RANGE_RULES if ranges is None else ranges
        self.table = table
        self.required = [(c, c in df.columns) for c in required.get(table, [])]
        self.missing = [c for c, there in self.required if not there]
        self.rules: list[tuple[str, str, str]] = []
        self.aggregates = []
        for c in not_null.get(table, []):
            if c in df.columns:
                self._add("nulls", c, FAILED, F.col(c).isNull())
        for c, (lo, hi) in ranges.get(table, {}).items():
            if c in df.columns:
                x = F.col(c).cast("string").try_cast("double")
                self._add("range", c, WARNING, (x < lo) | (x > hi))

    def _add(self, check: str, col: str, status: str, bad) -> None:
        self.aggregates.append(F.count_if(bad).alias(f"dq{len(self.rules)}"))
        self.rules.append((check, col, status))

    def schema_rows(self) -> list[tuple]:
        return [(self.table, "schema", c, PASSED if there else FAILED, 0 if there else 1) for c, there in self.required]

    def rows(self, counts: dict) -> list[tuple]:
        """Report rows (table_name, check_name, column_name, status, n_bad) from the aggregates' values."""
        return self.schema_rows() + [(self.table, check, col, status if counts[f"dq{i}"] else PASSED, counts[f"dq{i}"])
                                     for i, (check, col, status) in enumerate(self.rules)]


def dq_report(df: DataFrame, table: str, required: dict | None = None, not_null: dict | None = None,
              ranges: dict | None = None) -> DataFrame:
    """Rows (table_name, check_name, column_name, status, n_bad), one per rule.

    DQ1 schema: a required column missing -> FAILED. DQ2 nulls: any null in a
    key column -> FAILED with the count (absent columns skipped). DQ3 range:
    values outside [lo, hi] (non-numeric ignored) -> WARNING only.
    """
    checks = DqChecks(df, table, required, not_null, ranges)
    report = df.sparkSession.createDataFrame(checks.schema_rows(), REPORT_SCHEMA)
    if checks.rules:
        rows = []
        for i, (check, col, bad_status) in enumerate(checks.rules):
            n = F.col(f"dq{i}")
            rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                                 F.lit(col).alias("column_name"),
                                 F.when(n > 0, F.lit(bad_status)).otherwise(F.lit(PASSED)).alias("status"),
                                 n.cast("long").alias("n_bad")))
        # one scan: all counts in one aggregate row, then one output row per rule
        counted = df.agg(*checks.aggregates).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        report = report.unionByName(counted)
    return report


def dq_verdict(report: DataFrame) -> DataFrame:
    """DQ4: a table is valid iff none of its rules FAILED (tables without rules are valid)."""
    return report.groupBy("table_name").agg(F.bool_and(F.col("status") != FAILED).alias("is_valid"))


def is_valid(report: DataFrame) -> bool:
    """Driver-side verdict for the publish protocol (one tiny aggregate)."""
    return report.filter(F.col("status") == FAILED).limit(1).count() == 0
