"""Publishing (K1, K7, K8, DQ5): immutable folders plus a commit log.

No table format ships with plain Spark here, and overwriting the path being
read fails part-way, so tables are folders of immutable files and a log says
which of them make up each table:

    <root>/<table>/_version=<n>/[<column>=<value>/]   files written by commit n
    <root>/_commits/v=<n>/                            marker of commit n, one small JSON file

A marker lists, for every table the commit changes, all folders the table then
consists of (its manifest) with the partition each belongs to. So

* a commit changes several tables together (data, watermarks, file ledger, rejects) or none;
* a load writes only what it changes: ``replace`` a whole table, ``merge`` the touched
  partitions (copy-on-write, untouched ones stay listed as they are), or
  ``insert`` rows as further folders;
* readers take the last marker that names their table; a failure before the
  marker leaves folders that no reader sees and that the next commit of that number overwrites.

Validation (DQ1-DQ4) is measured by ``DataFrame.observe`` while the rows are
written, so it costs no pass of its own; a FAILED rule means no marker. Markers are
written with Spark, so the protocol works on any file system that Spark writes
to; single writer per log. ``expire`` removes what the last commits don't list.

Bounds: a manifest has a row per partition and folder (about 150 bytes) and is
read by the driver; partition accordingly (thousands, not millions).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import drop_null_keys
from ..operators.quality import DqChecks, FAILED
from . import fs

log = logging.getLogger(__name__)

MARKER_SCHEMA = "version long, batch_id long, table string, partition string, folder string, n_rows long, schema string"
BUCKET = "_bucket"      # hidden partition column of tables that are bucketed by a key
DEFAULT_BUCKETS = 32    # of a new table; about its bytes / 1 GB at scale
KEEP_VERSIONS = 3       # commits that ``expire`` leaves readable


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key: equal keys share one, whatever table or batch they are in."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """What a table consists of as of a commit."""

    version: int
    batch_id: int | None
    schema: T.StructType
    n_rows: int | None
    folders: tuple[tuple[str, str], ...]     # (partition such as 'day=2024-01-02' or '', folder below the root)


@dataclass
class Change:
    """Rows to commit to a table.

    ``mode``: ``replace`` the table, ``merge`` the partitions that ``touched``
    names (all of their rows are in ``df``), or ``insert`` the rows beside the stored ones.
    ``rules`` names the data-quality rules; ``partition_by`` the partition columns, of
    which the first is the unit of the manifest.
    """

    df: DataFrame
    mode: str = "replace"
    rules: str | None = None
    partition_by: Sequence[str] = ()
    touched: Sequence[str] | None = None
    observed: dict = field(default_factory=dict)


class CommitLog:
    """The commits below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def path(self) -> str:
        return f"{self.root}/_commits"

    def _markers(self) -> DataFrame | None:
        if not fs.exists(self.spark, self.path):
            return None
        return self.spark.read.schema(MARKER_SCHEMA).json(self.path)

    def last_version(self) -> int:
        """Number of the last commit of any table, 0 before the first."""
        markers = self._markers()
        return 0 if markers is None else markers.agg(F.max("version")).first()[0] or 0

    def snapshot(self, table: str = "") -> Snapshot | None:
        """The table's last committed state, None if it was never published (reads the markers only)."""
        markers = self._markers()
        if markers is None:
            return None
        mine = markers.where(F.col("table") == table)
        last = mine.select(F.max("version")).scalar()
        rows = mine.where(F.col("version") == last).collect()
        if not rows:
            return None
        head = next(r for r in rows if r["schema"] is not None)
        return Snapshot(head["version"], head["batch_id"], T.StructType.fromJson(_json(head["schema"])), head["n_rows"],
                        tuple(sorted((r["partition"], r["folder"]) for r in rows if r["folder"] is not None)))

    def read(self, table: str = "", partitions: Sequence[str] | None = None) -> DataFrame:
        """The table as of its last commit, or only some of its partitions."""
        found = self.snapshot(table)
        if found is None:
            raise FileNotFoundError(f"no committed version of {table or 'the table'} under {self.root}")
        return self.read_snapshot(found, table, partitions)

    def read_snapshot(self, found: Snapshot, table: str = "", partitions: Sequence[str] | None = None) -> DataFrame:
        wanted = None if partitions is None else set(partitions)
        paths = [f"{self.root}/{folder}" for part, folder in found.folders if wanted is None or part in wanted]
        if not paths:
            df = self.spark.createDataFrame([], found.schema)
        else:
            df = self.spark.read.schema(found.schema).option("basePath", self._base(table)).parquet(*paths)
        return df.select(*[f"`{c}`" for c in found.schema.names if c != BUCKET])

    def _base(self, table: str) -> str:
        return f"{self.root}/{table}" if table else self.root

    def _write(self, table: str, change: Change, version: int) -> tuple[tuple[str, str], ...]:
        """Write the rows once, counting them and the rules' violations on the way; returns the new folders."""
        name = f"_version={version}"
        checks = DqChecks(change.df, change.rules)
        seen = Observation()
        counted = change.df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *checks.aggregates)
        writer = counted.write.mode("overwrite")
        if change.partition_by:
            writer = writer.partitionBy(*change.partition_by)
        writer.parquet(f"{self._base(table)}/{name}")
        change.observed = dict(seen.get)
        change.observed["failed"] = [r for r in checks.rows(change.observed) if r[3] == FAILED]
        below = f"{table}/{name}" if table else name
        if not change.partition_by:
            return (("", below),)
        parts = [f for f in fs.folders(self.spark, f"{self._base(table)}/{name}") if "=" in f]
        return tuple((p, f"{below}/{p}") for p in parts)

    def commit(self, changes: dict[str, Change], batch_id: int | None = None, before_commit: Callable[[], None] | None = None) -> bool:
        """Write and commit all changes, or none of them; True when committed.

        A missing required column (DQ1) stops before any write, a null or range rule that
        FAILED (DQ2-DQ4) after it; ``before_commit`` runs between data and marker. Any
        error leaves all tables as they were, its cause goes to the log and what was written is removed.
        """
        for table, change in changes.items():
            missing = DqChecks(change.df, change.rules).missing
            if missing:
                log.error("%s: required columns %s are missing", table or self.root, missing)
                return False
        version = self.last_version() + 1
        try:
            rows = []
            for table, change in changes.items():
                old = self.snapshot(table) if change.mode != "replace" else None
                new = self._write(table, change, version)
                if change.observed["failed"]:
                    raise ValueError(f"data-quality rules failed: {change.observed['failed']}")
                schema, n_rows = _stored_schema(change.df.schema, change.partition_by), change.observed["n_rows"]
                if old is not None:
                    if old.schema.names != schema.names:
                        raise ValueError(f"{table}: columns {schema.names} don't fit the stored {old.schema.names}")
                    kept = old.folders if change.mode == "insert" else tuple(f for f in old.folders if f[0] not in set(change.touched or ()))
                    if change.mode == "merge":
                        stray = {p for p, _ in new} - set(change.touched or ())
                        if stray:
                            raise ValueError(f"{table}: rows outside the touched partitions: {sorted(stray)[:5]}")
                        n_rows = None
                    else:
                        n_rows = None if old.n_rows is None else old.n_rows + n_rows
                    new = kept + new
                rows.append((version, batch_id, table, None, None, n_rows, schema.json()))
                rows += [(version, batch_id, table, part, folder, None, None) for part, folder in new]
            if before_commit is not None:
                before_commit()
            self.spark.createDataFrame(rows, MARKER_SCHEMA).coalesce(1).write.mode("error").json(f"{self.path}/v={version}")
        except Exception:
            log.exception("commit %d of %s failed", version, self.root)
            for table in changes:
                fs.remove(self.spark, f"{self._base(table)}/_version={version}")
            return False
        return True

    def expire(self, keep: int = KEEP_VERSIONS) -> int:
        """Remove folders and markers that none of each table's last ``keep`` commits needs; returns the folders removed.

        A reader that resolved an older commit may still be reading: keep enough of them.
        """
        markers = self._markers()
        if markers is None:
            return 0
        heads = markers.where("schema IS NOT NULL").select("table", "version").collect()
        recent: dict[str, set[int]] = {}
        for table in {r["table"] for r in heads}:
            recent[table] = set(sorted({r["version"] for r in heads if r["table"] == table})[-keep:])
        last = max(r["version"] for r in heads)
        spans = [(F.col("table") == t) & F.col("version").isin(sorted(v)) for t, v in recent.items()]
        needed = {r["folder"] for span in spans for r in markers.where(span & F.col("folder").isNotNull()).select("folder").distinct().collect()}
        removed = 0
        for table in recent:
            for name in fs.folders(self.spark, self._base(table)):
                if not name.startswith("_version=") or int(name.split("=")[1]) > last:
                    continue
                below = f"{table}/{name}" if table else name
                parts = [f"{below}/{p}" for p in fs.folders(self.spark, f"{self.root}/{below}") if "=" in p]
                if below in needed or (parts and all(p in needed for p in parts)):
                    continue
                used = [p for p in parts if p in needed]
                for gone in ([p for p in parts if p not in needed] if used else [below]):
                    removed += fs.remove(self.spark, f"{self.root}/{gone}")
        for version in {r["version"] for r in heads} - set().union(*recent.values()):
            fs.remove(self.spark, f"{self.path}/v={version}")
        return removed


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def _stored_schema(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """The schema as read back: all nullable, partition columns last."""
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]
    return T.StructType([f for f in fields if f.name not in partition_by] + [f for n in partition_by for f in fields if f.name == n])


# --- one table with a log of its own (streaming sinks, single loads)

def current_marker(spark: SparkSession, path: str) -> dict | None:
    """The table's last commit ``{"version": n, "batch_id": b}`` (reads the small markers only)."""
    found = CommitLog(spark, path).snapshot()
    return None if found is None else {"version": found.version, "batch_id": found.batch_id}


def current_version(spark: SparkSession, path: str) -> int | None:
    """Largest committed version, or None for a table never published."""
    m = current_marker(spark, path)
    return None if m is None else m["version"]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last committed version (resolved once)."""
    return CommitLog(spark, path).read()


def atomic_publish(df: DataFrame, path: str, table: str | None = None,
                   before_commit: Callable[[], None] | None = None, partition_by: list[str] | None = None,
                   batch_id: int | None = None) -> bool:
    """K8: write the next version, validated on the way (DQ1-DQ4), then commit. True when committed.

    ``table`` selects the data-quality rules; see ``CommitLog.commit``.
    ``batch_id`` is recorded in the marker so a replayed micro-batch can be
    recognised (streaming sinks, R2).
    """
    change = Change(df, rules=table, partition_by=partition_by or ())
    return CommitLog(df.sparkSession, path).commit({"": change}, batch_id, before_commit)


# --- tables bucketed by a key: loads rewrite the touched buckets only

def stored_buckets(found: Snapshot | None) -> int | None:
    """Number of buckets that the table was laid out with, None if it isn't bucketed."""
    if found is None or BUCKET not in found.schema.names:
        return None
    return found.schema[BUCKET].metadata.get("buckets")


def bucketed(df: DataFrame, key: str, buckets: int, mode: str = "replace", rules: str | None = None,
             then_by: Sequence[str] = (), touched: Sequence[str] | None = None) -> Change:
    """A change of a table whose first partition level is the bucket of ``key`` (``then_by`` are further levels)."""
    rows = df.withColumn(BUCKET, bucket_of(key, buckets).alias(BUCKET, metadata={"buckets": buckets}))
    # a rebalance instead of a plain repartition: AQE splits a bucket that outgrows a task
    return Change(rows.hint("rebalance", F.col(BUCKET), *[F.col(c) for c in then_by]), mode, rules, [BUCKET, *then_by], touched)


def touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[str]:
    """Partitions that hold the batch's keys (at most ``buckets`` names reach the driver)."""
    rows = batch.select(bucket_of(key, buckets).alias("b")).distinct().collect()
    return [f"{BUCKET}={r['b']}" for r in rows]


def _empty(store: CommitLog, found: Snapshot | None, schema: str) -> DataFrame:
    return store.spark.createDataFrame([], schema if found is None else T.StructType([f for f in found.schema if f.name != BUCKET]))


def merge_by_key(store: CommitLog, table: str, batch: DataFrame, key: str, merge: Callable[[DataFrame], DataFrame], schema: str,
                 buckets: int = DEFAULT_BUCKETS, rules: str | None = None, then_by: Sequence[str] = ()) -> Change:
    """K5, CD2: the change that replaces only the buckets of the batch's keys.

    ``merge`` gets the stored rows of those buckets and returns their next
    state. The table's own number of buckets counts; ``schema`` and ``buckets`` lay out a table that
    doesn't exist yet, and one that isn't bucketed is rewritten once.
    """
    found = store.snapshot(table)
    laid_out = stored_buckets(found)
    if laid_out is None:
        stored = _empty(store, found, schema) if found is None else store.read_snapshot(found, table)
        return bucketed(merge(stored), key, buckets, "replace", rules, then_by)
    touched = touched_buckets(batch, key, laid_out)
    return bucketed(merge(store.read_snapshot(found, table, touched)), key, laid_out, "merge", rules, then_by, touched)


def insert_by_key(store: CommitLog, table: str, batch: DataFrame, key: str, new_rows: Callable[[DataFrame], DataFrame], schema: str,
                  buckets: int = DEFAULT_BUCKETS, rules: str | None = None) -> Change:
    """K4: the change that adds rows and rewrites none.

    ``new_rows`` gets the stored rows of the batch's buckets, of which it
    needs the keys only, and returns the rows to add. Many small inserts leave
    many small folders: ``compact`` rewrites them.
    """
    found = store.snapshot(table)
    laid_out = stored_buckets(found)
    if laid_out is None:
        if found is not None:
            raise ValueError(f"{table} is not bucketed: replace it with a bucketed change first")
        return bucketed(new_rows(_empty(store, None, schema)), key, buckets, "replace", rules)
    touched = touched_buckets(batch, key, laid_out)
    return bucketed(new_rows(store.read_snapshot(found, table, touched)), key, laid_out, "insert", rules)


def compact(store: CommitLog, table: str, key: str, most: int = 8) -> bool:
    """Rewrite the buckets that consist of more than ``most`` folders as one each; True when something was rewritten."""
    found = store.snapshot(table)
    counts: dict[str, int] = {}
    for part, _ in found.folders:
        counts[part] = counts.get(part, 0) + 1
    many = [p for p, n in counts.items() if n > most]
    if not many:
        return False
    change = bucketed(store.read_snapshot(found, table, many), key, stored_buckets(found), "merge", touched=many)
    if not store.commit({table: change}):
        raise RuntimeError(f"compacting {table} failed; the table is unchanged")
    return True


def full_load_frame(df: DataFrame, key: str) -> DataFrame:
    """K1 contents: the whole frame with null keys dropped (truncate-and-reload target)."""
    return drop_null_keys(df, key)


def full_load(df: DataFrame, path: str, key: str, table: str | None = None) -> bool:
    """K1: replace the table by ``df`` atomically (new version, one commit)."""
    return atomic_publish(full_load_frame(df, key), path, table)


def row_parity(spark: SparkSession, path: str, expected_rows: int) -> bool:
    """DQ5: the published table still has ``expected_rows`` rows (e.g. after a failed load)."""
    return read_current(spark, path).count() == expected_rows


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """K7: small reports as one file with a header; stages as parallel parquet."""
    if fmt == "csv":
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)
