"""Governance runs: PII scan of tables, tag reconciliation."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import NamedTuple, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import unquote
from tarnlake.operators import tags as tag_ops
from tarnlake.operators.pii import CONTENT_PATTERNS, detect_pii, detect_pii_in_lines, pii_in_text
from tarnlake.operators.upkeep import first_sample_file
from tarnlake.operators.upsert import upsert
from tarnlake.session import stage
from tarnlake.sources.files import file_inventory, sample_lines, split_all_columns
from tarnlake.sources.policy import PolicyTables, local_rows

log = logging.getLogger(__name__)

T, Key = TypeVar("T"), TypeVar("Key")
TAG_COLUMNS = ["database", "table", "column", "tag", "value"]


# Raw files that are read, by kind; names in capitals too.
RAW_GLOBS = {"csv": "*.[cC][sS][vV]", "json": "*.[jJ][sS][oO][nN]"}
# Scans running at a time; each is a job of its own, so Spark shares the executors among them.
SCANS_AT_ONCE = 8
SCAN_POOL = "pii-scan"


class Reconciled(NamedTuple):
    tags: DataFrame
    drift: DataFrame
    missing: DataFrame


class RawScan(NamedTuple):
    """PII columns of a folder, and a row for each kind of file: how much was read, and what fitted nowhere."""

    columns: DataFrame
    report: DataFrame


class RawScanned(NamedTuple):
    """Tags after a scan of several folders, and the reports of all that could be read, by ``table``."""

    tags: DataFrame
    report: DataFrame


def in_parallel(spark: SparkSession, work: Mapping[Key, Callable[[], T]], at_once: int = SCANS_AT_ONCE) -> dict[Key, T | Exception]:
    """Results, or what was raised, of independent pieces of work that each run Spark jobs.

    Their jobs keep the caller's job group and tags, and share a scheduler pool.
    """
    def one(call: Callable[[], T]) -> T | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", SCAN_POOL)
        try:
            return call()
        except Exception as error:  # one unreadable table must not stop the others
            return error

    with ThreadPoolExecutor(max(1, min(at_once, len(work)))) as pool:
        # Wrapped one by one: each has a copy of the caller's properties.
        running = {key: pool.submit(inheritable_thread_target(spark)(one), call) for key, call in work.items()}
        return {key: future.result() for key, future in running.items()}


def _sampled(spark: SparkSession, path: str, lines: int) -> DataFrame:
    sample = sample_lines(spark, path, lines)
    header = sample.where("line_number = 1").select(
        F.transform(F.split("value", ","), unquote).alias("names")).first()["names"]
    return detect_pii_in_lines(sample.where("line_number > 1"), header)


def _json_rejected(spark: SparkSession, location: str) -> DataFrame:
    """``value`` of lines of JSON files that hold no JSON object or array."""
    lines = spark.read.options(recursiveFileLookup=True, pathGlobFilter=RAW_GLOBS["json"]).text(location)
    fits = F.get_json_object("value", "$").isNotNull() & F.ltrim("value").rlike(r"^[{\[]")
    return lines.where((F.btrim("value") != "") & ~fits).select("value")


def _json_rows(spark: SparkSession, location: str) -> DataFrame | None:
    """JSON Lines with all values as text; None if no line is JSON."""
    corrupt = "__rejected"
    reader = spark.read.options(
        primitivesAsString=True, recursiveFileLookup=True, pathGlobFilter=RAW_GLOBS["json"], columnNameOfCorruptRecord=corrupt)
    rows = reader.json(location).drop(corrupt)
    return rows if rows.columns else None


def _united(found: list[DataFrame]) -> DataFrame:
    """Detections of several kinds of files as one row a column."""
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    patterns = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.split("patterns", ","), lambda p: p != "")))))
    # At most a row for each kind of file and column.
    return both.groupBy("column").agg(
        F.max("pii").alias("pii"), F.max("source").alias("source"), F.array_join(patterns, ",").alias("patterns"))


def scan_raw(spark: SparkSession, location: str) -> RawScan:
    """PII columns over all CSV and JSON files below ``location``, in upper or lower case.

    JSON Lines go by their field names, CSV by each file's header; a column found in both
    kinds is one.  ``report`` has ``kind, files, bytes, rejected`` and hits per pattern
    among the words of rejected lines: CSV lines that do not fit their header, lines of
    JSON files that are no JSON.  They have no columns to tag, so whoever reads the report
    has to look at them.  Files of other kinds are counted as ``other`` and not opened.
    A folder without CSV and JSON files is an error.
    """
    lower = F.lower("path")
    kind = F.when(lower.endswith(".csv"), "csv").when(lower.endswith(".json"), "json").otherwise("other")
    listed = stage(file_inventory(spark, location).groupBy(kind.alias("kind")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")), "raw-listing")
    # Three rows at most.
    kinds = {row["kind"] for row in listed.collect()} - {"other"}
    if not kinds:
        raise FileNotFoundError(f"no CSV or JSON file below {location}")
    found, rejected = [], []
    if "csv" in kinds:
        parsed = split_all_columns(spark, location, RAW_GLOBS["csv"])
        found.append(detect_pii(parsed.rows))
        rejected.append(parsed.rejected.select(F.lit("csv").alias("kind"), "value"))
    if "json" in kinds:
        rows = _json_rows(spark, location)
        found += [] if rows is None else [detect_pii(rows)]
        rejected.append(_json_rejected(spark, location).select(F.lit("json").alias("kind"), "value"))
    if not found:
        found = [spark.createDataFrame([], "column string, pii string, source string, patterns string")]
    odd = rejected[0] if len(rejected) == 1 else rejected[0].unionByName(rejected[1])
    odd = stage(odd, "raw-rejected")
    hits = pii_in_text(odd.select("kind", F.translate("value", ",;:{}[]", "       ").alias("value")), "value", ["kind"])
    counts = odd.groupBy("kind").agg(F.count("*").alias("rejected"))
    report = listed.join(counts, "kind", "left").join(hits, "kind", "left").na.fill(0)
    return RawScan(stage(_united(found), "raw-columns"), stage(report, "raw-report"))


def detect_raw(spark: SparkSession, location: str, lines: int | None = None) -> DataFrame:
    """PII columns of a raw folder: those of ``scan_raw``, or with ``lines`` those of its first file.

    A sample takes so many lines of the first CSV file, in path order, or all of the
    first JSON file.  No value is ever taken for a name.  A folder without such a file
    gives an error.
    """
    if lines is None:
        return scan_raw(spark, location).columns
    listed = file_inventory(spark, location).withColumn("location", F.lit(location))
    first = first_sample_file(listed, ["location"]).first()
    if first is None:
        raise FileNotFoundError(f"no CSV or JSON file below {location}")
    if first["path"].lower().endswith(".json"):
        return detect_pii(spark.read.option("primitivesAsString", True).json(first["path"]))
    return _sampled(spark, first["path"], lines)


def _tagged(spark: SparkSession, tags: DataFrame, found: Mapping[tuple[str, str], list[Row] | Exception]) -> DataFrame:
    rows = []
    for (database, table), columns in found.items():
        if isinstance(columns, Exception):
            log.error("PII scan of %s.%s failed: %s: %s", database, table, type(columns).__name__, columns)
        else:
            rows += [(database, table, row["column"], "PII", row["pii"]) for row in columns]
    return upsert(tags, local_rows(spark, rows, TAG_COLUMNS), tag_ops.TAG_KEY, ["value"], TAG_COLUMNS)


def pii_scan(
    spark: SparkSession, tables: Mapping[tuple[str, str], Callable[[], DataFrame]], tags: DataFrame,
    detect: Callable[[DataFrame], DataFrame] = detect_pii, at_once: int = SCANS_AT_ONCE,
) -> DataFrame:
    """``tags`` with PII tags set for every column found in the given tables.

    ``tables`` maps (database, table) to a function that opens it.  Each table is
    one distributed pass that yields one row per flagged column; only those names
    reach the driver.  ``at_once`` tables are scanned at a time.  A table that cannot
    be read is logged and skipped.
    """
    def scan(open_table: Callable[[], DataFrame]) -> list[Row]:
        return detect(open_table()).select("column", "pii").collect()

    return _tagged(spark, tags, in_parallel(spark, {key: partial(scan, t) for key, t in tables.items()}, at_once))


def scan_raw_folders(
    spark: SparkSession, locations: Sequence[str], database: str, tags: DataFrame, at_once: int = SCANS_AT_ONCE,
) -> RawScanned:
    """``scan_raw`` of raw folders, whose last part names the table: ``tags`` with what was found, and the reports.

    A folder that cannot be read is logged, and its table has no report.
    """
    def scan(location: str) -> tuple[list[Row], DataFrame]:
        found = scan_raw(spark, location)
        return found.columns.select("column", "pii").collect(), found.report

    done = in_parallel(spark, {(database, table_of(location)): partial(scan, location) for location in locations}, at_once)
    columns = {key: x if isinstance(x, Exception) else x[0] for key, x in done.items()}
    reports = [x[1].select(F.lit(key[1]).alias("table"), "*") for key, x in done.items() if not isinstance(x, Exception)]
    report = None
    for more in reports:
        report = more if report is None else report.unionByName(more)
    if report is None:
        hits = ", ".join(f"{kind}_hits long" for kind in CONTENT_PATTERNS)
        report = spark.createDataFrame([], f"`table` string, kind string, files long, bytes long, rejected long, {hits}")
    return RawScanned(_tagged(spark, tags, columns), report)


def table_of(location: str) -> str:
    return location.rstrip("/").rsplit("/", 1)[-1]


def pii_scan_raw(
    spark: SparkSession, locations: Sequence[str], database: str, tags: DataFrame, lines: int | None = None,
    at_once: int = SCANS_AT_ONCE,
) -> DataFrame:
    """``pii_scan`` over raw folders, or with ``lines`` over samples of them; the last folder names the table."""
    if lines is None:
        return scan_raw_folders(spark, locations, database, tags, at_once).tags
    found = {
        (database, table_of(location)): partial(detect_raw, spark, location, lines) for location in locations
    }
    return pii_scan(spark, found, tags, detect=lambda columns: columns, at_once=at_once)


def reconcile_tags(catalog: DataFrame, policy: PolicyTables, tags: DataFrame) -> Reconciled:
    """Repaired tags, the drift they repair, and policy tables that do not exist."""
    # Staged, so that the report and the repair are the same rows, found once.
    drift = stage(tag_ops.tag_drift(tag_ops.expected_tags(catalog, policy), tags), "tag-drift")
    return Reconciled(tag_ops.repair_tags(tags, drift), drift, tag_ops.missing_tables(catalog, policy))
