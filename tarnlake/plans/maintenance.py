"""Maintenance run over stored tables: compact, expire versions, find orphans."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.upkeep import RETENTION_DAYS, expired_versions
from tarnlake.session import stage
from tarnlake.sinks.compaction import compact_table
from tarnlake.sinks.tables import table_orphans
from tarnlake.sinks.versions import list_versions
from tarnlake.sources.policy import local_rows


# Columns of what each step finds.
FOUND_TYPES = {
    "compact": "partition string, files long, bytes long, target_files int",
    "expire": "version string, committed_at timestamp",
    "orphans": "path string, length long, modificationTime timestamp",
}
FOUND = {step: [column.split()[0] for column in ddl.split(", ")] for step, ddl in FOUND_TYPES.items()}


def retention_cutoff(days: int = RETENTION_DAYS, now: datetime | None = None) -> str:
    """One UTC cutoff shared by all steps."""
    now = now or datetime.now(timezone.utc)
    return (now - timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")


def table_names(text: str | Sequence[str]) -> list[str]:
    """Names from a comma-separated list, trimmed."""
    return [name.strip() for name in (text.split(",") if isinstance(text, str) else text) if name.strip()]


class Maintained(NamedTuple):
    """``table, step, ok, message`` of every step, and what a caller can act on, by ``table``."""

    status: DataFrame
    merged: DataFrame    # partition, files, bytes, target_files
    versions: DataFrame  # version, committed_at
    orphans: DataFrame   # path, length, modificationTime


def maintain_all(
    spark: SparkSession, tables: str | Sequence[str], retention_days: int = RETENTION_DAYS,
    version_roots: Mapping[str, str] | None = None, listed_roots: Mapping[str, str] | None = None,
    now: datetime | None = None, **compaction,
) -> Maintained:
    """Compact, find expired versions, find orphans; a failing table does not stop the rest.

    Orphans are looked for in the table's own folder, or in the one ``listed_roots`` names;
    versions only of tables in ``version_roots``, as a stored table has none.  Expired
    versions and orphans are returned and left in place: deleting them is the caller's.
    """
    cutoff = F.lit(retention_cutoff(retention_days, now)).cast("timestamp")
    status: list[tuple[str, str, str, str]] = []
    found: dict[str, list[DataFrame]] = {step: [] for step in FOUND}

    def run(table: str, step: str, what: str, work: Callable[[], DataFrame]) -> bool:
        try:
            rows = stage(work().select(F.lit(table).alias("table"), *FOUND[step]), f"maintain-{step}")
            status.append((table, step, "true", f"{rows.count()} {what}"))
            found[step].append(rows)
            return True
        except Exception as error:  # recorded; the next table still runs
            said = str(error).strip().splitlines() or [""]
            status.append((table, step, "false", f"{type(error).__name__}: {said[0]}"))
            return False

    for table in table_names(tables):
        if not run(table, "compact", "partitions", lambda: compact_table(spark, table, **compaction)):
            continue
        root = (version_roots or {}).get(table)
        if root and not run(table, "expire", "versions", lambda: expired_versions(
                list_versions(spark, root).drop("table").withColumn("table", F.lit(table)), cutoff)):
            continue
        folder = (listed_roots or {}).get(table)
        run(table, "orphans", "files", lambda: table_orphans(spark, table, cutoff, folder))
    rows = local_rows(spark, status, ["table", "step", "ok", "message"])
    return Maintained(rows.withColumn("ok", F.col("ok").cast("boolean")), *[
        reduce(DataFrame.unionByName, found[step]) if found[step] else spark.createDataFrame([], f"`table` string, {ddl}")
        for step, ddl in FOUND_TYPES.items()])


def maintain(spark: SparkSession, tables: str | Sequence[str], *args, **options) -> DataFrame:
    """The status rows of ``maintain_all``."""
    return maintain_all(spark, tables, *args, **options).status
