"""Table upkeep as selections over file and version inventories.

Each function returns the files or versions concerned; deleting them is left to
the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Compaction, retention and lifecycle limits.
COMPACT_MAX_BYTES = 536870912
COMPACT_MIN_FILES = 5
RETENTION_DAYS = 7
RETAIN_LAST = 3
STORAGE_DEPTH = 5
# Rows a group up to which Spark's own limit of window groups applies, and parts of a group beyond it.
WINDOW_LIMIT, PARTS = 1000, 64
RAW_LIFECYCLE = {"archive": 30, "expire": 365}
CONFORMED_LIFECYCLE = {"tier": 0}


def first_per_group(
    rows: DataFrame, n: int, by: Sequence[str], order: Sequence[Column | str], spread: Sequence[str],
) -> DataFrame:
    """The first ``n`` rows of each group.

    Up to ``WINDOW_LIMIT``, ``row_number() <= n`` lets Spark cut each map task's rows to n a group
    before the shuffle.  For more it does not, so every group is first cut to n rows in each of
    ``PARTS`` parts, dealt by a hash of the ``spread`` columns: no task gets a hot group whole.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    if n > WINDOW_LIMIT:
        part = F.pmod(F.xxhash64(*spread), F.lit(PARTS))
        inside = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
        rows = rows.withColumn("__part", part).withColumn("__inside", inside).where(
            F.col("__inside") <= n).drop("__part", "__inside")
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def retained_versions(versions: DataFrame, retain_last: int = RETAIN_LAST) -> DataFrame:
    """The newest ``retain_last`` versions of each table."""
    newest = [F.desc("committed_at"), F.desc("version")]
    return first_per_group(versions, retain_last, ["table"], newest, ["committed_at", "version"])


def expired_versions(versions: DataFrame, older_than: Column, retain_last: int = RETAIN_LAST) -> DataFrame:
    """Versions committed before ``older_than`` that are not among the last ones.

    Old versions are joined on (table, version), which spreads one busy table
    over all tasks; ranking them would put it in a single one.
    """
    kept = retained_versions(versions, retain_last).select("table", "version")
    return versions.where(F.col("committed_at") < older_than).join(kept, ["table", "version"], "left_anti")


def orphan_files(
    listed: DataFrame, referenced: DataFrame, older_than: Column,
    path: str = "path", modified: str = "modificationTime",
) -> DataFrame:
    """Listed files last changed before ``older_than`` that nothing references."""
    return listed.where(F.col(modified) < older_than).join(
        referenced.select(path).distinct(), path, "left_anti")


def lifecycle_plan(
    files: DataFrame, as_of: Column, rules: dict[str, int] | None = None, modified: str = "modificationTime",
) -> DataFrame:
    """Files due for an ``action``; of several rules reached, the oldest age wins."""
    rules = RAW_LIFECYCLE if rules is None else rules
    age = F.date_diff(F.to_date(as_of), F.to_date(F.col(modified)))
    action = F.lit(None).cast("string")
    for name, days in sorted(rules.items(), key=lambda rule: rule[1]):
        action = F.when(F.col("age_days") >= days, F.lit(name)).otherwise(action)
    return files.withColumn("age_days", age).withColumn("action", action).where("action IS NOT NULL")


def storage_metrics(
    files: DataFrame, max_depth: int = STORAGE_DEPTH, path: str = "path", size: str = "length",
    modified: str | None = "modificationTime",
) -> DataFrame:
    """Bytes and files under every folder prefix of up to ``max_depth`` levels."""
    bare = F.regexp_replace(F.col(path), "^[a-zA-Z0-9+.-]+:/+", "")
    parts = F.split(bare, "/")
    deepest = F.slice(parts, F.lit(1), F.greatest(F.lit(0), F.least(F.size(parts) - 1, F.lit(max_depth))))
    # Files are summed in their deepest folder first, a row a folder and task; only folders are rolled up.
    totals = [F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("files")]
    if modified:
        totals.append(F.max(modified).alias("last_modified"))
    folders = files.select(size, *([modified] if modified else []), deepest.alias("__folder")).where(
        F.size("__folder") >= 1).groupBy("__folder").agg(*totals)
    levels = folders.select("*", F.explode(F.sequence(F.lit(1), F.size("__folder"))).alias("depth"))
    prefix = F.array_join(F.slice("__folder", F.lit(1), F.col("depth")), "/")
    rolled = [F.sum("bytes").alias("bytes"), F.sum("files").alias("files")]
    if modified:
        rolled.append(F.max("last_modified").alias("last_modified"))
    return levels.groupBy(prefix.alias("prefix"), "depth").agg(*rolled)


def compaction_plan(
    files: DataFrame, by: Sequence[str], max_bytes: int = COMPACT_MAX_BYTES,
    min_files: int = COMPACT_MIN_FILES, size: str = "length",
) -> DataFrame:
    """Partitions with at least ``min_files`` files below ``max_bytes``, and the
    number of files to rewrite them into."""
    small = files.where(F.col(size) < max_bytes)
    return (
        small.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))
        .where(F.col("files") >= min_files)
        .withColumn("target_files", F.greatest(F.ceil(F.col("bytes") / max_bytes), F.lit(1)).cast("int"))
    )


def compaction_groups(
    files: DataFrame, by: Sequence[str], max_bytes: int = COMPACT_MAX_BYTES,
    min_files: int = COMPACT_MIN_FILES, size: str = "length", path: str = "path",
) -> DataFrame:
    """The files to merge, with the ``group`` of its partition that each goes into.

    Files below ``max_bytes`` of a partition with at least ``min_files`` of them are laid
    end to end, smallest first, and cut every ``max_bytes``: a group is that large, give or
    take a file.  A file alone in its group is left out.
    """
    small = files.where(F.col(size) < max_bytes)
    part = Window.partitionBy(*by)
    ends = F.sum(size).over(part.orderBy(size, path).rowsBetween(Window.unboundedPreceding, 0))
    grouped = small.withColumns({
        "group": F.floor((ends - F.col(size)) / max_bytes).cast("long"), "__files": F.count(F.lit(1)).over(part)})
    together = grouped.withColumn("__together", F.count(F.lit(1)).over(Window.partitionBy(*by, "group")))
    return together.where((F.col("__files") >= min_files) & (F.col("__together") > 1)).drop("__files", "__together")


def head_sample(lines: DataFrame, n: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of each group (a sampling operator)."""
    return first_per_group(lines, n, by, order, order)


def first_sample_file(
    files: DataFrame, by: Sequence[str], endings: Sequence[str] = (".csv", ".json"), path: str = "path",
) -> DataFrame:
    """The first file of each group, in path order, with one of the ``endings``, in upper or lower case."""
    fits = F.lit(False)
    for ending in endings:
        fits = fits | F.lower(path).endswith(ending.lower())
    return files.where(fits).groupBy(*by).agg(F.min(path).alias(path))
