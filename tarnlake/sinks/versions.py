"""Whole results published as version folders, for marts that are replaced as a whole.

``root/data/v=<id>`` holds a version and ``root/commits`` one row per finished
version.  A plain folder convention with one writer: a reader keeps the version
it opened, and old ones are chosen by ``upkeep.expired_versions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "`table` string, version string, committed_at timestamp"


def write_version(df: DataFrame, root: str, table: str, version: str, layout: Sequence[str] = ()) -> str:
    """Write a new version, then record it; returns its path.  An existing one is refused."""
    path = f"{root.rstrip('/')}/data/v={version}"
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*layout) if layout else writer).parquet(path)
    commit = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(table).alias("table"), F.lit(version).alias("version"),
        F.current_timestamp().alias("committed_at"))
    commit.write.mode("append").parquet(f"{root.rstrip('/')}/commits")
    return path


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """``table, version, committed_at`` of the finished versions."""
    return spark.read.schema(COMMITS).parquet(f"{root.rstrip('/')}/commits")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    newest = list_versions(spark, root).agg(F.max_by("version", F.struct("committed_at", "version"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no finished version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/data/v={newest}")


NTZ_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_csv(df: DataFrame, path: str) -> None:
    """Headered CSV export, used for storage metrics; times keep their microseconds."""
    df.write.options(
        header="true", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", timestampNTZFormat=NTZ_TEXT).csv(path)
