"""Compaction of the small files of a stored table, large ones left where they are."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.upkeep import COMPACT_MAX_BYTES, COMPACT_MIN_FILES, compaction_groups
from tarnlake.session import stage
from tarnlake.sinks import exchange
from tarnlake.sinks.tables import (
    EXCHANGE, PENDING, decoded, finish_pending, one_spelling, partition_columns, table_files, table_location, writing)
from tarnlake.sources.policy import local_rows


def compact_table(
    spark: SparkSession, name: str, max_bytes: int = COMPACT_MAX_BYTES, min_files: int = COMPACT_MIN_FILES,
) -> DataFrame:
    """Merge the small files of partitions that have many; returns the plan that was carried out.

    ``partition, files, bytes, target_files``: how many files below ``max_bytes`` were
    merged, their bytes, and the number of files in their place.  Small files are packed
    into groups of about ``max_bytes``, each written as one file; no other file is read
    or written, and a file alone in its group stays.  The table is left as it was if
    the write fails, and an interrupted exchange is finished by the next write.
    """
    finish_pending(spark, name)
    root = table_location(spark, name).rstrip("/")
    # Metadata: the files a scan of the table opens, also those without a row.
    used = one_spelling(local_rows(spark, [(f,) for f in spark.table(name).inputFiles()], ["url"]).select(decoded("url")))
    files = one_spelling(table_files(spark, name)).join(used, "path", "left_semi")
    work = f"{root}/_compact-{uuid.uuid4().hex}"
    groups = stage(compaction_groups(files, ["partition"], max_bytes, min_files), "compact-groups")
    plan = stage(groups.groupBy("partition").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.count_distinct("group").cast("int").alias("target_files")), "compact-plan")
    # Metadata: names of the files to merge.
    paths = [row["path"] for row in groups.select("path").collect()]
    if not paths:
        return plan
    layout = partition_columns(spark, name)
    data = spark.table(name).drop(*layout).schema
    keys = groups.select("path", F.concat_ws(":", F.sha2("partition", 256), F.col("group").cast("string")).alias("__group"))
    small = one_spelling(spark.read.schema(data).parquet(*paths).withColumn("path", decoded("_metadata.file_path")))
    # A group is one task's, and so one file.
    with writing(spark):
        small.join(keys, "path").drop("path").repartition("__group").write.option("compression", "snappy").partitionBy(
            "__group").parquet(f"{work}/data")
    written = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{work}/data").select(
        F.col("path").alias("source"), F.url_decode(F.regexp_extract("path", "__group=([^/]*)/", 1)).alias("__group"))
    places = groups.select("partition", "group").distinct().select(
        "partition", "group", F.concat_ws(":", F.sha2("partition", 256), F.col("group").cast("string")).alias("__group"))
    # A task gives files of all its groups one name.
    moves = written.join(places, "__group").select("source", F.concat(
        F.lit(f"{root}/"), "partition", F.lit("part-g"), "group", F.lit("-"), F.regexp_extract("source", "part-([^/]*)$", 1)).alias("target"))
    # Row counts are in the footers.
    before, after = spark.read.schema(data).parquet(*paths).count(), spark.read.schema(data).parquet(f"{work}/data").count()
    if before != after:
        raise ValueError(f"{after} rows written for {before}: {name}")
    exchange.write_journal(spark, work, moves, groups)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PENDING}'='{json.dumps({EXCHANGE: work})}')")
    finish_pending(spark, name)
    return plan
