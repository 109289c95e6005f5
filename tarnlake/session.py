"""Session settings the jobs are tuned for, and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings that change plans, not results.  Shuffle partitions start high and
# AQE merges the small ones, so the same code fits a laptop and a large cluster.
TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "snappy",
}


def batch_time() -> Column:
    """The present moment as a constant, so that every step of a run stamps the same time."""
    return F.timestamp_micros(F.lit(time.time_ns() // 1000))


def build_session(app: str = "tarnlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``TUNING`` applied; keyword ``a__b`` sets conf ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    that folder would exist on one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="tarnlake-")
    return _fallback[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet.

    Everything an application stages is in one folder named after it, which can
    be removed once the application has ended.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tarnlake/{app}/{name}-{uuid.uuid4().hex}"


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB").strip().lower()
    number = text.rstrip("bkmg")
    return int(number) * _UNITS[text[len(number):]]


def data_bytes(df: DataFrame) -> int:
    """Size of the rows of a stored ``df``, measured by one pass over it.

    Text and binary count their length, other values a word each, every row a
    fixed overhead: an upper estimate of what a broadcast has to hold.
    """
    width = F.lit(32)
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) + 16
        else:
            width = width + 8
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def within_broadcast(spark: SparkSession, size: int) -> bool:
    limit = broadcast_limit(spark)
    return limit >= 0 and size <= limit


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a stored ``df`` is measured to be within Spark's broadcast limit."""
    return within_broadcast(df.sparkSession, data_bytes(df))


def stage(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later steps read columnar files that survive the loss of
    any executor, instead of running the plan behind ``df`` again.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
