"""Reports over the query and data-access audit log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import json_number

# Audit thresholds and per-query scan caps in bytes.
QUERY_STARTED = "StartQueryExecution"
EXPENSIVE_BYTES = 1e11
EXPENSIVE_TOP = 50
STALE_DAYS = 90
ZONES = ["raw", "conformed", "consumption"]
SCAN_CAPS = {"marketing_workgroup": 10737418240, "finance_workgroup": 107374182400}


def scanned_bytes(details: str = "additional_event_data") -> Column:
    return json_number(F.col(details), "$.bytesScanned")


def expensive_queries(
    audit: DataFrame, min_bytes: float = EXPENSIVE_BYTES, k: int = EXPENSIVE_TOP,
    tie_break: Sequence[str] = ("event_time", "user_arn", "sql_text"),
) -> DataFrame:
    """The ``k`` started queries that scanned the most, strictly above ``min_bytes``.

    Reads the nested audit record; ``tie_break`` columns make the cut-off total.
    """
    started = audit.where((F.col("event_name") == QUERY_STARTED) & (scanned_bytes() > min_bytes))
    shown = {
        "user_arn": F.col("user_identity.arn"), "event_time": F.col("event_time"),
        "sql_text": F.col("request_parameters.query"), "scanned_gb": scanned_bytes() / F.lit(1e9),
    }
    extra = [c for c in tie_break if c not in shown]
    rows = started.select(*extra, *[value.alias(name) for name, value in shown.items()])
    return rows.orderBy(F.desc("scanned_gb"), *tie_break).limit(k)


def budget_breaches(audit: DataFrame, caps: Mapping[str, int] = SCAN_CAPS) -> DataFrame:
    """Started queries whose scan exceeds the byte cap of their workgroup.

    Caps are a small map given by the caller, so they are part of the expression.
    """
    entries = [F.lit(x) for name, cap in caps.items() for x in (name, cap)]
    cap = F.try_element_at(F.create_map(*entries), F.col("workgroup")).cast("long")
    return (
        audit.where(F.col("event_name") == QUERY_STARTED)
        .withColumn("scanned_bytes", scanned_bytes())
        .withColumn("cap_bytes", cap)
        .where("scanned_bytes > cap_bytes")
    )


def stale_tables(inventory: DataFrame, as_of: Column | str, days: int = STALE_DAYS) -> DataFrame:
    """Tables last updated more than ``days`` before the date ``as_of``."""
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    limit = F.date_sub(day, days).cast(inventory.schema["last_updated_time"].dataType)
    return inventory.where(F.col("last_updated_time") < limit)


def access_summary(
    audit: DataFrame, zone: str = "zone", user: str = "user_arn", time: str = "event_time",
) -> DataFrame:
    """Data events per zone, user, event and day."""
    return audit.groupBy(
        F.col(zone).alias("zone"), F.col(user).alias("user_arn"), "event_name",
        F.to_date(time).alias("event_day"),
    ).agg(F.count(F.lit(1)).alias("events"))


def zone_of(bucket: Column) -> Column:
    """The zone that a part of the bucket's name tells, parts being set off by ``-`` or ``.``; NULL for none."""
    part = F.regexp_extract(bucket, rf"(?:^|[-.])({'|'.join(ZONES)})(?=[-.]|$)", 1)
    return F.nullif(part, F.lit(""))


def zone_access(audit: DataFrame) -> DataFrame:
    """``access_summary`` of the nested records of the audit log that concern an object of a zone."""
    events = audit.select(
        zone_of(F.col("request_parameters.bucketName")).alias("zone"),
        F.col("user_identity.arn").alias("user_arn"), "event_name", "event_time")
    return access_summary(events.where("zone IS NOT NULL"))
