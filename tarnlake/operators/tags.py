"""Tag policy: expected tags, drift, repair, validation and tag-based access.

Tags are rows ``database, table, column, tag, value``; ``column = ''`` marks a
table-level tag, so that no upsert key is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.upsert import upsert
from tarnlake.sources.policy import PolicyTables

TAG_KEY = ["database", "table", "column", "tag"]

# What applies when neither table nor database policy says anything.
FALLBACKS = {"BU": "operations", "Sensitivity": "internal", "PII": "none"}


def current_tags(assignments: DataFrame) -> DataFrame:
    """Assigned tags with several values each, reduced to their first value."""
    return assignments.select(
        "database", "table", F.coalesce("column", F.lit("")).alias("column"), "tag",
        F.get("values", F.lit(0)).alias("value"))


def expected_tags(catalog: DataFrame, policy: PolicyTables) -> DataFrame:
    """Tags every catalogued table and column should carry.

    BU and Sensitivity: table policy, else database default, else fallback.
    PII: column policy, else database default, else fallback.  Only databases
    named by the policy are covered.  A catalogue row with a NULL column stands
    for a table without columns.
    """
    tables = (
        catalog.select("database", "table").distinct()
        .join(policy.databases, "database")
        .join(policy.tables, ["database", "table"], "left")
    )
    table_tags = tables.select("database", "table", F.lit("").alias("column"), F.inline(F.array(
        F.struct(F.lit("BU").alias("tag"),
                 F.coalesce("bu", "default_bu", F.lit(FALLBACKS["BU"])).alias("value")),
        F.struct(F.lit("Sensitivity").alias("tag"),
                 F.coalesce("sensitivity", "default_sensitivity", F.lit(FALLBACKS["Sensitivity"])).alias("value")),
    )))
    columns = (
        catalog.where("column IS NOT NULL")
        .join(policy.databases, "database")
        .join(policy.columns, ["database", "table", "column"], "left")
    )
    column_tags = columns.select(
        "database", "table", "column", F.lit("PII").alias("tag"),
        F.coalesce("pii", "default_pii", F.lit(FALLBACKS["PII"])).alias("value"))
    return table_tags.unionByName(column_tags)


def tag_drift(expected: DataFrame, tags: DataFrame) -> DataFrame:
    """Expected tags that are missing or differ: the key columns, ``old`` and ``new``."""
    now = tags.select(*TAG_KEY, F.col("value").alias("old"))
    return (
        expected.withColumnRenamed("value", "new").join(now, TAG_KEY, "left")
        .where(~F.col("old").eqNullSafe(F.col("new"))).select(*TAG_KEY, "old", "new")
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.groupBy("tag").agg(
        F.count(F.lit(1)).alias("drifts"), F.count_if(F.col("old").isNull()).alias("missing"))


def repair_tags(tags: DataFrame, drift: DataFrame) -> DataFrame:
    """``tags`` with every drifted tag set to its expected value; ``drift`` is stored."""
    healed = drift.select(*TAG_KEY, F.col("new").alias("value"))
    return upsert(tags, healed, TAG_KEY, ["value"], [*TAG_KEY, "value"], stored=True)


def missing_tables(catalog: DataFrame, policy: PolicyTables) -> DataFrame:
    """Tables named by the policy that the catalogue does not hold."""
    return policy.tables.select("database", "table").join(
        catalog.select("database", "table").distinct(), ["database", "table"], "left_anti")


def validate_tags(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Tag rows whose (tag, value) the taxonomy does not allow."""
    return rows.join(taxonomy, ["tag", "value"], "left_anti")


def authorized_tables(tags: DataFrame, grants: DataFrame) -> DataFrame:
    """Tables each principal may use: all keys of a grant match, any value per key.

    ``grants`` rows are ``grant_id, principal, permissions, key, value``; each
    grant is one expression and counts on its own.
    """
    needed = grants.groupBy("grant_id").agg(F.countDistinct("key").alias("needed"))
    offers = grants.distinct().withColumnRenamed("key", "tag")
    held = (
        tags.where("column = ''").select("database", "table", "tag", "value").distinct()
        .join(offers, ["tag", "value"])
        .groupBy("grant_id", "principal", "permissions", "database", "table")
        .agg(F.countDistinct("tag").alias("held"))
    )
    return (
        held.join(needed, "grant_id").where("held = needed")
        .select("principal", "permissions", "database", "table").distinct()
    )
