"""Tag policy as relations, from a nested mapping, a JSON or a YAML file."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tag taxonomy and the policy of the three zones.
TAXONOMY = {
    "BU": ["marketing", "finance", "compliance", "analytics", "operations"],
    "Sensitivity": ["public", "internal", "confidential", "restricted"],
    "PII": ["none", "quasi", "direct"],
}
DATABASE_POLICIES = {
    "raw_db": {"bu": "operations", "default_sensitivity": "confidential", "default_pii": "quasi"},
    "conformed_db": {"tables": {
        "transactions": {"bu": "finance", "sensitivity": "internal", "columns": {
            "transaction_id": "none", "customer_id": "none", "amount": "none", "region_code": "none"}},
        "customers": {"bu": "operations", "sensitivity": "confidential", "columns": {
            "customer_id": "none", "first_name": "quasi", "last_name": "quasi", "email": "direct",
            "phone_number": "direct", "ssn": "direct", "ssn_hash": "none"}},
    }},
    "consumption_db": {"tables": {
        "dim_customers": {"bu": "analytics", "sensitivity": "confidential", "columns": {
            "ssn": "direct", "phone_number": "direct", "email": "direct"}},
        "fact_transactions": {"bu": "analytics", "sensitivity": "internal"},
    }},
}

# The tag-based grant of the finance analyst.
FINANCE_GRANT = [
    ("finance_analyst_tbac", "finance_analyst", "SELECT,DESCRIBE", "BU", "finance"),
    ("finance_analyst_tbac", "finance_analyst", "SELECT,DESCRIBE", "Sensitivity", "public"),
    ("finance_analyst_tbac", "finance_analyst", "SELECT,DESCRIBE", "Sensitivity", "internal"),
]
GRANT_COLUMNS = ["grant_id", "principal", "permissions", "key", "value"]


class PolicyTables(NamedTuple):
    taxonomy: DataFrame   # tag, value
    databases: DataFrame  # database, default_bu, default_sensitivity, default_pii
    tables: DataFrame     # database, table, bu, sensitivity
    columns: DataFrame    # database, table, column, pii


def local_rows(spark: SparkSession, rows, columns) -> DataFrame:
    """A relation of text rows held by the driver.

    Built from Arrow, so Spark knows its size and may broadcast it unasked.
    """
    return spark.createDataFrame(pa.table({
        name: pa.array([row[i] for row in rows], pa.string()) for i, name in enumerate(columns)}))


def load_policy(path: str) -> dict[str, Any]:
    """Policy file on the driver: JSON, or YAML where a YAML reader is installed."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading a YAML policy needs a YAML package; use JSON") from error
        return yaml.safe_load(handle)


def policy_tables(spark: SparkSession, policy: Mapping[str, Any] | None = None) -> PolicyTables:
    """Flatten a policy; without one, the fixed policy above.

    The policy is written by people, so it is small and made on the driver;
    Spark sees its size and joins it without a shuffle.
    """
    policy = policy or {}
    taxonomy = {k: v["values"] for k, v in policy["lf_tags"].items()} if "lf_tags" in policy else TAXONOMY
    databases = policy.get("database_policies", DATABASE_POLICIES)
    table_rows, column_rows = [], []
    for database, rules in databases.items():
        for table, found in (rules.get("tables") or {}).items():
            table_rows.append((database, table, found.get("bu"), found.get("sensitivity")))
            for column, pii in (found.get("columns") or {}).items():
                value = pii.get("pii") if isinstance(pii, Mapping) else pii
                column_rows.append((database, table, column, value))
    return PolicyTables(
        local_rows(spark, [(tag, value) for tag, values in taxonomy.items() for value in values],
                   ["tag", "value"]),
        local_rows(spark, [(d, r.get("bu"), r.get("default_sensitivity"), r.get("default_pii"))
                           for d, r in databases.items()],
                   ["database", "default_bu", "default_sensitivity", "default_pii"]),
        local_rows(spark, table_rows, ["database", "table", "bu", "sensitivity"]),
        local_rows(spark, column_rows, ["database", "table", "column", "pii"]),
    )


def policy_tag_rows(policy: PolicyTables) -> DataFrame:
    """Every tag the policy itself assigns, for a check against the taxonomy."""
    def rows(df: DataFrame, tag: str, value: str, table: str, column: str) -> DataFrame:
        return df.where(F.col(value).isNotNull()).select(
            "database", (F.col(table) if table else F.lit("")).alias("table"),
            (F.col(column) if column else F.lit("")).alias("column"),
            F.lit(tag).alias("tag"), F.col(value).alias("value"))

    return (
        rows(policy.databases, "BU", "default_bu", "", "")
        .unionByName(rows(policy.databases, "Sensitivity", "default_sensitivity", "", ""))
        .unionByName(rows(policy.databases, "PII", "default_pii", "", ""))
        .unionByName(rows(policy.tables, "BU", "bu", "table", ""))
        .unionByName(rows(policy.tables, "Sensitivity", "sensitivity", "table", ""))
        .unionByName(rows(policy.columns, "PII", "pii", "table", "column"))
    )


def grants(spark: SparkSession, rows=FINANCE_GRANT) -> DataFrame:
    return local_rows(spark, rows, GRANT_COLUMNS)
