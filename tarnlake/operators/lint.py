"""Cost lint of query texts: one output row per violated rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import normal_text

# Rule codes, names, severities and messages.
RULES = {
    "L001": ("Wildcard Column Projection", "WARNING",
             "Ad-hoc 'SELECT *' scans all columns on S3 Parquet datasets. "
             "Project only required fields to minimize scanned bytes."),
    "L002": ("Missing Partition Filtering", "CRITICAL",
             "Querying transactions without 'event_date' or 'transaction_time' filters forces a full table "
             "scan. Add date constraints to leverage hidden partition indexes."),
    "L003": ("Multi-Tenant Regional Leakage", "INFO",
             "Multi-tenant tables contain mixed regional datasets. Add 'region_code' constraints to "
             "prevent redundant multi-region planning costs."),
}


def _violated(sql: Column) -> dict[str, Column]:
    """Rule code to the condition under which a normalised text breaks it."""
    def mentions(word: str) -> Column:
        return sql.contains(word)

    return {
        "L001": sql.rlike(r"(?U)select\s+(\w+\.)?\*\s+"),
        "L002": mentions("transactions") & ~mentions("event_date") & ~mentions("transaction_time"),
        "L003": mentions("customers") & ~mentions("region_code") & ~mentions("country"),
    }


def lint_queries(log: DataFrame, sql_col: str = "sql_text") -> DataFrame:
    """``log`` with ``code, rule, severity, description``, one row per violation."""
    text = log.withColumn("__sql", normal_text(F.col(sql_col)))
    found = F.array_compact(F.array(*[
        F.when(broken, F.struct(
            F.lit(code).alias("code"), *[
                F.lit(value).alias(name)
                for name, value in zip(("rule", "severity", "description"), RULES[code])
            ]))
        for code, broken in _violated(F.col("__sql")).items()
    ]))
    return text.select(*log.columns, F.explode(found).alias("__v")).select(*log.columns, "__v.*")


def lint_summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("queries"))
