"""Raw to conformed: type, hash and upsert transactions and customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.functions.columns import normalize_columns, sha256_hex, to_double, to_time, with_missing
from tarnlake.session import batch_time
from tarnlake.sinks.tables import create_table, upsert_table
from tarnlake.sources.files import read_customers, parse_transactions


def conform_transactions(raw: DataFrame, batch_ts: Column | None = None) -> DataFrame:
    """Raw text rows in the conformed schema.

    Names are normalised first, so a padded or upper-case name is typed too;
    malformed amounts and times become NULL, absent columns typed NULLs.
    """
    named = normalize_columns(raw)
    typed = {"ingested_at": batch_time() if batch_ts is None else batch_ts}
    if "amount" in named.columns:
        typed["amount"] = to_double(F.col("amount"))
    if "transaction_time" in named.columns:
        typed["transaction_time"] = to_time(F.col("transaction_time").cast("string"))
    return with_missing(named.withColumns(typed), schemas.TRANSACTIONS)


def conform_customers(
    raw: DataFrame, batch_ts: Column | None = None, salt: str = "", drop_raw: bool = False,
) -> DataFrame:
    """Raw customers with ``ssn_hash``.  ``drop_raw`` blanks the raw number."""
    now = batch_time() if batch_ts is None else batch_ts
    typed = raw.withColumns({
        "ssn_hash": sha256_hex(F.col("ssn"), salt),
        "created_at": to_time(F.col("created_at").cast("string")),
        "ingested_at": now,
    })
    if drop_raw:
        typed = typed.withColumn("ssn", F.lit(None).cast("string"))
    return with_missing(typed, schemas.CUSTOMERS)


def merge_transactions(
    spark: SparkSession, raw: DataFrame, table: str, batch_ts: Column | None = None,
    on_duplicate: str = "reference",
) -> dict[str, int]:
    create_table(spark, table, schemas.TRANSACTIONS, schemas.TRANSACTIONS_LAYOUT)
    return upsert_table(
        spark, table, conform_transactions(raw, batch_ts), ["transaction_id"],
        schemas.TRANSACTION_UPDATES, None, on_duplicate, ["transaction_time", "ingested_at"])


def merge_customers(
    spark: SparkSession, raw: DataFrame, table: str, batch_ts: Column | None = None,
    on_duplicate: str = "reference",
) -> dict[str, int]:
    create_table(spark, table, schemas.CUSTOMERS, schemas.CUSTOMERS_LAYOUT)
    return upsert_table(
        spark, table, conform_customers(raw, batch_ts), ["customer_id"],
        schemas.CUSTOMER_UPDATES, None, on_duplicate, ["created_at", "ingested_at"])


def ingest_transactions(
    spark: SparkSession, raw_path: str, table: str = "conformed_db.transactions", rejects: str | None = None, **options,
) -> dict[str, int]:
    """All CSV files below ``raw_path`` into the conformed table.

    Lines that do not fit their file's header are counted as ``rejected`` and, with
    ``rejects``, appended there as ``file, value, reason``.
    """
    parsed = parse_transactions(spark, raw_path)
    if rejects:
        parsed.rejected.write.mode("append").parquet(rejects)
    return {**merge_transactions(spark, parsed.rows, table, **options), "rejected": parsed.rejected.count()}


def ingest_customers(
    spark: SparkSession, raw_path: str, table: str = "conformed_db.customers", **options,
) -> dict[str, int]:
    return merge_customers(spark, read_customers(spark, raw_path), table, **options)
