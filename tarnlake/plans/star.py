"""Conformed to consumption: customer dimension, transaction fact, sales mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.operators.star import fact_rows, mart_sales
from tarnlake.plans.ingest import ingest_customers, ingest_transactions
from tarnlake.session import batch_time, stage
from tarnlake.sinks.derived import properties
from tarnlake.sinks.exchange import remove
from tarnlake.sinks.tables import (
    changed_partitions, create_table, finish_pending, in_partitions, read_table, replace_partitions, scd2_table, upsert_table)
from tarnlake.sinks.versions import write_version


# Property of the fact: the batch time of the last run that was completed.
KEYED_UNTIL = "tarnlake.keyed-until"


def update_dimension(
    spark: SparkSession, customers: str = "conformed_db.customers",
    dimension: str = "consumption_db.dim_customers", batch_ts: Column | None = None, **options,
) -> bool:
    create_table(spark, dimension, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    fresh = spark.table(customers).select(
        [c for c in schemas.CUSTOMERS.names if c in schemas.DIM_CUSTOMERS.names and c != "ingested_at"])
    return scd2_table(spark, dimension, fresh, batch_ts=batch_ts, **options)


def update_fact(
    spark: SparkSession, transactions: str = "conformed_db.transactions",
    dimension: str = "consumption_db.dim_customers", fact: str = "consumption_db.fact_transactions",
    batch_ts: Column | None = None, changed_since: Column | None = None, incremental: bool = False,
) -> dict[str, int]:
    """Every transaction keyed to the current dimension and merged into the fact.

    ``changed_since`` limits the run to transactions ingested, or whose customer's
    open version began, at or after that time.  All keys come out the same; facts
    left out keep their ``ingested_at``, and their partitions are not rewritten.
    ``incremental`` takes the batch time of the last run that was completed, which
    the fact table keeps.
    """
    # One constant, so that what is kept is what rows are stamped with.
    now = spark.range(1).select((batch_time() if batch_ts is None else batch_ts).cast("timestamp").cast("string")).first()[0]
    create_table(spark, fact, schemas.FACT_TRANSACTIONS, schemas.FACT_LAYOUT)
    txns = read_table(spark, transactions, schemas.TRANSACTIONS)
    last = properties(spark, fact).get(KEYED_UNTIL) if incremental else None
    if changed_since is None and last:
        changed_since = F.lit(last).cast("timestamp")
    if changed_since is not None:
        txns = _changed(txns, spark.table(dimension), changed_since)
    rows = fact_rows(txns, spark.table(dimension), F.lit(now).cast("timestamp"))
    done = upsert_table(spark, fact, rows, ["transaction_id"], schemas.FACT_UPDATES, track=True)
    spark.sql(f"ALTER TABLE {fact} SET TBLPROPERTIES ('{KEYED_UNTIL}'='{now}')")
    return done


def _changed(txns: DataFrame, dim: DataFrame, since: Column) -> DataFrame:
    moved = dim.where(F.col("is_current") & (F.col("start_date") >= since)).select("customer_id")
    recent = F.coalesce(F.col("ingested_at") >= since, F.lit(True))
    return txns.where(recent).unionByName(txns.where(~recent).join(moved, "customer_id", "left_semi"))


def update_mart(
    spark: SparkSession, fact: str = "consumption_db.fact_transactions", mart: str = "consumption_db.mart_sales",
) -> dict[str, int]:
    """Keep the sales mart up to date: days with a changed partition in the fact are summed anew, others not read.

    The first run sums all days.  Merges into the fact note the days that rows leave and
    come to; the notes go once their days are in place, so a lost run is repeated.
    """
    finish_pending(spark, fact)
    fresh = not spark.catalog.tableExists(mart)
    changed, notes = changed_partitions(spark, fact)
    create_table(spark, mart, schemas.MART_SALES, schemas.MART_LAYOUT)
    if fresh or not notes and spark.table(mart).isEmpty():
        days = spark.table(fact).select("transaction_day").distinct()
    elif notes:
        days = changed.select("transaction_day").distinct()
    else:
        return {"rewritten": 0, "dropped": 0}
    # At most as many values as the fact has days.
    days = stage(days.select(F.col("transaction_day").alias("sales_day")), "mart-days")
    rows = mart_sales(in_partitions(spark.table(fact), days.withColumnRenamed("sales_day", "transaction_day"), ["transaction_day"]))
    done = replace_partitions(spark, mart, rows, days)
    remove(spark, notes)
    return done


def publish_mart(spark: SparkSession, root: str, version: str, fact: str = "consumption_db.fact_transactions") -> str:
    return write_version(mart_sales(spark.table(fact)), root, "mart_sales", version)


def run_all(spark: SparkSession, raw_transactions: str, raw_customers: str, batch_ts: str | None = None) -> None:
    """One batch through all zones: transactions, customers, dimension, fact, mart; the last two by what changed."""
    now = batch_time() if batch_ts is None else F.lit(batch_ts).cast("timestamp")
    ingest_transactions(spark, raw_transactions, batch_ts=now)
    ingest_customers(spark, raw_customers, batch_ts=now)
    update_dimension(spark, batch_ts=now)
    update_fact(spark, batch_ts=now, incremental=True)
    update_mart(spark)
