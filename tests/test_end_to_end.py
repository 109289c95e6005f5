"""Generated raw files through all zones, then governance over the stored tables."""

from pyspark.sql import functions as F

from generate import transactions, write_raw
from tarnlake.operators.pii import detect_pii
from tarnlake.plans.governance import TAG_COLUMNS, pii_scan, reconcile_tags
from tarnlake.plans.star import run_all
from tarnlake.sources.catalog import catalog_columns
from tarnlake.sources.policy import local_rows, policy_tables


def test_generated_batch(spark, tmp_path):
    for db in ("conformed_db", "consumption_db"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    txn_dir, customer_dir = write_raw(spark, str(tmp_path), n=2000, n_customers=300)
    run_all(spark, txn_dir, customer_dir, "2026-03-01 00:00:00")

    expected = transactions(spark, 2000, 300)
    stored = spark.table("conformed_db.transactions")
    same = ["transaction_id", "customer_id", "product_id", "product_category", "region_code", "event_date",
            "promotion_code", "device_type"]
    assert stored.select(same).exceptAll(expected.select(same)).isEmpty() and stored.count() == 2000
    total = F.sum(F.col("amount").cast("decimal(18,2)"))
    assert stored.agg(total).first()[0] == expected.agg(total).first()[0]
    fact = spark.table("consumption_db.fact_transactions")
    assert fact.count() == 2000 and fact.where("customer_key = 'UNKNOWN'").isEmpty()
    assert fact.join(spark.table("consumption_db.dim_customers"), "customer_key").count() == 2000

    found = {r.column for r in detect_pii(spark.table("conformed_db.customers")).collect()}
    # The hash column is flagged by its name, as the name rule says.
    assert found == {"email", "phone_number", "ssn", "ssn_hash"}

    rules, known = policy_tables(spark), catalog_columns(spark, ["conformed_db", "consumption_db"])
    tags = pii_scan(spark, {("conformed_db", "customers"): lambda: spark.table("conformed_db.customers")},
                    local_rows(spark, [], TAG_COLUMNS))
    result = reconcile_tags(known, rules, tags)
    healed = {(r.table, r.column): r.value for r in result.tags.where(
        "database = 'conformed_db' AND tag = 'PII'").collect()}
    assert healed[("customers", "ssn_hash")] == "none" and healed[("customers", "ssn")] == "direct"
    assert result.missing.isEmpty()
