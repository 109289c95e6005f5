"""Lakehouse relations derived from the test tables.

Each text runs unchanged in Spark SQL and in DuckDB.  Every view covers all rows
of its tables; arithmetic on ids only decides what a row looks like.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "v_customers": """
        SELECT concat('CUST_', CAST(100000 + c_custkey AS STRING)) customer_id, c_custkey,
          c_mktsegment first_name, c_name last_name,
          concat(lower(replace(c_name, '#', '.')), '@example.com') email,
          concat('+1-', CAST(200 + c_custkey % 800 AS STRING), '-', CAST(200 + (c_custkey * 7) % 800 AS STRING),
            '-', CAST(1000 + (c_custkey * 13) % 9000 AS STRING)) phone_number,
          concat(CAST(100 + c_custkey % 900 AS STRING), '-', CAST(10 + c_custkey % 90 AS STRING), '-',
            CAST(1000 + c_custkey % 9000 AS STRING)) ssn,
          n_name country,
          CASE r_name WHEN 'ASIA' THEN 'APAC' WHEN 'EUROPE' THEN 'EU' WHEN 'AMERICA' THEN 'US'
            WHEN 'AFRICA' THEN 'LATAM' ELSE 'ME' END region_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_txn": """
        SELECT concat('TXN_', CAST(o_orderkey AS STRING)) transaction_id, o_orderkey,
          concat('CUST_', CAST(100000 + o_custkey AS STRING)) customer_id, o_totalprice amount,
          concat('PROD_', CAST(1000 + o_orderkey % 9000 AS STRING)) product_id,
          o_orderpriority product_category, region_code, o_orderdate transaction_time,
          CASE WHEN o_orderkey % 7 = 0 THEN concat('SUMMER_', CAST(10 + o_orderkey % 41 AS STRING)) END promotion_code
        FROM orders JOIN v_customers ON o_custkey = c_custkey""",
    # Four fifths of the keys match; the rest are new, repeated in pairs, or NULL.
    "v_txn_batch": """
        SELECT CASE WHEN o_orderkey % 35 = 0 THEN NULL
            WHEN o_orderkey % 5 = 0 THEN concat('NEW_', CAST(o_orderkey - o_orderkey % 10 AS STRING))
            ELSE transaction_id END transaction_id,
          'CUST_X' customer_id, amount + 1 amount, product_id, product_category, 'APAC' region_code,
          transaction_time, CASE WHEN o_orderkey % 3 = 0 THEN promotion_code END promotion_code
        FROM v_txn""",
    "v_dim": """
        SELECT concat(customer_id, '|0') customer_key, customer_id, first_name, last_name, email, phone_number,
          ssn, country, region_code, TIMESTAMP_NTZ '2024-01-01 00:00:00' start_date,
          CASE WHEN c_custkey % 10 >= 8 THEN TIMESTAMP_NTZ '2024-06-01 00:00:00' END end_date,
          c_custkey % 10 < 8 is_current
        FROM v_customers""",
    "v_fresh": """
        SELECT CASE WHEN c_custkey % 13 = 0 THEN concat('N', customer_id) ELSE customer_id END customer_id,
          first_name, CASE WHEN c_custkey % 5 = 0 THEN 'Renamed' ELSE last_name END last_name,
          CASE WHEN c_custkey % 7 = 0 THEN concat('new.', email) ELSE email END email,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE phone_number END phone_number, ssn, country,
          CASE WHEN c_custkey % 17 = 0 THEN 'ME' ELSE region_code END region_code
        FROM v_customers""",
    "v_query_log": """
        SELECT event_id, CAST(user_id AS STRING) user_arn, ts event_time,
          CASE WHEN event_type = 'click' THEN 'StopQueryExecution' ELSE 'StartQueryExecution' END event_name,
          CASE WHEN user_id % 2 = 0 THEN 'marketing_workgroup' ELSE 'finance_workgroup' END workgroup,
          CASE event_id % 5
            WHEN 0 THEN 'SELECT * FROM conformed_db.transactions WHERE event_date BETWEEN ''2025-02-03'' AND ''2025-02-09'''
            WHEN 1 THEN 'SELECT product_id, max(amount) FROM conformed_db.transactions GROUP BY product_id'
            WHEN 2 THEN 'SELECT country, phone_number FROM consumption_db.dim_customers WHERE region_code IN (''ME'', ''EU'')'
            WHEN 3 THEN '  SELECT d.* FROM consumption_db.dim_customers d  '
            ELSE 'SELECT * FROM conformed_db.transactions ORDER BY amount' END sql_text,
          concat('{"bytesScanned":"', CAST(CAST(event_id % 997 AS BIGINT) * 200000000 AS STRING), '"}')
            additional_event_data,
          CASE event_type WHEN 'signup' THEN 'raw' WHEN 'purchase' THEN 'conformed' ELSE 'consumption' END zone
        FROM events""",
    # Nine orders make a catalogue table of nine columns.
    "v_columns": """
        SELECT CASE CAST((o_orderkey - o_orderkey % 9) / 9 AS BIGINT) % 4 WHEN 0 THEN 'raw_db'
            WHEN 1 THEN 'conformed_db' WHEN 2 THEN 'consumption_db' ELSE 'scratch_db' END db,
          CASE WHEN o_orderkey < 36 THEN 'transactions' WHEN o_orderkey < 72 THEN 'customers'
            WHEN o_orderkey < 108 THEN 'dim_customers'
            ELSE concat('t_', CAST(o_orderkey - o_orderkey % 9 AS STRING)) END tbl,
          CASE o_orderkey % 9 WHEN 0 THEN 'ssn' WHEN 1 THEN 'email' WHEN 2 THEN 'Phone_Number'
            WHEN 3 THEN 'customer_id' WHEN 4 THEN 'amount' WHEN 5 THEN 'cc-num' WHEN 6 THEN 'first_name'
            WHEN 7 THEN 'region_code' ELSE 'social-security' END col,
          o_orderkey, o_custkey
        FROM orders""",
    # One tag per order: a table tag or the PII tag of a column, some not allowed.
    "v_tags": """
        SELECT db, tbl, CASE WHEN o_orderkey % 9 >= 7 THEN '' ELSE col END col,
          CASE o_orderkey % 9 WHEN 7 THEN 'BU'
            WHEN 8 THEN CASE WHEN o_custkey % 11 = 0 THEN 'Tier' ELSE 'Sensitivity' END ELSE 'PII' END tag,
          CASE o_orderkey % 9
            WHEN 7 THEN CASE o_custkey % 3 WHEN 0 THEN 'finance' WHEN 1 THEN 'operations' ELSE 'analytics' END
            WHEN 8 THEN CASE o_custkey % 5 WHEN 0 THEN 'public' WHEN 1 THEN 'internal' WHEN 2 THEN 'confidential'
              WHEN 3 THEN 'restricted' ELSE 'secret' END
            ELSE CASE o_custkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'quasi' WHEN 2 THEN 'direct'
              ELSE 'unsure' END END val
        FROM v_columns""",
    "v_files": """
        SELECT concat('s3://raw-zone/', event_type, '/user=', CAST(user_id AS STRING), '/part-',
            CAST(event_id AS STRING),
            CASE event_id % 3 WHEN 0 THEN '.parquet' WHEN 1 THEN '.json' ELSE '.csv' END) path,
          (event_id * 7919) % 700000000 length, ts modified, event_type, value
        FROM events""",
}


def needed_views(sql: str) -> list[str]:
    """Views a text uses, each after the ones it depends on."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+\b", text):
            if name in VIEWS and name not in found:
                visit(VIEWS[name])
                found.append(name)

    visit(sql)
    return found


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` as one statement that carries the views it needs."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in needed_views(sql + " ".join((extra or {}).values()))]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + sql


class Tables:
    """Base tables and views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.opened: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in BASE:
            return self.sql(f"SELECT * FROM {name}")
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def sql(self, text: str) -> DataFrame:
        full = with_views(text)
        for name in BASE:
            if re.search(rf"\b{name}\b", full):
                self(name).createOrReplaceTempView(name)
        return self.spark.sql(full)
