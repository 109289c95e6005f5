"""Ingest, upsert and star-schema queries."""

from pyspark.sql import functions as F

from parity.registry import check
from tarnlake.functions.columns import normalize_columns, sha256_hex, to_double, to_time
from tarnlake.operators import star
from tarnlake.operators.upsert import dedupe_latest, duplicate_keys, upsert
from tarnlake.plans.ingest import conform_customers, conform_transactions
from tarnlake.sinks.tables import between_time

NOW = "2026-01-01 00:00:00"
TXN = ["transaction_id", "customer_id", "amount", "product_id", "product_category", "region_code",
       "transaction_time", "promotion_code"]
TXN_UPDATES = ["amount", "product_id", "product_category", "region_code", "transaction_time", "promotion_code"]
CUSTOMER = ["customer_id", "first_name", "last_name", "email", "phone_number", "ssn", "country", "region_code"]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def wall_clock(df, *columns):
    """Zoned timestamps as the wall-clock time DuckDB shows."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def merged_sql(columns, updates, target, source, key):
    """SQL of a merge: matched rows take ``updates``, unmatched source rows are added."""
    kept = ", ".join(
        f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" if c in updates else f"t.{c}"
        for c in columns)
    added = ", ".join(f"s.{c}" for c in columns)
    return f"""
        SELECT {kept} FROM {target} t LEFT JOIN {source} s ON t.{key} = s.{key}
        UNION ALL
        SELECT {added} FROM {source} s
        WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = s.{key})"""


@check("""
    SELECT concat('TXN_', CAST(o_orderkey AS VARCHAR)) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
      CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS amount, o_orderpriority AS product_category,
      CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS transaction_time,
      strftime(o_orderdate, '%Y-%m-%d') AS event_date, CAST(NULL AS VARCHAR) AS device_type,
      TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
    FROM orders""")
def ingest_typed(t):
    raw = t("orders").select(
        F.concat(F.lit("TXN_"), "o_orderkey").alias(" Transaction_ID"),
        F.col("o_custkey").cast("string").alias("CUSTOMER_ID"),
        F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("Amount "),
        F.col("o_orderpriority").alias("Product_Category"),
        F.when(F.col("o_orderkey") % 4 == 0, "not a time").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("Transaction_Time"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"))
    typed = conform_transactions(raw, F.lit(NOW).cast("timestamp")).select(
        "transaction_id", "customer_id", "amount", "product_category", "transaction_time", "event_date",
        "device_type", "ingested_at")
    return wall_clock(typed, "transaction_time", "ingested_at")


@check("""
    SELECT customer_id, first_name, last_name, email, phone_number, ssn, sha256(ssn) AS ssn_hash, country,
      region_code, TIMESTAMP '2024-02-03 04:05:06' AS created_at, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
    FROM v_customers""")
def ingest_customers(t):
    raw = t("v_customers").drop("c_custkey").withColumn("created_at", F.lit("2024-02-03T04:05:06"))
    return wall_clock(conform_customers(raw, F.lit(NOW).cast("timestamp")), "created_at", "ingested_at")


@check("""
    SELECT c_custkey AS custkey, TRY_CAST(concat(CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END,
        CAST(c_custkey AS VARCHAR)) AS DOUBLE) AS amount, sha256(c_name) AS name_hash,
      sha256(concat('salt', c_name)) AS salted_hash
    FROM customer""")
def scalar_clean(t):
    named = normalize_columns(t("customer").select(F.col("c_custkey").alias(" CustKey "), F.col("c_name").alias("N")))
    text = F.concat(F.when(F.col("custkey") % 3 == 0, "x").otherwise(""), F.col("custkey").cast("string"))
    return named.select(
        "custkey", to_double(text).alias("amount"), sha256_hex(F.col("n")).alias("name_hash"),
        sha256_hex(F.col("n"), "salt").alias("salted_hash"))


@check("""
    SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed
    FROM events""")
def parse_times(t):
    text = F.when(F.col("event_id") % 6 == 0, F.lit("31/12/2024")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return t("events").select("event_id", to_time(text).cast("timestamp_ntz").alias("parsed"))


@check(merged_sql(TXN, TXN_UPDATES, "v_txn", "v_txn_batch", "transaction_id"))
def upsert_transactions(t):
    return upsert(t("v_txn").select(*TXN), t("v_txn_batch"), ["transaction_id"], TXN_UPDATES, TXN)


@check(merged_sql(CUSTOMER, CUSTOMER[1:], "v_customers", "v_fresh", "customer_id"))
def upsert_customers(t):
    return upsert(t("v_customers").select(*CUSTOMER), t("v_fresh"), ["customer_id"], CUSTOMER[1:], CUSTOMER)


LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
LINE_ORDER = "l_shipdate DESC, l_quantity DESC, l_extendedprice DESC"


@check("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
          l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1""")
def dedupe_latest_lines(t):
    return dedupe_latest(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(*LINE)


# Order rows are the target; lines, several per order, the source.
@check(f"""
    SELECT o_orderkey, CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_extendedprice ELSE o_totalprice END AS o_totalprice,
      CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_shipdate ELSE o_orderdate END AS o_orderdate
    FROM orders LEFT JOIN (
      SELECT * FROM (SELECT l_orderkey, l_extendedprice, l_shipdate, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1
    ) s ON o_orderkey = s.l_orderkey""")
def upsert_latest(t):
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"))
    target = t("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return upsert(target, lines, ["o_orderkey"], ["o_totalprice", "o_orderdate"], target.columns,
                  on_duplicate="latest", order_by=["o_orderdate"])


@check("""
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_keys(t):
    target = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"], target)


@check("""
    SELECT customer_key, customer_id,
      CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM v_fresh WHERE phone_number IS NULL)
        THEN false ELSE is_current END AS is_current,
      CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM v_fresh WHERE phone_number IS NULL)
        THEN TIMESTAMP '2026-01-01 00:00:00' ELSE end_date END AS end_date
    FROM v_dim""")
def expire_dimension(t):
    gone = t("v_fresh").where("phone_number IS NULL")
    return star.expire_current(t("v_dim"), gone, "customer_id", now()).select(
        "customer_key", "customer_id", "is_current", "end_date")


DIM = ["customer_key", *CUSTOMER, "start_date", "end_date", "is_current"]


def scd2_sql(differs):
    changed = f"""
        SELECT f.* FROM v_fresh f LEFT JOIN v_dim d ON f.customer_id = d.customer_id AND d.is_current
        WHERE d.customer_id IS NULL OR {differs}"""
    columns = ", ".join(CUSTOMER)
    return f"""
        SELECT customer_key, {columns}, start_date,
          CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM changed)
            THEN TIMESTAMP '{NOW}' ELSE end_date END AS end_date,
          is_current AND customer_id NOT IN (SELECT customer_id FROM changed) AS is_current
        FROM v_dim
        UNION ALL
        SELECT sha256(concat(customer_id, '|', '{NOW}')), {columns}, TIMESTAMP '{NOW}', NULL, true
        FROM changed""", changed


SCD2, CHANGED = scd2_sql(
    "f.email <> d.email OR f.phone_number <> d.phone_number OR f.region_code <> d.region_code")
SCD2_SAFE, CHANGED_SAFE = scd2_sql(
    "f.email IS DISTINCT FROM d.email OR f.phone_number IS DISTINCT FROM d.phone_number "
    "OR f.region_code IS DISTINCT FROM d.region_code")


@check(SCD2, changed=CHANGED)
def scd2_customers(t):
    return star.scd2_apply(t("v_dim"), t("v_fresh"), batch_ts=now(), surrogate=star.replayable_key).select(*DIM)


@check(SCD2_SAFE, changed=CHANGED_SAFE)
def scd2_null_safe(t):
    return star.scd2_apply(
        t("v_dim"), t("v_fresh"), batch_ts=now(), surrogate=star.replayable_key, null_safe=True).select(*DIM)


FACT_ROWS = """
    SELECT t.transaction_id, coalesce(d.customer_key, 'UNKNOWN') AS customer_key, t.customer_id, t.amount,
      t.product_id, t.product_category, t.region_code, t.transaction_time, t.promotion_code,
      TIMESTAMP_NTZ '2026-01-01 00:00:00' AS ingested_at
    FROM {source} t LEFT JOIN v_dim d ON t.customer_id = d.customer_id AND d.is_current"""
FACT = ["transaction_id", "customer_key", "customer_id", "amount", "product_id", "product_category",
        "region_code", "transaction_time", "promotion_code", "ingested_at"]


@check(FACT_ROWS.format(source="v_txn"))
def fact_transactions(t):
    return star.fact_rows(t("v_txn").drop("o_orderkey"), t("v_dim"), now())


@check(merged_sql(FACT, [c for c in FACT if c not in ("transaction_id", "customer_id")],
                  "old_fact", "new_fact", "transaction_id"),
       old_fact="""SELECT transaction_id, 'UNKNOWN' customer_key, customer_id, amount - 1 amount, product_id,
          product_category, region_code, transaction_time, promotion_code, transaction_time ingested_at FROM v_txn""",
       new_fact=FACT_ROWS.format(source="v_txn_batch"))
def upsert_fact(t):
    old = t("v_txn").select(
        "transaction_id", F.lit("UNKNOWN").alias("customer_key"), "customer_id",
        (F.col("amount") - 1).alias("amount"), "product_id", "product_category", "region_code",
        "transaction_time", "promotion_code", F.col("transaction_time").alias("ingested_at"))
    return star.build_fact(t("v_txn_batch"), t("v_dim"), old, now()).select(*FACT)


@check("""
    SELECT strftime(transaction_time, '%Y-%m-%d') AS sales_day, region_code, product_category,
      count(*) AS transactions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS avg_amount,
      count(DISTINCT customer_id) AS customers
    FROM v_txn GROUP BY 1, 2, 3""")
def mart_sales(t):
    return star.mart_sales(t("v_txn")).withColumn("sales_day", F.col("sales_day").cast("string"))


@check("""
    SELECT transaction_id, transaction_time, amount FROM v_txn
    WHERE transaction_time >= TIMESTAMP '1997-01-01 00:00:00' AND transaction_time < TIMESTAMP '1998-07-01 00:00:00'""")
def transactions_between(t):
    rows = between_time(t("v_txn"), "1997-01-01 00:00:00", "1998-07-01 00:00:00")
    return rows.select("transaction_id", "transaction_time", "amount")


@check("SELECT transaction_id, amount, region_code FROM v_txn ORDER BY transaction_id")
def ordered_transactions(t):
    return t("v_txn").select("transaction_id", "amount", "region_code").orderBy("transaction_id")
