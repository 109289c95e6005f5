"""Maintenance, inventory and file queries.

File queries write the given tables to new folders in the shared folder, run the
file-based operators over them and return what a reader then finds.
"""

import posixpath
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parity.registry import check
from parity.star_checks import CHANGED, DIM, NOW, SCD2, TXN, TXN_UPDATES, merged_sql, wall_clock
from tarnlake import schemas
from tarnlake.functions.columns import iso_day, location_parts
from tarnlake.operators import star, upkeep
from tarnlake.plans import maintenance
from tarnlake.plans import star as plans_star
from tarnlake.session import new_path
from tarnlake.sinks import compaction, tables, versions
from tarnlake.sources import files
from tarnlake.streaming.ingest import ingest_stream

CUT = "2024-01-05 00:00:00"


def cut():
    return F.lit(CUT).cast("timestamp_ntz")


def event_versions(t):
    return t("events").select(
        F.col("user_id").alias("table"), F.col("event_id").alias("version"), F.col("ts").alias("committed_at"))


RANKED = """SELECT user_id AS "table", event_id AS version, ts AS committed_at, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events"""


@check(f"""SELECT "table", version, committed_at FROM ({RANKED})
    WHERE rn > 3 AND committed_at < TIMESTAMP '{CUT}'""")
def expired_versions(t):
    return upkeep.expired_versions(event_versions(t), cut())


@check(f"""SELECT "table", version, committed_at FROM ({RANKED}) WHERE rn <= 3""")
def retained_versions(t):
    return upkeep.retained_versions(event_versions(t))


@check(f"""SELECT path, length FROM v_files f WHERE modified < TIMESTAMP '{CUT}' AND NOT EXISTS (
      SELECT 1 FROM v_files r WHERE r.event_type IN ('purchase', 'view') AND r.path = f.path)""")
def orphan_files(t):
    used = t("v_files").where("event_type IN ('purchase', 'view')")
    return upkeep.orphan_files(t("v_files"), used, cut(), modified="modified").select("path", "length")


@check("""SELECT path, age_days, CASE WHEN age_days >= 365 THEN 'expire' ELSE 'archive' END AS action FROM (
      SELECT path, date_diff('day', CAST(modified AS DATE), DATE '2025-01-05') AS age_days FROM v_files)
    WHERE age_days >= 30""")
def lifecycle_plan(t):
    plan = upkeep.lifecycle_plan(t("v_files"), F.lit("2025-01-05").cast("date"), modified="modified")
    return plan.select("path", F.col("age_days").cast("long").alias("age_days"), "action")


@check("""SELECT folder, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes,
      CAST(greatest(ceil(sum(length) / 536870912.0), 1) AS INTEGER) AS target_files
    FROM (SELECT regexp_replace(path, '/[^/]*$', '') AS folder, length FROM v_files)
    WHERE length < 536870912 GROUP BY folder HAVING count(*) >= 5""")
def compaction_plan(t):
    listed = t("v_files").withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    return upkeep.compaction_plan(listed, ["folder"])


STORAGE = """SELECT array_to_string(p[1:d], '/') AS prefix, CAST(d AS INTEGER) AS depth,
      CAST(sum(length) AS BIGINT) AS bytes, count(*) AS files, max(modified) AS last_modified
    FROM (SELECT p, length, modified, unnest(range(1, least(len(p) - 1, 5) + 1)) AS d FROM (
      SELECT string_split(regexp_replace(path, '^[a-zA-Z0-9+.-]+:/+', ''), '/') AS p, length, modified FROM v_files))
    GROUP BY 1, 2"""


@check(STORAGE)
def storage_metrics(t):
    return upkeep.storage_metrics(t("v_files"), modified="modified")


@check(STORAGE)
def storage_csv(t):
    root, found = new_path(t.spark, "storage"), upkeep.storage_metrics(t("v_files"), modified="modified")
    versions.export_csv(found, root)
    return t.spark.read.schema(found.schema).options(header="true", timestampNTZFormat=versions.NTZ_TEXT).csv(root)


@check("""SELECT array_to_string(p[1:d], '/') AS prefix, CAST(d AS INTEGER) AS depth,
      CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files
    FROM (SELECT p, size, unnest(range(1, least(len(p) - 1, 5) + 1)) AS d FROM (
      SELECT string_split(regexp_replace(url, '^[a-zA-Z0-9+.-]+:/+', ''), '/') AS p, length(html) AS size FROM pages))
    GROUP BY 1, 2""")
def page_storage(t):
    sized = t("pages").select("url", F.length("html").alias("size"))
    return upkeep.storage_metrics(sized, path="url", size="size", modified=None)


@check("""SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (
      PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 4""")
def head_sample(t):
    return upkeep.head_sample(t("events").select("user_id", "event_id", "ts"), 4, ["user_id"], ["ts", "event_id"])


@check("""SELECT event_type, min(path) AS path FROM v_files
    WHERE path LIKE '%.csv' OR path LIKE '%.json' GROUP BY event_type""")
def first_sample_file(t):
    return upkeep.first_sample_file(t("v_files"), ["event_type"])


@check("""SELECT path, 'raw-zone' AS bucket, regexp_replace(path, '^s3://[^/]*/', '') AS prefix,
      regexp_extract(path, '([^/]*)$', 1) AS "table" FROM v_files""")
def location_split(t):
    return t("v_files").select("path", location_parts(F.col("path")).alias("x")).select("path", "x.*")


# --- files written and read back --------------------------------------------

DRIFT = {
    0: ["transaction_id", "customer_id", "amount", "product_category", "region_code", "promotion_code"],
    1: ["region_code", "product_category", "transaction_id", "amount", "customer_id"],
    2: ["device_type", "transaction_id", "amount", "region_code", "product_category", "customer_id"],
}
READ = ["transaction_id", "customer_id", "amount", "product_category", "region_code", "promotion_code",
        "device_type"]


def write_drifting_csv(t):
    """All transactions as CSV files whose headers differ in columns and order.

    The groups together hold every row; each has its own header.
    """
    root = new_path(t.spark, "drift")
    rows = t("v_txn").withColumns({
        "device_type": F.lit("iOS"), "product_category": F.concat("product_category", F.lit(", x"))})
    for group, header in DRIFT.items():
        rows.where(F.col("o_orderkey") % len(DRIFT) == group).select(*header).write.option(
            "header", "true").csv(f"{root}/event_date={group}")
    return root


DRIFTED = """SELECT transaction_id, customer_id, amount, concat(product_category, ', x') AS product_category,
      region_code, CASE WHEN o_orderkey % 3 = 0 THEN promotion_code END AS promotion_code,
      CASE WHEN o_orderkey % 3 = 2 THEN 'iOS' END AS device_type FROM v_txn"""


@check(DRIFTED)
def csv_by_header(t):
    rows = files.read_csv_by_header(t.spark, write_drifting_csv(t), "transaction_id", READ)
    return rows.withColumn("amount", F.col("amount").try_cast("double"))


@check("SELECT transaction_id, concat(transaction_id, '_', 39) AS w39, amount FROM v_txn")
def csv_wide(t):
    root = new_path(t.spark, "wide")
    fill = [F.concat("transaction_id", F.lit(f"_{i}")).alias(f"w{i}") for i in range(40)]
    t("v_txn").select("amount", *fill, "transaction_id").write.option("header", "true").csv(root)
    rows = files.read_csv_by_header(t.spark, root, "transaction_id", ["transaction_id", "w39", "amount"])
    return rows.withColumn("amount", F.col("amount").try_cast("double"))


@check("""SELECT transaction_id, CASE WHEN o_orderkey % 7 = 0 THEN '4 cells below a header of 3' END AS reason
    FROM v_txn""")
def csv_rejected(t):
    """Every seventh order has a cell too many: rows and rejected lines together are all rows."""
    root = new_path(t.spark, "odd")
    cell = F.when(F.col("o_orderkey") % 7 == 0, "a,b").otherwise("a")
    # Quoted by a character that means nothing to the reader, so that the comma separates cells.
    t("v_txn").select("transaction_id", "customer_id", cell.alias("x")).write.options(
        header="true", quote="\x01").csv(root)
    parsed = files.split_csv_by_header(t.spark, root, "transaction_id", ["transaction_id"])
    return parsed.rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
        parsed.rejected.select(F.split("value", ",")[0].alias("transaction_id"), "reason"))


@check("""SELECT 'transactions' AS "table", c AS "column", k AS type, p AS is_partition FROM (VALUES
    ('amount', 'double', false), ('customer_id', 'string', false), ('device_type', 'string', false),
    ('product_category', 'string', false), ('promotion_code', 'string', false), ('region_code', 'string', false),
    ('transaction_id', 'string', false), ('event_date', 'string', true)) x(c, k, p)""")
def discover_schema(t):
    return files.discover_schema(t.spark, write_drifting_csv(t), "transactions")


@check("SELECT customer_id, first_name, email, ssn, region_code FROM v_customers")
def json_customers(t):
    root = new_path(t.spark, "customers")
    t("v_customers").drop("c_custkey").write.json(root)
    return files.read_customers(t.spark, root).select("customer_id", "first_name", "email", "ssn", "region_code")


def new_table(t, schema, layout, **options):
    name = "parity_" + posixpath.basename(new_path(t.spark, "t")).replace("-", "_")
    tables.create_table(t.spark, name, schema, layout, location=new_path(t.spark, "table"), **options)
    return name


def fields(schema, names):
    return StructType([f for f in schema.fields if f.name in names])


@check(DRIFTED)
def stream_ingested(t):
    name = new_table(t, schemas.TRANSACTIONS, ["region_code"])
    ingest_stream(t.spark, write_drifting_csv(t), name, new_path(t.spark, "stream")).awaitTermination()
    return tables.read_table(t.spark, name).select(*READ)


@check(SCD2, changed=CHANGED)
def scd2_stored_table(t):
    name = new_table(t, fields(schemas.DIM_CUSTOMERS, DIM), schemas.DIM_CUSTOMERS_LAYOUT)
    tables.append_table(t.spark, name, t("v_dim"))
    tables.scd2_table(t.spark, name, t("v_fresh"), batch_ts=F.lit(NOW).cast("timestamp"),
                      surrogate=star.replayable_key)
    return wall_clock(tables.read_table(t.spark, name).select(*DIM), "start_date", "end_date")


LAYOUT = ["region_code"]
def stored_transactions(t):
    """A stored table holding all transactions."""
    name = new_table(t, fields(schemas.TRANSACTIONS, TXN), LAYOUT)
    tables.append_table(t.spark, name, t("v_txn").select(*TXN))
    return name


@check(merged_sql(TXN, TXN_UPDATES, "v_txn", "v_txn_batch", "transaction_id"))
def upsert_stored_table(t):
    name = stored_transactions(t)
    tables.upsert_table(t.spark, name, t("v_txn_batch"), ["transaction_id"], TXN_UPDATES)
    return wall_clock(tables.read_table(t.spark, name).select(*TXN), "transaction_time")


@check(f"""SELECT event_id, ts, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-02 12:00:00' AND ts < TIMESTAMP '{CUT}'""")
def stored_between(t):
    """A table whose days come from a column of its own."""
    name = new_table(t, t("events").schema, ["event_day", "event_type"], day_columns={"event_day": "ts"})
    tables.append_table(t.spark, name, t("events"))
    return tables.table_between(t.spark, name, "2024-01-02 12:00:00", CUT, "ts").select("event_id", "ts", "event_type")


@check("""SELECT date_trunc('month', ts)::DATE AS event_month, count(*) AS n FROM events
    WHERE ts >= TIMESTAMP '2024-01-02 12:00:00' GROUP BY 1""")
def stored_months(t):
    """A table partitioned by month, after a merge that moves nothing."""
    name = new_table(t, t("events").schema, ["event_month"], day_columns={"event_month": "month(ts)"})
    tables.append_table(t.spark, name, t("events").where("event_id % 2 = 0"))
    tables.upsert_table(t.spark, name, t("events"), ["event_id"], ["value"])
    rows = t.spark.table(name).where("ts >= TIMESTAMP_NTZ '2024-01-02 12:00:00'")
    return rows.groupBy("event_month").agg(F.count(F.lit(1)).alias("n"))


@check("""SELECT transaction_id, amount, region_code FROM v_txn""")
def compacted_table(t):
    """Each region has a file that is too large to be merged, or several, and eight small ones."""
    name = new_table(t, fields(schemas.TRANSACTIONS, ["transaction_id", "amount", "region_code"]), ["region_code"])
    rows = t("v_txn").select("transaction_id", "amount", "region_code", "o_orderkey")
    tables.append_table(t.spark, name, rows.where("o_orderkey % 8 <> 0").drop("o_orderkey"))
    with tables.writing(t.spark):
        rows.where("o_orderkey % 8 = 0").drop("o_orderkey").repartition(8).write.insertInto(name)
    sizes = tables.table_files(t.spark, name).groupBy("partition").agg(F.max("length").alias("n"))
    compaction.compact_table(t.spark, name, max_bytes=sizes.agg(F.min("n")).first()[0])
    return tables.read_table(t.spark, name)


@check("""SELECT folder, path, "group" FROM (SELECT *, CAST(floor((sum(length) OVER (PARTITION BY folder ORDER BY length, path
        ROWS UNBOUNDED PRECEDING) - length) / 536870912) AS BIGINT) AS "group", count(*) OVER (PARTITION BY folder) AS n
      FROM (SELECT regexp_replace(path, '/[^/]*$', '') AS folder, path, length FROM v_files WHERE length < 536870912))
    WHERE n >= 5 QUALIFY count(*) OVER (PARTITION BY folder, "group") > 1""")
def compaction_groups(t):
    listed = t("v_files").withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    return upkeep.compaction_groups(listed, ["folder"]).select("folder", "path", "group")


@check("""SELECT region_code, count(*) AS n FROM v_txn GROUP BY region_code""")
def published_version(t):
    root = new_path(t.spark, "mart")
    versions.write_version(t("v_txn").groupBy("region_code").agg(F.count(F.lit(1)).alias("n")), root, "m", "1")
    return versions.read_latest(t.spark, root)


MOVED = """SELECT transaction_id, customer_id, amount, product_id, product_category,
      CASE WHEN o_orderkey % 4 < 2 THEN 'MOVED' ELSE region_code END AS region_code,
      transaction_time + INTERVAL 3 DAY AS transaction_time, promotion_code
    FROM v_txn WHERE o_orderkey % 3 = 0"""


@check(merged_sql(TXN, TXN_UPDATES, "v_txn", "moved", "transaction_id"), moved=MOVED)
def upsert_moved_rows(t):
    """A merge that changes region and day, so that matched rows change their partition."""
    name = new_table(t, fields(schemas.TRANSACTIONS, TXN), LAYOUT)
    tables.append_table(t.spark, name, t("v_txn").select(*TXN))
    tables.upsert_table(t.spark, name, t.sql(f"SELECT * FROM ({MOVED})"), ["transaction_id"], TXN_UPDATES)
    return wall_clock(tables.read_table(t.spark, name).select(*TXN), "transaction_time")


SALES = """SELECT CAST(event_id AS STRING) transaction_id, CAST(user_id AS STRING) customer_id, {amount} amount,
    event_type region_code, 'any' product_category, {time} transaction_time FROM events"""
FIRST = SALES.format(amount="value", time="ts") + " WHERE event_id % 10 <> 0"
# A quarter of the rows is corrected and moves to the next day; a tenth is new.
SECOND = SALES.format(amount="value + 1", time="ts + INTERVAL 1 DAY") + " WHERE event_id % 4 = 0 OR event_id % 10 = 0"
MERGED = """SELECT * FROM second UNION ALL SELECT * FROM first WHERE transaction_id NOT IN (SELECT transaction_id FROM second)"""
MART = """SELECT CAST(transaction_time AS DATE) AS sales_day, region_code, product_category, count(*) AS transactions,
      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS avg_amount,
      count(DISTINCT customer_id) AS customers
    FROM merged GROUP BY 1, 2, 3"""


def two_batches(t, between=lambda name: None):
    """A stored fact after two merges, with a step of the caller's after each."""
    name = new_table(t, schemas.FACT_TRANSACTIONS, schemas.FACT_LAYOUT)
    for text in (FIRST, SECOND):
        t("events")
        tables.upsert_table(t.spark, name, t.sql(text), ["transaction_id"], ["amount", "transaction_time"], track=True)
        between(name)
    return name


@check(MART, first=FIRST, second=SECOND, merged=MERGED)
def mart_incremental(t):
    """The mart after two batches, each of which sums the days it changed."""
    mart = new_table(t, schemas.MART_SALES, schemas.MART_LAYOUT)
    two_batches(t, lambda name: plans_star.update_mart(t.spark, name, mart))
    return t.spark.table(mart)


@check("""SELECT DISTINCT CAST(transaction_time AS DATE) AS transaction_day FROM first
    UNION SELECT CAST(transaction_time AS DATE) FROM second
    UNION SELECT CAST(f.transaction_time AS DATE) FROM first f JOIN second s ON f.transaction_id = s.transaction_id""",
       first=FIRST, second=SECOND)
def changed_days(t):
    """Days that rows left or came to, as two tracked merges noted them."""
    return tables.changed_partitions(t.spark, two_batches(t))[0].select("transaction_day").distinct()


@check("""SELECT t AS "table", step, ok, message FROM (
      SELECT 'stored' AS t, 'compact' AS step, true AS ok, concat(CAST(count(DISTINCT region_code) AS STRING), ' partitions') AS message FROM v_txn
      UNION ALL SELECT 'stored', 'expire', true, '2 versions' FROM (SELECT 1)
      UNION ALL SELECT 'stored', 'orphans', true, concat(CAST(count(DISTINCT region_code) AS STRING), ' files') FROM v_txn
      UNION ALL SELECT 'absent', 'compact', false, 'AnalysisException' FROM (SELECT 1))""")
def maintain_status(t):
    name, root, stray = maintained(t)
    status = maintenance.maintain(
        t.spark, f"absent_{name}, {name}", version_roots={name: root}, listed_roots={name: stray}, now=datetime(2100, 1, 1, tzinfo=timezone.utc))
    return status.withColumn("table", F.when(F.col("table") == name, "stored").otherwise("absent")).withColumn(
        "message", F.substring_index("message", ":", 1))


def maintained(t):
    """A stored table of eight small files a region, five versions of a result, and files that no table reads."""
    name = new_table(t, fields(schemas.TRANSACTIONS, ["transaction_id", "amount", "region_code"]), ["region_code"])
    rows = t("v_txn").select("transaction_id", "amount", "region_code")
    with tables.writing(t.spark):
        rows.repartition(8).write.insertInto(name)
    root, stray = new_path(t.spark, "versions"), new_path(t.spark, "stray")
    for version in range(5):
        versions.write_version(t("v_txn").groupBy("region_code").agg(F.count("*").alias("n")), root, "mart", str(version))
    with tables.writing(t.spark):
        rows.repartition("region_code").write.partitionBy("region_code").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(stray)
    return name, root, stray


@check("SELECT DISTINCT concat('region_code=', region_code) AS folder FROM v_txn")
def orphans_in_table(t):
    """Files below the table's own folder that it does not read: those of partitions unknown to it."""
    name = new_table(t, fields(schemas.TRANSACTIONS, ["transaction_id", "amount", "region_code"]), ["region_code"])
    rows = t("v_txn").select("transaction_id", "amount", "region_code")
    tables.append_table(t.spark, name, rows)
    with tables.writing(t.spark):
        rows.hint("rebalance", F.col("region_code")).write.partitionBy("region_code").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tables.table_location(t.spark, name)}/left-over")
    found = maintenance.maintain_all(t.spark, name, now=datetime(2100, 1, 1, tzinfo=timezone.utc)).orphans
    left = found.where("path LIKE '%/left-over/%'")
    return left.select(F.regexp_extract("path", "/([^/]*)/[^/]*$", 1).alias("folder")).distinct()


@check("SELECT transaction_id, amount, region_code FROM v_txn")
def empty_batch(t):
    """A merge of no rows leaves the table as it is."""
    name = stored_transactions(t)
    tables.upsert_table(t.spark, name, t("v_txn_batch").limit(0), ["transaction_id"], TXN_UPDATES)
    return tables.read_table(t.spark, name).select("transaction_id", "amount", "region_code")


@check("SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS n FROM events GROUP BY 1")
def iso_days(t):
    return t("events").groupBy(iso_day(F.col("ts")).alias("event_day")).agg(F.count("*").alias("n"))


@check("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (
      PARTITION BY user_id % 2 ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 2000""")
def head_of_hot_groups(t):
    """More rows a group than Spark cuts before the shuffle."""
    rows = t("events").withColumn("half", F.col("user_id") % 2)
    return upkeep.head_sample(rows, 2000, ["half"], ["ts", "event_id"]).select("user_id", "event_id")
