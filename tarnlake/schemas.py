"""Fixed schemas, partition layouts and upsert column lists of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    "bigint": T.LongType(), "date": T.DateType(),
}


def _schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


# Raw files arrive as text; typing happens in plans.ingest.
RAW_TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "amount", "product_id", "product_category",
    "region_code", "transaction_time", "event_date", "promotion_code", "device_type",
]

RAW_CUSTOMERS = _schema(
    customer_id="string", first_name="string", last_name="string", email="string",
    phone_number="string", ssn="string", country="string", region_code="string",
    created_at="string",
)

# Stored table schemas.
TRANSACTIONS = _schema(
    transaction_id="string", customer_id="string", amount="double", product_id="string",
    product_category="string", region_code="string", transaction_time="timestamp",
    event_date="string", promotion_code="string", device_type="string",
    ingested_at="timestamp",
)
CUSTOMERS = _schema(
    customer_id="string", first_name="string", last_name="string", email="string",
    phone_number="string", ssn="string", ssn_hash="string", country="string",
    region_code="string", created_at="timestamp", ingested_at="timestamp",
)
DIM_CUSTOMERS = _schema(
    customer_key="string", customer_id="string", first_name="string", last_name="string",
    email="string", phone_number="string", ssn="string", ssn_hash="string",
    country="string", region_code="string", start_date="timestamp", end_date="timestamp",
    is_current="boolean", ingested_at="timestamp",
)
FACT_TRANSACTIONS = _schema(
    transaction_id="string", customer_key="string", customer_id="string", amount="double",
    product_id="string", product_category="string", region_code="string",
    transaction_time="timestamp", event_date="string", promotion_code="string",
    ingested_at="timestamp",
)

MART_SALES = _schema(
    region_code="string", product_category="string", transactions="bigint", revenue="double", avg_amount="double",
    customers="bigint", sales_day="date",
)

# Derived day columns stand in for a days(ts) partition transform.
DAY_COLUMNS = {"transaction_day": "transaction_time"}

TRANSACTIONS_LAYOUT = ["transaction_day", "region_code"]
CUSTOMERS_LAYOUT = ["region_code"]
DIM_CUSTOMERS_LAYOUT = ["is_current", "region_code"]
MART_LAYOUT = ["sales_day"]
FACT_LAYOUT = ["transaction_day", "product_category"]

# Columns an upsert overwrites on a key match.  The columns left
# out (customer_id and event_date, or created_at) keep the stored value.
TRANSACTION_UPDATES = [
    "amount", "product_id", "product_category", "region_code",
    "transaction_time", "promotion_code", "device_type", "ingested_at",
]
CUSTOMER_UPDATES = [
    "first_name", "last_name", "email", "phone_number", "ssn", "ssn_hash",
    "country", "region_code", "ingested_at",
]
FACT_UPDATES = [
    "customer_key", "amount", "product_id", "product_category", "region_code",
    "transaction_time", "promotion_code", "ingested_at",
]
# A change in one of these opens a new dimension version.
TRACKED = ["email", "phone_number", "region_code"]
UNKNOWN_KEY = "UNKNOWN"

SNAPSHOT_MAX_AGE_MS = 604800000
