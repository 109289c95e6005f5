import pytest

from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.operators import star
from tarnlake.operators.upsert import DuplicateKeyError

DIM = ("customer_key string, customer_id string, last_name string, email string, phone_number string, "
       "region_code string, start_date timestamp, end_date timestamp, is_current boolean")
FRESH = "customer_id string, last_name string, email string, phone_number string, region_code string"


@pytest.fixture
def ts():
    return lambda text: F.lit(text).cast("timestamp")


@pytest.fixture
def dim(spark):
    return spark.sql(f"""SELECT * FROM VALUES
        ('k1', 'c1', 'L', 'e1', 'p1', 'US', TIMESTAMP '2025-01-01', CAST(NULL AS TIMESTAMP), true),
        ('k2', 'c2', 'L', 'e2', 'p2', 'US', TIMESTAMP '2025-01-01', NULL, true),
        ('k3', 'c3', 'L', 'e3', 'p3', 'EU', TIMESTAMP '2025-01-01', NULL, true),
        ('k4', 'c4', 'L', 'e4', 'p4', 'EU', TIMESTAMP '2025-01-01', NULL, true),
        ('k0', 'c1', 'L', 'e0', 'p0', 'US', TIMESTAMP '2024-01-01', TIMESTAMP '2025-01-01', false)
        AS t({', '.join(f.split()[0] for f in DIM.split(', '))})""")


@pytest.fixture
def fresh(spark):
    return spark.createDataFrame([
        ("c1", "L", "new", "p1", "US"),      # email changed
        ("c2", "Other", "e2", "p2", "US"),   # untracked change only
        ("c3", "L", "e3", None, "EU"),       # NULL is not a change
        ("c9", "L", "e9", "p9", "ME"),       # new customer
    ], FRESH)                                # c4 absent: stays open


def test_scd2_contract(spark, dim, fresh, ts, rows):
    out = star.scd2_apply(dim, fresh, batch_ts=ts("2026-01-01 00:00:00"), surrogate=star.replayable_key)
    assert out.columns == dim.columns
    current = out.where("is_current")
    assert sorted(r.customer_id for r in current.collect()) == ["c1", "c2", "c3", "c4", "c9"]
    old = out.where("customer_key = 'k1'").first()
    new = current.where("customer_id = 'c1'").first()
    assert not old.is_current and old.end_date == new.start_date and new.end_date is None
    assert rows(out.where("customer_key IN ('k0', 'k2', 'k3', 'k4')")) == rows(
        dim.where("customer_key IN ('k0', 'k2', 'k3', 'k4')"))
    again = star.scd2_apply(out, fresh, batch_ts=ts("2026-02-01 00:00:00"))
    assert rows(again) == rows(out)


def test_null_safe_opens_a_version(dim, fresh, ts):
    out = star.scd2_apply(dim, fresh, batch_ts=ts("2026-01-01"), null_safe=True)
    assert out.where("customer_id = 'c3'").count() == 2


def test_random_keys_are_unique(dim, fresh, ts):
    out = star.scd2_apply(dim, fresh, batch_ts=ts("2026-01-01"))
    keys = [r.customer_key for r in out.collect()]
    assert len(keys) == len(set(keys))


def test_duplicates_in_fresh(spark, dim, ts):
    twice = spark.createDataFrame([("c1", "L", "x", "p1", "US"), ("c1", "L", "y", "p1", "US")], FRESH)
    with pytest.raises(DuplicateKeyError, match="matched by several"):
        star.scd2_apply(dim, twice, batch_ts=ts("2026-01-01")).collect()
    new = spark.createDataFrame([("n", "L", "x", "p1", "US"), ("n", "L", "y", "p1", "US")], FRESH)
    assert star.scd2_apply(dim, new, batch_ts=ts("2026-01-01")).where("customer_id = 'n'").count() == 2
    with pytest.raises(ValueError):
        star.scd2_apply(dim, new, batch_ts=ts("2026-01-01"), on_duplicate="error")
    with pytest.raises(ValueError):
        star.scd2_apply(dim, new, on_duplicate="latest")


def test_null_customer_is_always_new(spark, dim, ts):
    nobody = spark.createDataFrame([(None, "L", "x", "p1", "US")], FRESH)
    once = star.scd2_apply(dim, nobody, batch_ts=ts("2026-01-01"))
    assert star.scd2_apply(once, nobody, batch_ts=ts("2026-01-02")).where("customer_id IS NULL").count() == 2


def test_expire_only(spark, dim, ts, rows):
    gone = spark.createDataFrame([("c1",), ("zz",)], "customer_id string")
    out = star.expire_current(dim, gone, "customer_id", ts("2026-01-01"))
    assert out.count() == dim.count()
    assert out.where("is_current").count() == 3
    assert rows(out.where("customer_key = 'k0'")) == rows(dim.where("customer_key = 'k0'"))


@pytest.fixture
def txns(spark):
    return spark.createDataFrame([
        ("t1", "c1", 10.0, "p", "Books", "US", "2024-05-01 10:00:00", "2024-05-01", None, "iOS", None),
        ("t2", "zz", 20.0, "p", "Books", "US", "2024-05-01 11:00:00", "2024-05-01", "S", None, None),
        ("t3", None, 30.0, "p", "Home", "EU", "2024-05-02 11:00:00", "2024-05-02", "S", None, None),
    ], ", ".join(f"{f.name} {'string' if f.dataType.simpleString() == 'timestamp' else f.dataType.simpleString()}"
                 for f in schemas.TRANSACTIONS.fields)).withColumns({
        c: F.col(c).cast("timestamp") for c in ("transaction_time", "ingested_at")})


def test_fact_uses_current_row_not_as_of(spark, txns, dim, ts):
    fact = star.fact_rows(txns, dim, ts("2026-01-01"))
    assert fact.columns == schemas.FACT_TRANSACTIONS.names
    keys = {r.transaction_id: r.customer_key for r in fact.collect()}
    assert keys == {"t1": "k1", "t2": "UNKNOWN", "t3": "UNKNOWN"}


def test_fact_is_repointed_and_keeps_fixed_columns(spark, txns, dim, fresh, ts):
    empty = spark.createDataFrame([], schemas.FACT_TRANSACTIONS)
    first = star.build_fact(txns, dim, empty, ts("2026-01-01"))
    later_dim = star.scd2_apply(dim, fresh, batch_ts=ts("2026-02-01"), surrogate=star.replayable_key)
    moved = txns.withColumn("event_date", F.lit("1999-01-01"))
    second = star.build_fact(moved, later_dim, first, ts("2026-02-01"))
    assert second.count() == 3
    row = second.where("transaction_id = 't1'").first()
    assert row.customer_key not in ("k1", "UNKNOWN") and row.event_date == "2024-05-01"


def test_two_current_rows_fan_out_then_fail(spark, txns, dim, ts):
    doubled = dim.unionByName(dim.where("customer_key = 'k1'").withColumn("customer_key", F.lit("k1b")))
    empty = spark.createDataFrame([], schemas.FACT_TRANSACTIONS)
    first = star.build_fact(txns, doubled, empty, ts("2026-01-01"))
    assert first.where("transaction_id = 't1'").count() == 2
    with pytest.raises(DuplicateKeyError, match="matched by several"):
        star.build_fact(txns, doubled, first, ts("2026-01-02")).collect()


def test_mart(txns):
    out = {(str(r.sales_day), r.region_code, r.product_category): r for r in star.mart_sales(txns).collect()}
    books = out[("2024-05-01", "US", "Books")]
    assert (books.transactions, books.revenue, books.avg_amount, books.customers) == (2, 30.0, 15.0, 2)
    assert out[("2024-05-02", "EU", "Home")].customers == 0


def test_hot_customer_is_split(spark, plan, ts, shuffled_joins):
    txns = spark.range(0, 60000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_id"))
    dim = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("k").alias("customer_key"),
        F.lit(True).alias("is_current"))
    out = star.fact_rows(txns, dim, ts("2026-01-01"))
    assert len(out.collect()) == 60000
    assert "skew=true" in plan(out).split("== Initial Plan ==")[0]
