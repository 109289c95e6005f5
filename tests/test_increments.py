"""What is kept up to date by what changed: dimension, fact, mart."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.operators.star import mart_sales
from tarnlake.plans import star
from tarnlake.sinks import derived, tables


@pytest.fixture
def name():
    return "t_" + uuid.uuid4().hex


def people(spark, *rows):
    df = spark.createDataFrame(list(rows), "customer_id string, email string, phone_number string, region_code string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "ssn", "ssn_hash", "country")])


def at(text):
    return F.lit(text).cast("timestamp")


def local(path):
    return Path(path.removeprefix("file:"))


def test_closed_versions_are_not_read(spark, name):
    tables.create_table(spark, name, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    for day, mail in ((1, "a"), (2, "b"), (3, "c")):
        tables.scd2_table(spark, name, people(spark, ("c1", mail, "p", "US"), ("c2", "x", "p", "EU")), batch_ts=at(f"2026-01-0{day}"))
    closed = [r.path for r in tables.table_files(spark, name).where("partition LIKE 'is_current=false%'").collect()]
    assert len(closed) == 2
    kept = {path: local(path).read_bytes() for path in closed}
    for path in closed:  # whoever opens one fails
        local(path).write_bytes(b"no Parquet")
        (local(path).parent / f".{local(path).name}.crc").unlink(missing_ok=True)
    assert tables.scd2_table(spark, name, people(spark, ("c1", "d", "p", "US")), batch_ts=at("2026-01-04")) is True
    assert tables.scd2_table(spark, name, people(spark, ("c1", "d", "p", "US")), batch_ts=at("2026-01-05")) is False
    for path, data in kept.items():
        local(path).write_bytes(data)
    spark.catalog.refreshTable(name)
    out = {(r.customer_id, r.email): (str(r.start_date)[:10], r.end_date and str(r.end_date)[:10], r.is_current) for r in spark.table(name).collect()}
    assert out == {
        ("c1", "a"): ("2026-01-01", "2026-01-02", False), ("c1", "b"): ("2026-01-02", "2026-01-03", False),
        ("c1", "c"): ("2026-01-03", "2026-01-04", False), ("c1", "d"): ("2026-01-04", None, True), ("c2", "x"): ("2026-01-01", None, True)}


@pytest.mark.parametrize("step", range(4))
def test_a_lost_type_2_step_is_completed(spark, name, monkeypatch, step):
    """Lost before and after the closed versions, and before and after the open ones are in place."""
    tables.create_table(spark, name, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    tables.scd2_table(spark, name, people(spark, ("c1", "a", "p", "US"), ("c2", "b", "p", "US")), batch_ts=at("2026-01-01"))
    changed = people(spark, ("c1", "new", "p", "EU"), ("c3", "c", "p", "US"))
    real = {"_insert": tables._insert, "_replace": tables._replace}

    def lose(kind, before):
        def run(*args, **options):
            if before:
                raise RuntimeError("lost")
            monkeypatch.setattr(tables, kind, real[kind])
            real[kind](*args, **options)
            raise RuntimeError("lost")
        return run

    kind = ("_insert", "_insert", "_replace", "_replace")[step]
    monkeypatch.setattr(tables, kind, lose(kind, step % 2 == 0))
    with pytest.raises(RuntimeError):
        tables.scd2_table(spark, name, changed, batch_ts=at("2026-01-02"))
    for k, work in real.items():
        monkeypatch.setattr(tables, k, work)
    # Another batch comes first: the lost one is completed with its own time.
    assert tables.scd2_table(spark, name, people(spark, ("c2", "b2", "p", "US")), batch_ts=at("2026-01-03")) is True
    out = sorted((r.customer_id, r.email, str(r.start_date)[:10], str(r.end_date)[:10]) for r in spark.table(name).collect())
    assert out == [("c1", "a", "2026-01-01", "2026-01-02"), ("c1", "new", "2026-01-02", "None"), ("c2", "b", "2026-01-01", "2026-01-03"),
                   ("c2", "b2", "2026-01-03", "None"), ("c3", "c", "2026-01-02", "None")]
    assert derived.properties(spark, name).get(tables.PENDING) is None


FACT = "transaction_id string, customer_id string, amount double, region_code string, product_category string, t string"


def facts(spark, *rows):
    df = spark.createDataFrame(list(rows), FACT)
    return df.withColumn("transaction_time", F.col("t").cast("timestamp")).drop("t")


def merge(spark, name, *rows):
    return tables.upsert_table(spark, name, facts(spark, *rows), ["transaction_id"], [
        "amount", "region_code", "product_category", "transaction_time"], track=True)


def same(spark, fact, mart, rows):
    columns = sorted(spark.table(mart).columns)
    return rows(spark.table(mart).select(columns)) == rows(mart_sales(spark.table(fact)).select(columns))


def test_the_mart_follows_the_fact_by_changed_days(spark, name, rows):
    fact, mart = name, name + "_mart"
    tables.create_table(spark, fact, schemas.FACT_TRANSACTIONS, schemas.FACT_LAYOUT)
    days = [(f"t{d}", f"c{d % 3}", float(d), "US", "maps", f"2026-01-{d:02d} 10:00:00") for d in range(1, 11)]
    merge(spark, fact, *days, ("n", "c1", 7.0, None, None, None))
    assert star.update_mart(spark, fact, mart)["rewritten"] == 11 and same(spark, fact, mart, rows)
    assert star.update_mart(spark, fact, mart) == {"rewritten": 0, "dropped": 0}
    kept = {r.path for r in tables.table_files(spark, mart).collect() if not any(d in r.partition for d in ("01-02", "01-03", "01-09"))}
    # t2 moves to the 3rd and leaves its day empty, t9 is corrected, u is new on the 20th.
    merge(spark, fact, ("t2", "c9", 2.5, "EU", "maps", "2026-01-03 09:00:00"), ("t9", "c0", 90.0, "US", "ropes", "2026-01-09 10:00:00"))
    merge(spark, fact, ("u", "c1", 1.0, "US", "maps", "2026-01-20 10:00:00"))
    assert star.update_mart(spark, fact, mart) == {"rewritten": 3, "dropped": 1}
    assert same(spark, fact, mart, rows)
    assert kept and kept < {r.path for r in tables.table_files(spark, mart).collect()}
    assert tables.changed_partitions(spark, fact) == (None, [])


def test_a_lost_mart_update_is_repeated(spark, name, rows, monkeypatch):
    fact, mart = name, name + "_mart"
    tables.create_table(spark, fact, schemas.FACT_TRANSACTIONS, schemas.FACT_LAYOUT)
    merge(spark, fact, ("a", "c1", 1.0, "US", "maps", "2026-01-01 10:00:00"), ("b", "c1", 1.0, "US", "maps", "2026-01-02 10:00:00"))
    star.update_mart(spark, fact, mart)
    merge(spark, fact, ("a", "c1", 5.0, "US", "maps", "2026-01-03 10:00:00"))

    def lost(*_, **__):
        raise RuntimeError("lost")
    for where in ("replace_partitions", "remove"):
        with monkeypatch.context() as patch:
            patch.setattr(star, where, lost)
            with pytest.raises(RuntimeError):
                star.update_mart(spark, fact, mart)
    assert star.update_mart(spark, fact, mart)["dropped"] in (0, 1) and same(spark, fact, mart, rows)


def test_only_changed_transactions_are_keyed_again(spark, name):
    txns, dim, fact = name + "_t", name + "_d", name + "_f"
    tables.create_table(spark, txns, schemas.TRANSACTIONS, schemas.TRANSACTIONS_LAYOUT)

    def ingest(when, *rows):
        tables.upsert_table(spark, txns, facts(spark, *rows).withColumn("ingested_at", at(when)), ["transaction_id"], ["amount", "ingested_at"])

    ingest("2026-02-01", ("a", "c1", 1.0, "US", "maps", "2026-01-01 10:00:00"), ("b", "c2", 2.0, "US", "maps", "2026-01-02 10:00:00"),
           ("c", "c3", 3.0, "US", "maps", "2026-01-03 10:00:00"))
    tables.create_table(spark, dim, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    tables.scd2_table(spark, dim, people(spark, ("c1", "a", "p", "US"), ("c2", "b", "p", "US")), batch_ts=at("2026-02-01"))
    first = star.update_fact(spark, txns, dim, fact, batch_ts=at("2026-02-01"), incremental=True)
    assert first == {"rewritten": 0, "dropped": 0} and spark.table(fact).count() == 3
    # b is corrected, c3 appears; a is left alone.
    ingest("2026-02-02", ("b", "c2", 20.0, "US", "maps", "2026-01-02 10:00:00"))
    tables.scd2_table(spark, dim, people(spark, ("c3", "c", "p", "US")), batch_ts=at("2026-02-02"))
    spark.sql(f"ALTER TABLE {fact} SET TBLPROPERTIES ('{star.KEYED_UNTIL}'='2026-02-01 12:00:00')")
    assert star.update_fact(spark, txns, dim, fact, batch_ts=at("2026-02-02"), incremental=True)["rewritten"] == 2
    out = {r.transaction_id: (r.amount, r.customer_key != "UNKNOWN", str(r.ingested_at)[:10]) for r in spark.table(fact).collect()}
    assert out == {"a": (1.0, True, "2026-02-01"), "b": (20.0, True, "2026-02-02"), "c": (3.0, True, "2026-02-02")}
