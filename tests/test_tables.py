import json
import uuid

import pytest
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.operators.upsert import DuplicateKeyError
from tarnlake.plans.ingest import ingest_customers, ingest_transactions, merge_transactions
from tarnlake.plans.maintenance import maintain
from tarnlake.plans.star import publish_mart, run_all, update_dimension, update_fact
from tarnlake.sinks import compaction, exchange, tables, versions
from tarnlake.sinks.compaction import compact_table
from tarnlake.streaming.ingest import ingest_stream

RAW = "transaction_id string, amount string, region_code string, transaction_time string"


@pytest.fixture
def name(spark):
    return "t_" + uuid.uuid4().hex


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def stored(spark, name):
    return {r.transaction_id: r for r in tables.read_table(spark, name, schemas.TRANSACTIONS).collect()}


def folders(spark, name):
    return {r.partition for r in tables.table_files(spark, name).select("partition").distinct().collect()}


def test_rewrite_append_move_and_drop(spark, name):
    first = merge_transactions(spark, raw(
        spark, ("a", "1", "US", "2026-01-01T10:00:00"), ("b", "2", "US", "2026-01-02T10:00:00"),
        ("c", "3", None, "2026-01-02T10:00:00"), ("d", "4", "EU", "bad")), name)
    assert first == {"rewritten": 0, "dropped": 0}
    assert len(folders(spark, name)) == 4
    untouched = {r.path for r in tables.table_files(spark, name).where("partition LIKE '%01-01%'").collect()}
    # b moves to another region: its folder is emptied; c is updated in place; e is appended.
    second = merge_transactions(spark, raw(
        spark, ("b", "20", "EU", "2026-01-02T10:00:00"), ("c", "30", None, "2026-01-02T10:00:00"),
        ("e", "5", "US", "2026-01-01T11:00:00")), name)
    assert second == {"rewritten": 1, "dropped": 1}
    rows = stored(spark, name)
    assert {k: (r.amount, r.region_code) for k, r in rows.items()} == {
        "a": (1.0, "US"), "b": (20.0, "EU"), "c": (30.0, None), "d": (4.0, "EU"), "e": (5.0, "US")}
    assert rows["d"].transaction_time is None
    assert untouched <= {r.path for r in tables.table_files(spark, name).collect()}
    # The emptied folder holds no rows that a later append could bring back.
    merge_transactions(spark, raw(spark, ("f", "6", "US", "2026-01-02T10:00:00")), name)
    assert set(stored(spark, name)) == set("abcdef")


def test_rerun_empty_and_duplicates(spark, name):
    batch = raw(spark, ("a", "1", "US", "2026-01-01T10:00:00"), ("b", "2", "US", "2026-01-02T10:00:00"))
    merge_transactions(spark, batch, name, F.lit("2026-02-01").cast("timestamp"))
    before = stored(spark, name)
    merge_transactions(spark, batch, name, F.lit("2026-02-01").cast("timestamp"))
    assert stored(spark, name) == before
    assert merge_transactions(spark, batch.limit(0), name) == {"rewritten": 0, "dropped": 0}
    assert stored(spark, name) == before
    twice = raw(spark, ("a", "1", "US", "2026-01-01T10:00:00"), ("a", "9", "US", "2026-01-03T10:00:00"))
    with pytest.raises(DuplicateKeyError):
        merge_transactions(spark, twice, name)
    assert stored(spark, name) == before
    merge_transactions(spark, twice, name, on_duplicate="latest")
    assert stored(spark, name)["a"].amount == 9.0
    with pytest.raises(DuplicateKeyError):
        merge_transactions(spark, raw(spark, *[("z", "1", "US", None)] * 2), name, on_duplicate="error")


def test_unpartitioned_table(spark, name):
    tables.create_table(spark, name, schemas.CUSTOMERS, [])
    source = spark.createDataFrame([("c1", "x")], "customer_id string, email string")
    tables.upsert_table(spark, name, source, ["customer_id"], ["email"])
    tables.upsert_table(spark, name, source.withColumn("email", F.lit("y")), ["customer_id"], ["email"])
    assert [(r.customer_id, r.email, r.ssn) for r in spark.table(name).collect()] == [("c1", "y", None)]
    with pytest.raises(ValueError):
        tables.append_table(spark, name, source.withColumn("zzz", F.lit(1)))


def test_day_bounds_prune(spark, name, plan):
    merge_transactions(spark, raw(spark, *[
        (str(d), "1", "US", f"2026-01-{d:02d}T10:00:00") for d in range(1, 11)]), name)
    table = spark.table(name)
    out = tables.between_time(table, "2026-01-03 10:00:00", "2026-01-05 10:00:00")
    assert sorted(r.transaction_id for r in out.collect()) == ["3", "4"]
    assert "PartitionFilters: [isnotnull(transaction_day" in plan(out)


def test_compaction_keeps_rows(spark, name, rows):
    tables.create_table(spark, name, schemas.CUSTOMERS, ["region_code"])
    data = spark.range(200).select(
        F.col("id").cast("string").alias("customer_id"),
        F.when(F.col("id") < 150, "US").otherwise("EU").alias("region_code"))
    wide = data.select([
        (F.col(c) if c in data.columns else F.lit(None)).cast(spark.table(name).schema[c].dataType).alias(c)
        for c in spark.table(name).columns])
    for _ in range(2):
        wide.where("region_code = 'US'").repartition(3).write.insertInto(name)
    wide.where("region_code = 'EU'").coalesce(1).write.insertInto(name)
    before, kept = rows(spark.table(name)), {
        r.path for r in tables.table_files(spark, name).where("partition LIKE '%EU%'").collect()}
    plan = compact_table(spark, name)
    assert [(r.partition, r.files, r.target_files) for r in plan.collect()] == [("region_code=US/", 6, 1)]
    assert rows(spark.table(name)) == before
    after = tables.table_files(spark, name)
    assert after.where("partition LIKE '%US%'").count() == 1
    assert kept == {r.path for r in after.where("partition LIKE '%EU%'").collect()}
    assert compact_table(spark, name).isEmpty()


def test_maintain_goes_on_after_a_failure(spark, name, tmp_path):
    merge_transactions(spark, raw(spark, ("a", "1", "US", "2026-01-01T10:00:00")), name)
    root = str(tmp_path / "versions")
    for i in range(5):
        versions.write_version(spark.range(i), root, name, f"{i}")
    stray = tmp_path / "stray"
    stray.mkdir()
    (stray / "old.parquet").write_text("x")
    from datetime import datetime, timezone

    status = maintain(spark, f"missing_table, {name}", 7, {name: root}, {name: str(stray)},
                      now=datetime(2100, 1, 1, tzinfo=timezone.utc))
    assert [tuple(r)[:3] for r in status.collect()] == [
        ("missing_table", "compact", False), (name, "compact", True), (name, "expire", True), (name, "orphans", True)]
    assert [r.message for r in status.collect()][2:] == ["2 versions", "1 files"]


def test_orphans_in_the_table_folder(spark, name):
    from datetime import datetime, timezone

    merge_transactions(spark, raw(spark, ("a", "1", "a b+c", "2026-01-01T10:00:00")), name)
    root, late = tables.table_location(spark, name), F.lit("2100-01-01").cast("timestamp")
    assert tables.table_orphans(spark, name, late).count() == 0
    spark.range(1).coalesce(1).write.parquet(f"{root}/leftover")
    spark.catalog.refreshTable(name)
    found = [r.path for r in tables.table_orphans(spark, name, late).where("path LIKE '%.parquet'").collect()]
    assert len(found) == 1 and "/leftover/" in found[0]
    status = maintain(spark, name, now=datetime(2100, 1, 1, tzinfo=timezone.utc)).collect()
    assert [(r.step, r.ok) for r in status] == [("compact", True), ("orphans", True)]


def test_failed_write_keeps_an_unpartitioned_table(spark, name, rows):
    schema = spark.range(1).selectExpr("CAST(id AS STRING) AS k", "id AS v").schema
    tables.create_table(spark, name, schema, [])

    def batch(*pairs):
        return spark.createDataFrame(list(pairs), schema)
    for pairs in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]):
        tables.upsert_table(spark, name, batch(*pairs), ["k"], ["v"])
    assert rows(spark.table(name)) == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(Exception, match="broken"):
        tables._swap(spark, spark.table(name).withColumn("v", F.raise_error(F.lit("broken")).cast("long")), name)
    assert rows(spark.table(name)) == [("a", 1), ("b", 3), ("c", 4)]


def test_versions(spark, tmp_path):
    root = str(tmp_path / "v")
    versions.write_version(spark.range(1), root, "m", "1")
    versions.write_version(spark.range(2), root, "m", "2")
    assert versions.read_latest(spark, root).count() == 2
    assert versions.list_versions(spark, root).count() == 2
    with pytest.raises(Exception, match="already exists"):
        versions.write_version(spark.range(2), root, "m", "2")
    versions.export_csv(spark.range(2), str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).columns == ["id"]


HEADER = "transaction_id,customer_id,amount,product_id,product_category,region_code,transaction_time,event_date"


def drop_file(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def customer(i, **changes):
    return json.dumps({
        "customer_id": f"C{i}", "first_name": "F", "last_name": "L", "email": f"{i}@x.org", "phone_number": "p",
        "ssn": "123-45-6789", "country": "US", "region_code": "US", "created_at": "2026-01-01T00:00:00", **changes})


def test_all_zones(spark, tmp_path):
    for db in ("conformed_db", "consumption_db"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    txns, people = tmp_path / "txns", tmp_path / "people"
    drop_file(txns / "event_date=2026-05-18", "a.csv", HEADER,
              "T1,C1,10,P,Books,US,2026-05-18T10:00:00,2026-05-18", "T2,C9,20,P,Books,EU,2026-05-18T11:00:00,2026-05-18")
    drop_file(people, "a.json", customer(1), customer(2))
    run_all(spark, str(txns), str(people), "2026-06-01 00:00:00")
    fact = {r.transaction_id: r for r in spark.table("consumption_db.fact_transactions").collect()}
    dim = {r.customer_id: r for r in spark.table("consumption_db.dim_customers").collect()}
    assert set(dim) == {"C1", "C2"} and all(len(r.ssn_hash) == 64 for r in dim.values())
    assert fact["T1"].customer_key == dim["C1"].customer_key and fact["T2"].customer_key == "UNKNOWN"

    # C1 moves region (its old partition is emptied of it), C9 appears; T1 is corrected.
    drop_file(people, "a.json", customer(1, region_code="EU"), customer(2, last_name="Other"), customer(9))
    drop_file(txns / "event_date=2026-05-18", "a.csv", HEADER,
              "T1,C1,11,P,Books,US,2026-05-18T10:00:00,2026-05-18", "T2,C9,20,P,Books,EU,2026-05-18T11:00:00,2026-05-18")
    spark.catalog.clearCache()
    run_all(spark, str(txns), str(people), "2026-06-02 00:00:00")
    versions_of = spark.table("consumption_db.dim_customers")
    assert versions_of.count() == 4 and versions_of.where("is_current").count() == 3
    c1 = {r.is_current: r for r in versions_of.where("customer_id = 'C1'").collect()}
    assert c1[False].end_date == c1[True].start_date and c1[False].customer_key == dim["C1"].customer_key
    fact = {r.transaction_id: r for r in spark.table("consumption_db.fact_transactions").collect()}
    assert fact["T1"].amount == 11.0 and fact["T1"].customer_key == c1[True].customer_key
    assert fact["T2"].customer_key not in ("UNKNOWN", None) and len(fact) == 2
    # Nothing changed: the dimension step leaves the table alone.
    assert update_dimension(spark) is False
    path = publish_mart(spark, str(tmp_path / "mart"), "1")
    assert spark.read.parquet(path).agg(F.sum("revenue")).first()[0] == 31.0
    assert ingest_customers(spark, str(people))["dropped"] == 0
    assert ingest_transactions(spark, str(txns))["rewritten"] == 2
    assert update_fact(spark)["rewritten"] == 1
    # Nothing was ingested or re-keyed since then, so no partition is touched.
    later = F.lit("2100-01-01").cast("timestamp")
    assert update_fact(spark, changed_since=later) == {"rewritten": 0, "dropped": 0}
    again = F.lit("2026-06-02").cast("timestamp")
    assert update_fact(spark, changed_since=again)["rewritten"] == 1


def test_scd2_repeat_after_a_crash(spark, name, monkeypatch):
    """A run that stops after closing old versions can be repeated."""
    tables.create_table(spark, name, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    base = spark.createDataFrame([("c1", "a", "p", "US"), ("c2", "b", "p", "US")],
                                 "customer_id string, email string, phone_number string, region_code string")
    fresh = base.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "first_name", "last_name", "ssn", "ssn_hash", "country")])
    tables.scd2_table(spark, name, fresh, batch_ts=F.lit("2026-01-01").cast("timestamp"))
    changed = fresh.withColumn("email", F.when(F.col("customer_id") == "c1", "new").otherwise(F.col("email")))
    step = F.lit("2026-01-02").cast("timestamp")

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_replace", crash)
        with pytest.raises(RuntimeError):
            tables.scd2_table(spark, name, changed, batch_ts=step)
    assert tables.scd2_table(spark, name, changed, batch_ts=step) is True
    out = spark.table(name)
    assert out.count() == 3 and out.where("is_current").count() == 2
    assert out.where("customer_id = 'c1' AND NOT is_current").count() == 1


def test_default_batch_time_closes_and_opens_alike(spark, name):
    tables.create_table(spark, name, schemas.DIM_CUSTOMERS, schemas.DIM_CUSTOMERS_LAYOUT)
    fresh = spark.createDataFrame([("c1", "a", "p", "US")],
                                  "customer_id string, email string, phone_number string, region_code string")
    tables.scd2_table(spark, name, fresh)
    tables.scd2_table(spark, name, fresh.withColumn("email", F.lit("b")))
    rows = {r.is_current: r for r in spark.table(name).collect()}
    assert rows[False].end_date == rows[True].start_date == rows[True].ingested_at
    assert rows[False].start_date < rows[False].end_date


def test_stream_reads_each_file_once(spark, name, tmp_path):
    raw_dir, check = tmp_path / "raw", str(tmp_path / "check")
    drop_file(raw_dir, "a.csv", HEADER, "T1,C1,10,P,Books,US,2026-05-18T10:00:00,2026-05-18",
              "T1,C1,12,P,Books,US,2026-05-18T11:00:00,2026-05-18")
    ingest_stream(spark, str(raw_dir), name, check).awaitTermination()
    assert stored(spark, name)["T1"].amount == 12.0
    drop_file(raw_dir, "b.csv", "device_type,transaction_id,amount", "iOS,T2,5")
    merge_transactions(spark, raw(spark, ("T1", "99", "US", "2026-05-18T11:00:00")), name)
    ingest_stream(spark, str(raw_dir), name, check).awaitTermination()
    rows = stored(spark, name)
    assert rows["T1"].amount == 99.0  # the first file was not read again
    assert (rows["T2"].device_type, rows["T2"].amount, rows["T2"].region_code) == ("iOS", 5.0, None)
    assert set(rows) == {"T1", "T2"}


@pytest.mark.parametrize("step", range(4))
def test_interrupted_upsert_is_finished_by_the_next_write(spark, name, monkeypatch, step):
    """Lost before any write, after the overwrite, after the drop, and after the append."""
    merge_transactions(spark, raw(
        spark, ("a", "1", "US", "2026-01-01T10:00:00"), ("b", "2", "US", "2026-01-02T10:00:00"),
        ("c", "3", "EU", "2026-01-03T10:00:00")), name)
    # b moves to the partition of c, d is new in a partition of its own.
    batch = raw(spark, ("b", "20", "EU", "2026-01-03T11:00:00"), ("d", "4", "US", "2026-01-04T10:00:00"))
    calls, insert, drop = [], tables._insert, tables._drop_partitions

    def lose(work, place):
        def run(*args, **options):
            if step in place[:1]:
                raise RuntimeError("lost")
            work(*args, **options)
            if step in place[1:]:
                raise RuntimeError("lost")
        return run

    def inserting(*args, **options):
        calls.append(1)
        return lose(insert, [0, 1] if len(calls) == 1 else [9, 3])(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_insert", inserting)
        patch.setattr(tables, "_drop_partitions", lose(drop, [9, 2]))
        with pytest.raises(RuntimeError):
            merge_transactions(spark, batch, name)
    # c, which was not in the batch, is never out of sight.
    assert stored(spark, name)["c"].amount == 3.0
    assert tables.finish_pending(spark, name) is True
    assert tables.finish_pending(spark, name) is False
    for _ in range(2):
        out = tables.read_table(spark, name, schemas.TRANSACTIONS).collect()
        assert sorted((r.transaction_id, r.amount, r.region_code) for r in out) == [
            ("a", 1.0, "US"), ("b", 20.0, "EU"), ("c", 3.0, "EU"), ("d", 4.0, "US")]
        merge_transactions(spark, batch, name)
