import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.functions.columns import location_parts, normalize_columns, normal_text, unquote
from tarnlake.plans.ingest import conform_customers, conform_transactions
from tarnlake.sources import files

HEADER = "transaction_id,customer_id,amount,product_id,product_category,region_code,transaction_time,event_date"


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def drifting(tmp_path):
    """Three header layouts: both optional columns; none; padded upper-case names and one optional."""
    root = tmp_path / "raw"
    write(root / "event_date=2026-05-18", "a.csv", HEADER + ",promotion_code,device_type",
          "T1,C1,10.5,P1,Books,US,2026-05-18T10:30:00Z,2026-05-18,SUMMER_10,iOS",
          "T2,C2,11,P1,Books,US,2026-05-18T10:30:00,2026-05-18,,Android")
    write(root / "event_date=2026-05-19", "b.csv", HEADER,
          'T3,C1,bad,P1,"Home, Garden",EU,not a time,2026-05-19')
    write(root / "event_date=2026-05-19", "c.csv",
          "device_type, Region_Code ,TRANSACTION_ID,amount,transaction_time",
          "Desktop,APAC,T4,7,2026-05-19T00:00:00")
    return str(root)


def test_columns_follow_their_header(spark, drifting):
    rows = {r.transaction_id: r for r in conform_transactions(files.read_transactions(spark, drifting)).collect()}
    assert set(rows) == {"T1", "T2", "T3", "T4"}
    assert (rows["T1"].promotion_code, rows["T1"].device_type) == ("SUMMER_10", "iOS")
    assert (rows["T2"].promotion_code, rows["T2"].device_type) == (None, "Android")
    assert rows["T3"].product_category == "Home, Garden"
    assert rows["T3"].amount is None and rows["T3"].transaction_time is None
    assert (rows["T4"].device_type, rows["T4"].region_code, rows["T4"].amount) == ("Desktop", "APAC", 7.0)
    assert rows["T4"].customer_id is None and rows["T4"].promotion_code is None
    assert str(rows["T1"].transaction_time) == "2026-05-18 10:30:00"


def test_headers_beyond_the_broadcast_limit_are_shuffled(spark, drifting, plan, shuffled_joins):
    out = files.read_transactions(spark, drifting)
    assert "BroadcastHashJoin" not in plan(out) and "SortMergeJoin" in plan(out)
    assert len(out.collect()) == 4


def test_one_header_needs_no_join(spark, tmp_path, plan):
    for i in range(3):
        write(tmp_path / "o", f"{i}.csv", "transaction_id,v", f"T{i},transaction_id", "transaction_id,v")
    out = files.read_csv_by_header(spark, str(tmp_path / "o"), "transaction_id", ["v", "w", "transaction_id"])
    assert "Join" not in plan(out)
    assert {tuple(r) for r in out.collect()} == {("transaction_id", None, f"T{i}") for i in range(3)}


def test_wide_files_are_read_whole(spark, tmp_path):
    names = [f"n{i}" for i in range(60)]
    write(tmp_path / "w", "a.csv", ",".join(["transaction_id", *names]), ",".join(["T1", *map(str, range(60))]))
    write(tmp_path / "w", "b.csv", "n59,transaction_id", "x,T2")
    out = files.read_csv_by_header(spark, str(tmp_path / "w"), "transaction_id", ["transaction_id", "n40", "n59"])
    assert {tuple(r) for r in out.collect()} == {("T1", "40", "59"), ("T2", None, "x")}


@pytest.mark.parametrize("header, said", [("txn_id,amount", "no column transaction_id"),
                                          ("transaction_id,a, A ", "a name twice"), ("T1,5", "no column")])
def test_unreadable_headers_are_errors_that_name_the_file(spark, tmp_path, header, said):
    write(tmp_path / "h", "good.csv", "transaction_id,a", "T1,1")
    write(tmp_path / "h", "odd.csv", header, "T2,2")
    with pytest.raises(PySparkException, match=f"{said}.*odd.csv"):
        files.read_csv_by_header(spark, str(tmp_path / "h"), "transaction_id", ["a"])


def test_lines_that_do_not_fit_are_rejected(spark, tmp_path):
    write(tmp_path / "r", "a.csv", "transaction_id,note,amount", "T1,ok,1", "T2,2", "T3,a,b,3", 'T4,"torn',
          'lines",4', 'T5,"a, ""b"", c",5', "", 'T6a,"a"",b",6', 'T6,"x\\",y",6', 'T7,5" pipe,7', "T8,,", 'T9,"a"b,1')
    write(tmp_path / "r", "b.csv", ",transaction_id", "0,T9", "1,2,3")
    parsed = files.split_csv_by_header(spark, str(tmp_path / "r"), "transaction_id", ["transaction_id", "amount"])
    notes = files.split_csv_by_header(spark, str(tmp_path / "r"), "transaction_id", ["note"]).rows
    assert {'a, "b", c', 'a",b', 'x",y', '5" pipe'} <= {r.note for r in notes.collect()}
    assert {tuple(r) for r in parsed.rows.collect()} == {
        ("T1", "1"), ("T5", "5"), ("T6", "6"), ("T6a", "6"), ("T7", "7"), ("T8", None), ("T9", None)}
    assert {(r.value, r.reason) for r in parsed.rejected.collect()} == {
        ("T2,2", "2 cells below a header of 3"), ("T3,a,b,3", "4 cells below a header of 3"),
        ('T4,"torn', "an open quote"), ('lines",4', "2 cells below a header of 3"),
        ('T9,"a"b,1', "text after a quote"), ("1,2,3", "3 cells below a header of 2")}
    with pytest.raises(ValueError, match="[ab].csv"):
        files.read_csv_by_header(spark, str(tmp_path / "r"), "transaction_id", ["amount"])


def test_split_files_keep_their_header(spark, tmp_path):
    write(tmp_path / "s", "a.csv", "v,transaction_id", *[f"x{i},T{i}" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2KB")
    try:
        out = files.read_csv_by_header(spark, str(tmp_path / "s"), "transaction_id", ["transaction_id", "v"])
        assert out.where("concat('x', substring(transaction_id, 2)) = v").count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_conformance_rows(spark):
    names = ["Transaction_ID", "Customer_ID", "Amount", "Product_ID", "Product_Category", "Region_Code",
             "Transaction_Time", "Event_Date"]
    raw = spark.createDataFrame([
        ("T-7", "K-3", "8.75", "P-1", "Lamps", "ME", "2025-02-03T04:05:06Z", "2025-02-03"),
        ("T-8", "K-4", "41.0", "P-2", "Ropes", "APAC", "2025-02-03T23:59:59Z", "2025-02-03")], names)
    out = conform_transactions(raw)
    assert out.schema.simpleString() == schemas.TRANSACTIONS.simpleString()
    first = out.orderBy("transaction_id").first()
    assert first.amount == 8.75 and str(first.transaction_time) == "2025-02-03 04:05:06"


def test_names(spark):
    assert normalize_columns(spark.createDataFrame([(1, 2)], [" A b", "C-D "])).columns == ["a b", "c-d"]
    assert normalize_columns(spark.createDataFrame([(1, 2)], [" A b", "C-D "]), snake=True).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["X ", "x_"]).toDF("X ", "x"))


def test_customers(spark, tmp_path):
    write(tmp_path / "c", "a.json",
          json.dumps({"customer_id": "C1", "ssn": "123-45-6789", "created_at": "2026-01-02T03:04:05"}),
          json.dumps({"customer_id": "C2", "ssn": None, "created_at": "bad", "extra": 1}))
    raw = files.read_customers(spark, str(tmp_path / "c"))
    out = {r.customer_id: r for r in conform_customers(raw).collect()}
    assert out["C1"].ssn_hash == "01a54629efb952287e554eb23ef69c52097a75aecc0e3a93ca0855ab6d7a31a0"
    assert out["C2"].ssn_hash is None and out["C2"].created_at is None
    blank = conform_customers(raw, salt="s", drop_raw=True).where("customer_id = 'C1'").first()
    assert blank.ssn is None and blank.ssn_hash not in (None, out["C1"].ssn_hash)


def test_text_helpers(spark):
    df = spark.createDataFrame([(" \t' \"x\"' ", "s3://b/p/q/t/", "  Select\n")], "a string, p string, q string")
    row = df.select(unquote(F.col("a")).alias("a"), location_parts(F.col("p")).alias("p"),
                    normal_text(F.col("q")).alias("q")).first()
    assert row.a == ' "x"' and row.q == "select"
    assert tuple(row.p) == ("b", "p/q/t/", "t")
    assert tuple(spark.sql("SELECT 's3://only' p").select(location_parts(F.col("p")).alias("p")).first().p) == (
        "only", "", "")


def test_inventory_opens_no_file(spark, drifting, plan):
    found = files.file_inventory(spark, drifting)
    assert found.columns == ["path", "length", "modificationTime"] and found.count() == 3
    assert "content" not in plan(found, "formatted").split("ReadSchema")[1]


def test_sample_lines(spark, tmp_path):
    write(tmp_path / "l", "a.csv", "h", *[str(i) for i in range(500)])
    write(tmp_path / "l", "b.csv", "h", "x" * 50, "y")
    out = files.sample_lines(spark, str(tmp_path / "l"))
    per_file = {r.file[-5:]: r.n for r in out.groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert per_file == {"a.csv": 100, "b.csv": 3}
    assert [r.value for r in out.where("file LIKE '%a.csv'").orderBy("line_number").limit(3).collect()] == [
        "h", "0", "1"]
    short = files.sample_lines(spark, str(tmp_path / "l"), max_bytes=20)
    assert short.where("file LIKE '%b.csv'").count() == 1


def test_audit_log(spark, tmp_path):
    write(tmp_path / "log", "a.json", json.dumps({
        "user_identity": {"arn": "u"}, "event_time": "2026-01-01T00:00:00", "event_name": "StartQueryExecution",
        "request_parameters": {"query": "select 1"}, "additional_event_data": '{"bytesScanned": "200000000000"}'}))
    from tarnlake.operators.audit import expensive_queries

    assert [tuple(r)[2:] for r in expensive_queries(files.read_audit_log(spark, str(tmp_path / "log"))).collect()] == [
        ("select 1", 200.0)]


def test_discover(spark, drifting, tmp_path):
    out = {r.column: (r.type, r.is_partition) for r in files.discover_schema(spark, drifting, "t").collect()}
    assert out["event_date"] == ("string", True)
    assert out["amount"] == ("string", False)          # one value is not a number
    assert out["device_type"] == ("string", False) and "region_code" in out
    spark.range(3).selectExpr("id", "id % 2 AS g").write.partitionBy("g").parquet(str(tmp_path / "p"))
    parquet = {r.column: (r.type, r.is_partition) for r in
               files.discover_schema(spark, str(tmp_path / "p"), "t", "parquet").collect()}
    assert parquet == {"id": ("bigint", False), "g": ("int", True)}
