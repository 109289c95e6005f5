import pytest

from pyspark.sql import functions as F

from tarnlake.operators.upsert import (
    DuplicateKeyError, dedupe_latest, duplicate_keys, not_in, require_unique, upsert,
)

TARGET = "id string, amount double, note string, region string"
COLS = ["id", "amount", "note", "region"]


def merge(target, source, **options):
    return upsert(target, source, ["id"], ["amount", "region"], COLS, **options)


def test_seed_and_batch(spark, rows):
    target = spark.createDataFrame([("TX_01", 50.0, "Books", "US")], TARGET)
    batch = spark.createDataFrame([("TX_01", 55.5, "Books", "US"), ("TX_02", 120.0, "Home", "EU")], TARGET)
    assert rows(merge(target, batch)) == [("TX_01", 55.5, "Books", "US"), ("TX_02", 120.0, "Home", "EU")]


def test_column_lists_decide(spark, rows):
    target = spark.createDataFrame([("a", 1.0, None, "US"), ("b", 2.0, "keep", "EU")], TARGET)
    batch = spark.createDataFrame([("a", None, "new", "APAC"), ("c", 3.0, "new", "ME")], TARGET)
    # note is not updated, not even where the stored value is NULL; an update may set NULL.
    assert rows(merge(target, batch)) == [
        ("a", None, None, "APAC"), ("b", 2.0, "keep", "EU"), ("c", 3.0, "new", "ME")]
    # A column left out of the insert list becomes NULL.
    out = upsert(target, batch, ["id"], ["amount"], ["id", "amount"])
    assert ("c", 3.0, None, None) in rows(out)


def test_null_keys_never_match(spark, rows):
    target = spark.createDataFrame([(None, 1.0, "t", "US"), ("a", 2.0, "t", "US")], TARGET)
    batch = spark.createDataFrame([(None, 9.0, "s", "EU"), (None, 8.0, "s", "EU")], TARGET)
    assert rows(merge(target, batch)) == sorted(
        [(None, 1.0, "t", "US"), ("a", 2.0, "t", "US"), (None, 9.0, "s", "EU"), (None, 8.0, "s", "EU")], key=str)


def test_duplicates(spark, rows):
    target = spark.createDataFrame([("a", 1.0, "t", "US")], TARGET)
    unmatched = spark.createDataFrame([("b", 2.0, "s", "EU"), ("b", 3.0, "s", "EU")], TARGET)
    matched = spark.createDataFrame([("a", 2.0, "s", "EU"), ("a", 3.0, "s", "EU")], TARGET)
    assert merge(target, unmatched).count() == 3
    with pytest.raises(DuplicateKeyError, match="matched by several"):
        merge(target, matched).collect()
    with pytest.raises(DuplicateKeyError) as error:
        merge(target, unmatched, on_duplicate="error")
    assert "'b'" not in str(error.value)
    assert rows(merge(target, matched, on_duplicate="latest", order_by=["amount"])) == [("a", 3.0, "t", "EU")]
    with pytest.raises(ValueError):
        merge(target, matched, on_duplicate="other")
    assert rows(duplicate_keys(unmatched, ["id"])) == [("b", 2)]
    assert rows(duplicate_keys(unmatched, ["id"], target)) == []
    assert rows(duplicate_keys(matched, ["id"], target)) == [("a", 2)]
    require_unique(target, ["id"])


def test_update_only_and_filter(spark, rows):
    target = spark.createDataFrame([("a", True, None), ("a", False, "x"), ("b", True, None)],
                                   "id string, open boolean, ended string")
    source = spark.createDataFrame([("a", False, "now"), ("z", False, "now")], target.schema)
    out = upsert(target, source, ["id"], ["open", "ended"], None, target_filter="open")
    assert rows(out) == sorted([("a", False, "now"), ("a", False, "x"), ("b", True, None)], key=str)
    # An ineligible row does not count as a match, so the source row is inserted.
    again = upsert(target, source, ["id"], ["ended"], ["id", "open", "ended"], target_filter=~F.col("open"))
    assert ("z", False, "now") in rows(again) and ("a", False, "now") in rows(again)


def test_idempotent_and_count(spark, rows):
    target = spark.range(100).select(
        F.concat(F.lit("k"), "id").alias("id"), F.col("id").cast("double").alias("amount"),
        F.lit("t").alias("note"), F.lit("US").alias("region"))
    source = spark.range(50, 150).select(
        F.concat(F.lit("k"), "id").alias("id"), (F.col("id") * 2.0).alias("amount"),
        F.lit("s").alias("note"), F.lit("EU").alias("region"))
    once = merge(target, source)
    assert once.count() == 150
    assert rows(once) == rows(merge(once, source))
    for small in (True, False):
        assert not_in(source, target, ["id"], small).count() == 50


def test_composite_keys_and_self_source(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "x int, y string, v int")
    out = upsert(target, target.where("y = 'b'").withColumn("v", F.lit(9)), ["x", "y"], ["v"], ["x", "y", "v"])
    assert rows(out) == [(1, "a", 1), (1, "b", 9)]


def test_dedupe_is_total_and_keeps_null_keys(spark, rows, plan):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "p"), (None, 1, "p"), ("b", None, "q")],
        "k string, t int, v string")
    out = dedupe_latest(df, ["k"], ["t"])
    assert rows(out) == sorted([("a", 2, "z"), ("b", None, "q"), (None, 1, "p"), (None, 1, "p")], key=str)
    # Rows are cut to one per key before the shuffle, whatever the size of a key.
    assert "WindowGroupLimit" in plan(out) and "Partial" in plan(out)


def test_hot_key_is_split(spark, plan, shuffled_joins):
    """A key with most rows of the target is split by AQE instead of filling one task."""
    target = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.rand(1).alias("amount"), F.sha2(F.col("id").cast("string"), 256).alias("note"),
        F.lit("US").alias("region"))
    source = spark.createDataFrame([("hot", 1.0, "s", "EU"), ("new", 2.0, "s", "EU")], TARGET)
    out = merge(target, source)
    assert len(out.collect()) == 60001
    assert "skew=true" in plan(out).split("== Initial Plan ==")[0]
    assert out.where("region = 'EU'").count() == 20001


def test_hot_source_key_needs_no_join(spark, rows, shuffled_joins):
    """Copies of a key that matches nothing are all inserted; others merge as usual."""
    target = spark.range(1000).select(
        F.col("id").cast("string").alias("id"), F.lit(1.0).alias("amount"), F.lit("t").alias("note"),
        F.lit("US").alias("region"))
    source = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "copies").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("id"),
        F.lit(2.0).alias("amount"), F.lit("s").alias("note"), F.lit("EU").alias("region"))
    out = merge(target, source)
    assert out.count() == 1000 + 300 + 300
    assert out.where("id = 'copies'").count() == 300 and out.where("id IS NULL").count() == 300
    assert out.where("note = 't' AND region = 'EU'").count() == 300


def test_small_source_does_not_shuffle_target(spark, plan, tmp_path):
    target = spark.range(1000).select(
        F.col("id").cast("string").alias("id"), F.lit(1.0).alias("amount"), F.lit("t").alias("note"),
        F.lit("US").alias("region"))
    target.write.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([("5", 2.0, "s", "EU")], TARGET)
    source.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    out = merge(stored, spark.read.parquet(str(tmp_path / "s")))
    text = plan(out)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert "ReadSchema: struct<id:string>" in plan(out, "formatted")
