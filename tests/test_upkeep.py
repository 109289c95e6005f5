from datetime import datetime, timezone

from pyspark.sql import functions as F

from tarnlake.operators import upkeep
from tarnlake.plans.maintenance import retention_cutoff, table_names


def cutoff(text):
    return F.lit(text).cast("timestamp")


def test_expire_needs_age_and_rank(spark):
    versions = spark.sql("""SELECT * FROM VALUES
        ('a', 'v1', TIMESTAMP '2026-01-01'), ('a', 'v2', TIMESTAMP '2026-01-02'), ('a', 'v3', TIMESTAMP '2026-01-03'),
        ('a', 'v4', TIMESTAMP '2026-01-04'), ('a', 'v5', TIMESTAMP '2026-03-01'), ('b', 'v1', TIMESTAMP '2025-01-01')
        AS t(`table`, version, committed_at)""")
    out = upkeep.expired_versions(versions, cutoff("2026-02-01"))
    # v3 and v4 are old but among the last three; b's only version is kept.
    assert sorted(r.version for r in out.collect()) == ["v1", "v2"]
    assert upkeep.expired_versions(versions, cutoff("2026-01-02"), 1).count() == 1


def test_retention_ranks_before_the_shuffle(spark, plan):
    versions = spark.range(100).selectExpr("id % 3 AS `table`", "id AS version", "timestamp_seconds(id) AS committed_at")
    text = plan(upkeep.expired_versions(versions, cutoff("2026-01-01")))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_orphans(spark):
    listed = spark.sql("""SELECT * FROM VALUES ('x', TIMESTAMP '2026-01-01'), ('y', TIMESTAMP '2026-01-01'),
        ('z', TIMESTAMP '2026-05-01') AS t(path, modificationTime)""")
    used = listed.where("path = 'x'").select("path")
    assert [r.path for r in upkeep.orphan_files(listed, used, cutoff("2026-02-01")).collect()] == ["y"]


def test_lifecycle_boundaries(spark):
    files = spark.sql("""SELECT * FROM VALUES ('new', TIMESTAMP '2026-01-02'), ('month', TIMESTAMP '2026-01-01'),
        ('year', TIMESTAMP '2025-01-31') AS t(path, modificationTime)""")
    plan = {r.path: r.action for r in upkeep.lifecycle_plan(files, F.lit("2026-01-31").cast("date")).collect()}
    assert plan == {"month": "archive", "year": "expire"}
    tier = upkeep.lifecycle_plan(files, F.lit("2026-01-31").cast("date"), upkeep.CONFORMED_LIFECYCLE)
    assert {r.action for r in tier.collect()} == {"tier"} and tier.count() == 3


def test_storage_metrics_depth(spark):
    files = spark.createDataFrame(
        [("s3://b/1/2/3/4/5/6/f", 10), ("s3://b/1/g", 5), ("s3://top", 1)], "path string, length long")
    out = {r.prefix: (r.depth, r.bytes, r.files) for r in upkeep.storage_metrics(files, modified=None).collect()}
    assert out["b"] == (1, 15, 2) and out["b/1"] == (2, 15, 2) and out["b/1/2/3/4"] == (5, 10, 1)
    assert max(depth for depth, _, _ in out.values()) == 5 and "top" not in out


def test_compaction_plan_counts_small_files_only(spark):
    big = upkeep.COMPACT_MAX_BYTES
    files = spark.createDataFrame(
        [("p", big - 1)] * 4 + [("p", big)] + [("q", 100)] * 5 + [("r", big // 2)] * 6, "part string, length long")
    out = {r.part: (r.files, r.target_files) for r in upkeep.compaction_plan(files, ["part"]).collect()}
    assert out == {"q": (5, 1), "r": (6, 3)}


def test_samples(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("a", 3), ("b", 1)], "g string, n int")
    assert sorted(tuple(r) for r in upkeep.head_sample(rows, 2, ["g"], ["n"]).collect()) == [
        ("a", 1), ("a", 2), ("b", 1)]
    files = spark.createDataFrame([("p", "p/a.txt"), ("p", "p/c.json"), ("p", "p/b.csv"), ("q", "q/x")],
                                  "prefix string, path string")
    assert [tuple(r) for r in upkeep.first_sample_file(files, ["prefix"]).collect()] == [("p", "p/b.csv")]


def test_cutoff_is_utc_and_names_are_trimmed():
    assert retention_cutoff(7, datetime(2026, 1, 8, 1, tzinfo=timezone.utc)) == "2026-01-01 01:00:00"
    assert table_names(" a.b , c.d,") == ["a.b", "c.d"]
