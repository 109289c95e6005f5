"""Tags along column lineage, and actionable maintenance."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tarnlake.operators import lineage, upkeep
from tarnlake.plans.maintenance import maintain_all
from tarnlake.sinks import tables, versions
from tarnlake.sources import policy

TAG = ["database", "table", "column", "tag", "value"]
EDGE = "from_database string, from_table string, from_column string, database string, `table` string, `column` string"


def edges(spark, *pairs):
    return spark.createDataFrame([("d", a[0], a[1:], "d", b[0], b[1:]) for a, b in pairs], EDGE)


def tags(spark, **values):
    return policy.local_rows(spark, [("d", name[0], name[1:], "PII", v) for name, v in values.items()] + [("d", "t", "", "BU", "x")], TAG)


def test_strictness_follows_lineage_through_branches_and_cycles(spark, rows):
    # a1 -> b1 -> c1 -> b1 is a cycle; c1 also feeds e1; z1 has no tag, y1 an unknown value; u1 is fed by nobody.
    flows = edges(spark, ("a1", "b1"), ("b1", "c1"), ("c1", "b1"), ("c1", "e1"), ("q1", "e1"), ("e1", "z1"), ("z1", "y1"), ("n1", "m1"))
    now = tags(spark, a1="direct", b1="none", c1="direct", q1="quasi", e1="quasi", y1="unsure", n1="none", u1="quasi")
    weak = lineage.weaker_than_source(now, flows)
    want = [("b1", "none", "direct"), ("e1", "quasi", "direct"), ("y1", "unsure", "direct"), ("z1", None, "direct")]
    assert sorted((r.table + r.column, r.value, r.inherited) for r in weak.collect()) == want
    assert {(r.table + r.column, r.tag, r.value) for r in lineage.strengthened(now, flows).collect()} == {(n, "PII", "direct") for n, _, _ in want}
    assert lineage.weaker_than_source(now, edges(spark)).isEmpty()
    assert lineage.weaker_than_source(now.limit(0), flows).isEmpty()


def test_columns_that_keep_their_name_inherit(spark, rows):
    listing = policy.local_rows(spark, [
        ("conformed_db", "customers", "first_name"), ("conformed_db", "customers", "ssn"), ("consumption_db", "dim_customers", "first_name"),
        ("consumption_db", "dim_customers", "customer_key"), ("consumption_db", "dim_customers", None)], ["database", "table", "column"])
    flows = policy.local_rows(spark, [("conformed_db", "customers", "consumption_db", "dim_customers")],
                              ["from_database", "from_table", "database", "table"])
    made = lineage.same_name_lineage(listing, flows)
    assert rows(made) == [("conformed_db", "customers", "first_name", "consumption_db", "dim_customers", "first_name")]
    now = policy.local_rows(spark, [("conformed_db", "customers", "first_name", "PII", "quasi"),
                                    ("consumption_db", "dim_customers", "first_name", "PII", "none")], TAG)
    assert rows(lineage.weaker_than_source(now, made)) == [("consumption_db", "dim_customers", "first_name", "none", "quasi")]


def test_hot_groups_are_cut_in_parts(spark, plan, monkeypatch):
    hot = spark.range(5000).select(F.concat(F.lit("t"), (F.col("id") % 1).cast("string")).alias("table"), F.lpad(F.col("id").cast("string"), 9, "0").alias("version"),
                                   F.timestamp_seconds(F.col("id") % 7).alias("committed_at"))
    for n in (3, 2000):
        few = {r.version for r in upkeep.retained_versions(hot, n).collect()}
        ranked = sorted(hot.collect(), key=lambda r: (r.committed_at, r.version), reverse=True)
        assert few == {r.version for r in ranked[:n]}
    text = plan(upkeep.head_sample(hot, 2000, ["table"], ["committed_at", "version"]))
    assert text.count("Window [row_number()") == 2 and "hashpartitioning(table#" in text and ", __part#" in text
    assert "WindowGroupLimit" in plan(upkeep.head_sample(hot, 3, ["table"], ["committed_at", "version"]))


def test_storage_is_summed_by_folder_before_it_is_rolled_up(spark, rows, plan):
    files = spark.createDataFrame([("s3://b/x/y/f1", 1, 5), ("s3://b/x/y/f2", 2, 9), ("s3://b/x/g", 4, 1), ("s3://top", 8, 7), ("/r/1/2/3/4/5/6/h", 16, 2)],
                                  "path string, length long, modificationTime long")
    out = upkeep.storage_metrics(files)
    assert {(r.prefix, r.depth): (r.bytes, r.files, r.last_modified) for r in out.collect()} == {
        ("b", 1): (7, 3, 9), ("b/x", 2): (7, 3, 9), ("b/x/y", 3): (3, 2, 9), **{
            ("/".join(["", "r", "1", "2", "3"][:d]), d): (16, 1, 2) for d in range(1, 6)}}
    text = plan(out)
    assert text.index("Generate explode") < text.rindex("partial_sum(length")  # printed from the top: the sum by folder lies below


def test_maintenance_returns_what_it_found(spark, tmp_path):
    name, root = "t_" + uuid.uuid4().hex, str(tmp_path / "versions")
    schema = spark.createDataFrame([], "id long, part string").schema
    tables.create_table(spark, name, schema, ["part"])
    for i in range(6):
        tables.append_table(spark, name, spark.range(i, i + 1).withColumn("part", F.lit("p")))
    for i in range(5):
        versions.write_version(spark.range(i), root, "m", f"{i}")
    spark.range(1).coalesce(1).write.parquet(f"{tables.table_location(spark, name)}/left")
    spark.catalog.refreshTable(name)
    done = maintain_all(spark, f" missing_one ,{name}", version_roots={name: root}, now=datetime(2100, 1, 1, tzinfo=timezone.utc))
    assert [(r.table, r.step, r.ok) for r in done.status.collect()] == [
        ("missing_one", "compact", False), (name, "compact", True), (name, "expire", True), (name, "orphans", True)]
    assert "missing_one" in done.status.first().message
    assert [(r.table, r.partition, r.files, r.target_files) for r in done.merged.collect()] == [(name, "part=p/", 6, 1)]
    assert sorted((r.table, r.version) for r in done.versions.collect()) == [(name, "0"), (name, "1")]
    assert any("/left/part-" in r.path for r in done.orphans.collect())
    nothing = maintain_all(spark, "")
    assert all(getattr(nothing, k).isEmpty() for k in ("status", "merged", "versions", "orphans"))
