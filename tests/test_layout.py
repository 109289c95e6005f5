"""Partitions derived from a time, and exchange of small files."""

import json
import re
import uuid

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tarnlake import schemas
from tarnlake.operators import upkeep
from tarnlake.sinks import compaction, derived, exchange, tables
from tarnlake.sources.catalog import catalog_columns

SCHEMA = "id string, kind string, amount long, seen_at timestamp"


@pytest.fixture
def name():
    return "t_" + uuid.uuid4().hex


def seen(spark, *rows):
    df = spark.createDataFrame([(i, k, a, t) for i, k, a, t in rows], "id string, kind string, amount long, t string")
    return df.select("id", "kind", "amount", F.col("t").cast("timestamp").alias("seen_at"))


def make(spark, name, layout, columns):
    tables.create_table(spark, name, spark.createDataFrame([], SCHEMA).schema, layout, day_columns=columns)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("columns,layout,where", [
    ({"seen_day": "seen_at"}, ["seen_day", "kind"], "seen_day=2026-01-31/kind=x/"),
    ({"seen_month": "month(seen_at)"}, ["kind", "seen_month"], "kind=x/seen_month=2026-01-01/"),
    ({"y": "YEAR( seen_at )", "d": "day(seen_at)"}, ["y", "d"], "y=2026-01-01/d=2026-01-31/"),
])
def test_a_table_keeps_its_own_partition_transforms(spark, name, plan, columns, layout, where):
    make(spark, name, layout, columns)
    first = seen(spark, ("a", "x", 1, "2026-01-31 10:00:00"), ("b", "x", 2, "2026-02-01 00:00:00"), ("c", "y", 3, None),
                 ("d", "x", 4, "2027-05-05 05:00:00"))
    tables.append_table(spark, name, first)
    assert where in {r.partition for r in tables.table_files(spark, name).collect()}
    spans = {("2026-01-31 00:00:00", "2026-02-01 00:00:00"): ["a"], ("2026-01-31 10:00:00", "2026-02-01 00:00:01"): ["a", "b"],
             ("2026-02-02 00:00:00", "2027-05-05 05:00:00"): [], ("2020-01-01 00:00:00", "2030-01-01 00:00:00"): ["a", "b", "d"]}
    for (low, high), want in spans.items():
        out = tables.table_between(spark, name, low, high, "seen_at")
        assert ids(out) == want and out.columns == [c for c in spark.table(name).columns if c not in columns]
    text = plan(out)
    for column in columns:
        assert f"isnotnull({column}" in text.split("PartitionFilters: [")[1].split("]")[0]
    # b moves to another month, a to another kind; e is new.
    tables.upsert_table(spark, name, seen(
        spark, ("b", "x", 20, "2026-03-01 00:00:00"), ("a", "z", 10, "2026-01-31 10:00:00"), ("e", "x", 5, "2026-01-31 11:00:00")),
        ["id"], ["kind", "amount", "seen_at"])
    rows = {r.id: (r.kind, r.amount) for r in tables.read_table(spark, name).collect()}
    assert rows == {"a": ("z", 10), "b": ("x", 20), "c": ("y", 3), "d": ("x", 4), "e": ("x", 5)}
    assert ids(tables.table_between(spark, name, "2026-03-01 00:00:00", "2026-03-02 00:00:00", "seen_at")) == ["b"]
    held = spark.table(name).select("id", *columns, *[d.of(F.col("seen_at")).alias(f"own_{c}") for c, d in derived.table_derived(spark, name).items()])
    assert all(r[c] == r[f"own_{c}"] for r in held.collect() for c in columns)
    compaction.compact_table(spark, name, min_files=2)
    assert {r.id: (r.kind, r.amount) for r in tables.read_table(spark, name).collect()} == rows


def test_transforms_are_checked(spark, name):
    with pytest.raises(ValueError, match="no partition transform"):
        make(spark, name, ["d"], {"d": "week(seen_at)"})
    make(spark, name, ["seen_day"], {"seen_day": "seen_at", "unused": "month(seen_at)"})
    assert derived.table_derived(spark, name) == {"seen_day": derived.Derived("day", "seen_at")}
    # A derived column that comes with the rows is computed anew, an absent source is NULL.
    tables.append_table(spark, name, seen(spark, ("a", "x", 1, "2026-01-01 00:00:00")).withColumn("seen_day", F.lit("1999-01-01").cast("date")))
    tables.append_table(spark, name, spark.createDataFrame([("b",)], "id string"))
    assert {r.id: str(r.seen_day) for r in spark.table(name).collect()} == {"a": "2026-01-01", "b": "None"}
    columns = {r["column"] for r in catalog_columns(spark, ["default"]).where(F.col("table") == name).collect()}
    assert columns == {"id", "kind", "amount", "seen_at"}


def test_tables_without_the_property_have_the_usual_days(spark, name):
    tables.create_table(spark, name, schemas.TRANSACTIONS, ["transaction_day"])
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{derived.PROPERTY}')")
    assert derived.table_derived(spark, name) == {"transaction_day": derived.Derived("day", "transaction_time")}


# compaction

def files_of(spark, name):
    return {r.path: r.length for r in tables.one_spelling(tables.table_files(spark, name)).collect()}


def fill(spark, name):
    """One large file and six small ones in a partition, three small ones in another."""
    make(spark, name, ["kind"], {})
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("a b+c%").alias("kind"),
                                      F.col("id").alias("amount"), F.lit("2026-01-01").cast("timestamp").alias("seen_at"))
    tables.append_table(spark, name, rows.coalesce(1))
    large = set(files_of(spark, name))
    for i in range(6):
        tables.append_table(spark, name, seen(spark, (f"s{i}", "a b+c%", i, None)))
    for i in range(3):
        tables.append_table(spark, name, seen(spark, (f"t{i}", "other", i, None)))
    return large


def test_compaction_leaves_large_files_alone(spark, name, rows):
    large = fill(spark, name)
    before, listed = rows(spark.table(name)), files_of(spark, name)
    plan = compaction.compact_table(spark, name, max_bytes=1_000_000).collect()
    after = files_of(spark, name)
    assert len(large) == 1 and large < set(after)
    assert {p for p in listed if "kind=other" in p} <= set(after)  # too few files there
    small = {p for p in listed if p not in large and "kind=other" not in p}
    assert [(r.files, r.target_files, r.bytes) for r in plan] == [(6, 1, sum(listed[p] for p in small))]
    assert len(set(after) - set(listed)) == 1 and not small & set(after)
    assert rows(spark.table(name)) == before
    assert compaction.compact_table(spark, name, max_bytes=1_000_000).isEmpty()
    assert not [r.path for r in tables.table_orphans(spark, name, F.lit("2100-01-01").cast("timestamp")).collect()]


def test_a_partition_may_have_several_groups(spark, name, rows):
    make(spark, name, ["kind"], {})
    for i in range(12):
        tables.append_table(spark, name, spark.range(i * 2000, (i + 1) * 2000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("k").alias("kind"), F.col("id").alias("amount")).coalesce(1))
    before, listed = rows(spark.table(name)), files_of(spark, name)
    plan = compaction.compact_table(spark, name, max_bytes=4 * max(listed.values())).collect()
    assert [(r.files, r.target_files) for r in plan] == [(12, 3)]
    after = files_of(spark, name)
    assert len(after) == 3 and not set(after) & set(listed)
    assert rows(spark.table(name)) == before


def test_groups_are_bounded_and_whole(spark):
    sizes = [5, 30, 30, 30, 40, 50, 99, 100, 250]
    files = spark.createDataFrame([("p", f"f{i}", n) for i, n in enumerate(sizes)] + [("q", "g", 1)], "part string, path string, length long")
    found = upkeep.compaction_groups(files, ["part"], max_bytes=100, min_files=2).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.group, []).append(r.length)
    assert sorted(map(sorted, groups.values())) == [[5, 30, 30, 30, 40], [50, 99]] or all(
        len(g) > 1 and sum(g) < 200 for g in groups.values())
    assert max(n for g in groups.values() for n in g) < 100 and all(r.part == "p" for r in found)


def test_unpartitioned_tables_are_compacted_in_place(spark, name, rows):
    make(spark, name, [], {})
    for i in range(6):
        tables.append_table(spark, name, seen(spark, (f"s{i}", None, i, None)))
    before = rows(spark.table(name))
    where = tables.table_location(spark, name)
    assert [(r.partition, r.target_files) for r in compaction.compact_table(spark, name).collect()] == [("", 1)]
    assert rows(spark.table(name)) == before and len(files_of(spark, name)) == 1
    assert tables.table_location(spark, name) == where


@pytest.mark.parametrize("lost_at", ["first move", "second deletion", "journal removal"])
def test_an_interrupted_exchange_is_finished(spark, name, rows, monkeypatch, lost_at):
    fill(spark, name)
    before = rows(spark.table(name))
    calls = {"move": 0, "delete": 0}
    move, delete = exchange.Folder.move, exchange.Folder.delete

    def lose(kind, real, at):
        def call(self, *paths):
            calls[kind] += 1
            if calls[kind] > at:
                raise ConnectionError("lost")
            return real(self, *paths)
        return call
    if lost_at == "first move":
        monkeypatch.setattr(exchange.Folder, "move", lose("move", move, 0))
    else:
        monkeypatch.setattr(exchange.Folder, "delete", lose("delete", delete, 1 if lost_at == "second deletion" else 6))
    with pytest.raises(ConnectionError):
        compaction.compact_table(spark, name, max_bytes=1_000_000)
    monkeypatch.undo()
    pending = derived.properties(spark, name).get(tables.PENDING)
    assert (pending is None) == (lost_at == "journal removal")
    if pending:
        assert tables.EXCHANGE in json.loads(pending)
    # The next write of any kind finishes it first.
    tables.append_table(spark, name, seen(spark, ("new", "other", 9, None)))
    assert derived.properties(spark, name).get(tables.PENDING) is None
    assert rows(spark.table(name).where("id <> 'new'")) == before
    assert len([p for p in files_of(spark, name) if "kind=other" not in p]) == 2


def test_a_failed_write_exchanges_nothing(spark, name, rows, monkeypatch):
    fill(spark, name)
    before, listed = rows(spark.table(name)), files_of(spark, name)

    def fail(*_):
        raise OSError("no space")
    monkeypatch.setattr(exchange, "write_journal", fail)
    with pytest.raises(OSError):
        compaction.compact_table(spark, name, max_bytes=1_000_000)
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == before
    assert set(listed) <= set(files_of(spark, name))


@pytest.fixture
def written(spark, monkeypatch):
    """Plans of all writes into tables, under the settings they run with."""
    plans, write = [], DataFrameWriter.insertInto

    def insert(self, table, overwrite=None):
        self._df.createOrReplaceTempView("inserted")
        plans.append(spark.sql(f"EXPLAIN INSERT INTO {table} SELECT * FROM inserted").first()[0])
        return write(self, table, overwrite)
    monkeypatch.setattr(DataFrameWriter, "insertInto", insert)
    return plans


@pytest.mark.parametrize("query", ["orphans_in_table", "compacted_table", "stored_months"])
def test_no_task_sorts_or_writes_a_whole_table(spark, written, query):
    found = entry.queries()[query](spark, "/root/testdata/sf0.001")
    assert found.count() and written
    for text in written:
        assert "Coalesce" not in text and not re.search(r"\bSort\b", text), text


def test_a_task_of_more_partitions_than_it_opens_writes_them_all(spark):
    name = "t_" + uuid.uuid4().hex
    rows = spark.range(0, 400, 1, 1).selectExpr("id", "cast(id as string) AS v", "cast(id % 40 as string) AS p")
    tables.create_table(spark, name, rows.schema, ["p"])
    tables.append_table(spark, name, rows)
    listed = tables.table_files(spark, name)
    assert listed.select("partition").distinct().count() == 40 == listed.count() > tables.OPEN_FILES
    twice = rows.where("id % 2 = 0").withColumn("v", F.lit("new"))
    assert tables.upsert_table(spark, name, twice, ["id"], ["v"]) == {"rewritten": 20, "dropped": 0}
    got = {r.id: (r.v, r.p) for r in spark.table(name).collect()}
    assert got == {i: ("new" if i % 2 == 0 else str(i), str(i % 40)) for i in range(400)} and spark.table(name).count() == 400
