"""Stored tables: create, partition-scoped upsert, SCD-2 step.

Tables are Parquet tables of the Spark catalogue.  Partitions derived from a time, such
as ``transaction_day``, are kept with the table (``derived``), so that every write
fills them and ``table_between`` reads no other days.

Only partitions holding a matched row are rewritten; everything else is appended.
New files are first staged in the shared folder and then moved in by
``INSERT``: a table is never written by a plan that reads it.  While staged rows
go in, a property of the table names their folder; the next write finishes what a
lost driver left, before anything else.  One writer per table is assumed.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake import schemas
from tarnlake.functions.columns import with_missing
from tarnlake.operators.star import changed_rows, new_versions
from tarnlake.operators.upkeep import orphan_files
from tarnlake.operators.upsert import dedupe_latest, not_in, require_unique, upsert
from tarnlake.session import fits_broadcast, new_path, stage
from tarnlake.sinks import exchange
from tarnlake.sinks.derived import (
    PROPERTY, add_derived, parse_all, partition_columns, properties, span, table_derived, to_property)
from tarnlake.sources.files import file_inventory

log = logging.getLogger(__name__)

# Shuffle block a written file is made from; its Parquet form is smaller.
WRITE_BYTES = 256 << 20
# Partitions that a task writes side by side, unsorted; one that meets more sorts the rows left, in memory for all of them.
OPEN_FILES = 8
# Beyond this many values of one partition column the scan is pruned by their range.
MAX_LISTED_VALUES = 1000
# Table property that names the staged rows of a write in progress.
PENDING = "tarnlake.pending"
# In that property: the folder of an exchange of files; that versions are to be closed.
EXCHANGE, CLOSING = "exchange", "closing"
# Folder of a table, skipped by readers, that lists the partitions changed by tracked writes.
CHANGES = "_changes"


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, layout: Sequence[str],
    day_columns: Mapping[str, str] = schemas.DAY_COLUMNS, location: str | None = None,
) -> None:
    """Create the database and the partitioned table when they are absent.

    ``day_columns`` maps partition columns to the time they are derived from, as in
    ``derived``; those of ``layout`` are kept with the table.
    """
    database = name.split(".")[0] if "." in name else None
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(name):
        return
    partitions, derived = list(layout), parse_all(day_columns, layout)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partitions]
    fields += [
        f"`{c}` {'date' if c in derived else schema[c].dataType.simpleString()}" for c in partitions
    ]
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(fields)}) USING parquet {by} "
        + (f"LOCATION '{location}' " if location else "") +
        f"TBLPROPERTIES ('parquet.compression'='snappy', '{PROPERTY}'='{to_property(derived)}', "
        f"'history.expire.max-snapshot-age-ms'='{schemas.SNAPSHOT_MAX_AGE_MS}')")


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The table's own columns, in schema order and without derived partition columns."""
    table = spark.table(name)
    if schema is None:
        return table.drop(*table_derived(spark, name))
    return table.select(*schema.names)


def between_time(
    df: DataFrame, low: str, high: str, time: str = "transaction_time", day: str = "transaction_day",
) -> DataFrame:
    """Rows with ``low <= time < high``; the added day bounds prune partitions."""
    return df.where(span(df, time, low, high, parse_all({day: time}, df.columns)))


def table_between(spark: SparkSession, name: str, low: str, high: str, time: str = "transaction_time") -> DataFrame:
    """A table's own columns of the rows with ``low <= time < high``.

    The bounds are carried over to every partition column that is derived from ``time``.
    """
    table, derived = spark.table(name), table_derived(spark, name)
    return table.where(span(table, time, low, high, derived)).drop(*derived)


def _clustered(df: DataFrame, layout: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together before a partitioned write.

    ``rebalance`` asks AQE for shuffle blocks of its advisory size: small
    partitions share a task and a partition with a third of the rows is split.
    """
    return df.hint("rebalance", *[F.col(c) for c in layout]) if layout else df


def write_partitioned(
    df: DataFrame, path: str, layout: Sequence[str], mode: str = "errorifexists",
    day_columns: Mapping[str, str] = schemas.DAY_COLUMNS,
) -> None:
    """Write a Parquet folder tree partitioned by ``layout``, with derived partition columns."""
    rows = _clustered(add_derived(df, parse_all(day_columns, layout)), layout)
    with writing(df.sparkSession):
        rows.write.mode(mode).option("compression", "snappy").partitionBy(*layout).parquet(path)


@contextmanager
def _settings(spark: SparkSession, conf: Mapping[str, str]):
    """Session settings for the duration of one write."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def writing(spark: SparkSession, block_bytes: int = WRITE_BYTES):
    """Settings of a partitioned write: blocks of the size of a file, written without a sort of the rows of a task."""
    return _settings(spark, {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{block_bytes}b",
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
    })


def _insert(
    spark: SparkSession, df: DataFrame, name: str, layout: Sequence[str], overwrite: bool,
    block_bytes: int = WRITE_BYTES,
) -> None:
    """Append, or replace exactly the partitions that ``df`` has rows for."""
    with writing(spark, block_bytes), _settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows = _clustered(df.select(*spark.table(name).columns), layout)
        rows.write.insertInto(name, overwrite=overwrite)


def _swap(spark: SparkSession, rows: DataFrame, name: str, block_bytes: int = WRITE_BYTES) -> None:
    """Give an unpartitioned table the rows of a new folder beside its old one.

    The old folder stays as it is, so a failed write leaves the table unchanged and
    readers of the old files go on; removing it is the caller's.
    """
    old = table_location(spark, name).rstrip("/")
    new = f"{re.sub(r'[.]v-[0-9a-f]{32}$', '', old)}.v-{uuid.uuid4().hex}"
    with _settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{block_bytes}b"}):
        rows.select(*spark.table(name).columns).hint("rebalance").write.option("compression", "snappy").parquet(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    log.info("%s reads %s; %s can be removed", name, new, old)


def append_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append by column name; columns the table lacks are refused, absent ones NULL."""
    finish_pending(spark, name)
    table = spark.table(name)
    layout = partition_columns(spark, name)
    unknown = sorted(set(rows.columns) - set(table.columns))
    if unknown:
        raise ValueError(f"columns not in {name}: {unknown}")
    derived = table_derived(spark, name)
    own = with_missing(rows.drop(*derived), table.drop(*derived).schema)
    _insert(spark, add_derived(own, derived), name, layout, overwrite=False)


def _partition_list(df: DataFrame, layout: Sequence[str]) -> list[tuple]:
    """Distinct partition values; metadata bounded by the number of partitions."""
    return [tuple(row) for row in df.select(*layout).distinct().collect()]


def _sql_literal(value) -> str:
    if value is None:
        return "null"
    return str(value).lower() if isinstance(value, bool) else "'" + str(value).replace("'", "\\'") + "'"


def _drop_partitions(spark: SparkSession, name: str, layout: Sequence[str], values: list[tuple]) -> None:
    """Empty and drop partitions.

    The files go first, by a static overwrite with no rows: dropping a partition
    of a table at a given location leaves them behind.
    """
    columns = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()})" for f in spark.table(name).schema.fields
        if f.name not in layout)
    for value in values:
        spec = ", ".join(f"`{c}`={_sql_literal(v)}" for c, v in zip(layout, value))
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {columns} FROM range(0)")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")


def _within(layout: Sequence[str], values: list[tuple]) -> Column:
    """A predicate on single partition columns that every listed partition meets.

    It prunes the scan; it may let other partitions through, which a join on the
    listed partitions then removes.
    """
    def one(i: int, name: str) -> Column:
        seen = {value[i] for value in values}
        known = [v for v in seen if v is not None]
        if len(known) > MAX_LISTED_VALUES:
            inside = F.col(name).between(F.lit(min(known)), F.lit(max(known)))
        else:
            inside = F.col(name).isin(known) if known else F.lit(False)
        return inside | F.col(name).isNull() if None in seen else inside

    return reduce(and_, [one(i, name) for i, name in enumerate(layout)])


def _in_partitions(df: DataFrame, listed: DataFrame, layout: Sequence[str], how: str) -> DataFrame:
    other = listed.select([F.col(c).alias(f"__p_{c}") for c in layout])
    same = reduce(and_, [df[c].eqNullSafe(other[f"__p_{c}"]) for c in layout])
    return df.join(other, same, how)


def in_partitions(table: DataFrame, listed: DataFrame, layout: Sequence[str]) -> DataFrame:
    """Rows of a stored table in the ``listed`` partitions; no other partition is read, unless they are very many."""
    values = _partition_list(listed, layout)
    if not values:
        return table.where(F.lit(False))
    return _in_partitions(table.where(_within(layout, values)), listed, layout, "left_semi")


def _replace(
    spark: SparkSession, name: str, layout: Sequence[str], rows: DataFrame, touched: DataFrame,
    partitions: list[tuple], unless: Sequence[str] = (),
) -> int:
    """Put staged ``rows`` in place: ``touched`` partitions are replaced, or dropped
    when no row is left in them, and rows of other partitions appended, with
    ``unless`` only those whose key of these columns the table lacks.  Returns the
    number dropped."""
    if not partitions and not unless:
        _insert(spark, rows, name, layout, overwrite=False)
        return 0
    replaced = _in_partitions(rows, touched, layout, "left_semi")
    emptied = sorted(set(partitions) - set(_partition_list(replaced, layout)), key=str)
    _insert(spark, replaced, name, layout, overwrite=True)
    _drop_partitions(spark, name, layout, emptied)
    added = _in_partitions(rows, touched, layout, "left_anti")
    if unless:
        added = stage(added.join(spark.table(name).select(*unless), list(unless), "left_anti"), "pending-added")
    if not added.isEmpty():
        _insert(spark, added, name, layout, overwrite=False)
    return len(emptied)


def _mark(spark: SparkSession, name: str, what: dict) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PENDING}'='{json.dumps(what)}')")


def _unmark(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """The write is in place; ``folder``, what it had staged, has served."""
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{PENDING}')")
    if folder:
        exchange.remove(spark, [folder])


def changed_partitions(spark: SparkSession, name: str) -> tuple[DataFrame | None, list[str]]:
    """Partitions noted by tracked writes, or None, and the folders of the notes.

    Whoever has acted on them removes the folders; what is noted in the meantime stays.
    """
    notes = exchange.Folder(spark, table_location(spark, name)).names(f"{table_location(spark, name).rstrip('/')}/{CHANGES}")
    if not notes:
        return None, []
    schema = spark.table(name).select(*partition_columns(spark, name)).schema
    return spark.read.schema(schema).parquet(*notes).distinct(), notes


def replace_partitions(spark: SparkSession, name: str, rows: DataFrame, touched: DataFrame) -> dict[str, int]:
    """Give a partitioned table ``rows`` in place of all it has in the ``touched`` partitions.

    Every row belongs to one of them; a partition without rows is dropped.  A lost
    run is completed by the next write.
    """
    finish_pending(spark, name)
    layout, folder = partition_columns(spark, name), new_path(spark, "replace-pending")
    touched = _stage_in(touched.select(*layout).distinct(), f"{folder}/touched")
    rows = _stage_in(rows.select(*spark.table(name).columns), f"{folder}/rows")
    partitions = _partition_list(touched, layout)
    _mark(spark, name, {"folder": folder, "keys": []})
    dropped = _replace(spark, name, layout, rows, touched, partitions)
    _unmark(spark, name, folder)
    return {"rewritten": len(partitions) - dropped, "dropped": dropped}


def finish_pending(spark: SparkSession, name: str) -> bool:
    """Put in place what an interrupted write or compaction had staged; ``False`` if there is nothing.

    Partitions are replaced again, which changes nothing if they were; rows to append
    are left out where the table has their key.  Rows without a key are appended twice
    if the loss fell exactly between their append and the removal of the mark.
    """
    text = properties(spark, name).get(PENDING)
    if text is None:
        return False
    found = json.loads(text)
    if EXCHANGE in found:
        put, taken = exchange.carry_out(spark, found[EXCHANGE])
        _unmark(spark, name, found[EXCHANGE])
        spark.catalog.refreshTable(name)
        log.info("%s: %d files in place of %d", name, put, taken)
        return True
    layout = partition_columns(spark, name)
    if found.get(CLOSING):
        _close_again(spark, name, layout, found["folder"])
    schema = spark.table(name).schema
    rows = spark.read.schema(schema).parquet(f"{found['folder']}/rows")
    touched = spark.read.schema(spark.table(name).select(*layout).schema).parquet(f"{found['folder']}/touched")
    _replace(spark, name, layout, rows, touched, _partition_list(touched, layout), unless=found["keys"])
    _unmark(spark, name)
    log.info("finished the interrupted write of %s from %s", name, found["folder"])
    return True


def upsert_table(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str],
    update_cols: Sequence[str], insert_cols: Sequence[str] | None = None,
    on_duplicate: str = "reference", order_by: Sequence[str] = (), track: bool = False,
) -> dict[str, int]:
    """Merge ``source`` into a stored table; an empty source leaves it untouched.

    With ``track`` the partitions that may change, those that rows leave and those they
    come to, are noted for ``changed_partitions`` before any does.  Returns how many partitions were rewritten and how many dropped as empty.
    """
    finish_pending(spark, name)
    # The plan behind the source, often a parse of raw files, runs once.
    source = stage(source, "upsert-source")
    if source.isEmpty():
        return {"rewritten": 0, "dropped": 0}
    layout = partition_columns(spark, name)
    table = spark.table(name)
    derived = table_derived(spark, name)
    own = [c for c in table.columns if c not in derived]
    if on_duplicate == "latest":
        source = stage(dedupe_latest(source, keys, order_by), "upsert-latest")
    elif on_duplicate == "error":
        require_unique(source, keys)
    insert_cols = [c for c in own if c in source.columns] if insert_cols is None else insert_cols

    def merged(target: DataFrame) -> DataFrame:
        rows = upsert(target.select(*own), source, keys, update_cols, insert_cols, stored=True)
        return add_derived(rows, derived).select(*table.columns)

    if not layout:
        _swap(spark, stage(merged(table), "upsert-rows"), name)
        return {"rewritten": 1, "dropped": 0}
    # Reads only the key and partition columns of the table.
    wanted = source.select(*keys)
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else stage(wanted.distinct(), "upsert-keys")
    matched = stage(
        table.select(*dict.fromkeys([*keys, *layout])).join(wanted, list(keys), "left_semi"),
        "upsert-matched")
    folder = new_path(spark, "upsert-pending")
    touched = _stage_in(matched.select(*layout).distinct(), f"{folder}/touched")
    partitions = _partition_list(touched, layout)
    rewritten = len(partitions)
    inside = table.where(_within(layout, partitions)) if partitions else table.where(F.lit(False))
    rows = _stage_in(merged(_in_partitions(inside, touched, layout, "left_semi")), f"{folder}/rows")
    if partitions and {derived[c].source if c in derived else c for c in layout} & set(update_cols):
        # A partition that a matched row moves to is replaced together with the one it leaves.
        moved = _in_partitions(rows, touched, layout, "left_anti").join(
            matched.select(*keys).distinct(), list(keys), "left_semi")
        receiving = stage(moved.select(*layout).distinct(), "upsert-receiving")
        more = _partition_list(receiving, layout)
        if more:
            there = _in_partitions(table.where(_within(layout, more)), receiving, layout, "left_semi")
            rewritten += len(_partition_list(there, layout))
            rows = _stage_in(there.select(*table.columns), f"{folder}/rows")
            touched = _stage_in(receiving, f"{folder}/touched")
            partitions += more
    if track:
        both = touched.unionByName(rows.select(*layout)).distinct()
        both.write.parquet(f"{table_location(spark, name).rstrip('/')}/{CHANGES}/{uuid.uuid4().hex}")
    _mark(spark, name, {"folder": folder, "keys": list(keys)})
    dropped = _replace(spark, name, layout, rows, touched, partitions)
    _unmark(spark, name, folder)
    return {"rewritten": rewritten - dropped, "dropped": dropped}


def _stage_in(df: DataFrame, path: str) -> DataFrame:
    """Add ``df`` to the staged rows at ``path``; all of them."""
    df.write.mode("append").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scd2_table(
    spark: SparkSession, name: str, fresh: DataFrame, key: str = "customer_id",
    tracked: Sequence[str] = tuple(schemas.TRACKED), null_safe: bool = False, **options,
) -> bool:
    """Type-2 step on a stored dimension; ``False`` when nothing changed.

    Rewrites partitions of open versions only and appends to the closed ones, none of
    which is read: what a lost run has closed is known from its mark, and is completed first.
    """
    finished = finish_pending(spark, name)
    layout = partition_columns(spark, name)
    table = spark.table(name)
    current = table.where("is_current")
    changed = stage(changed_rows(current, stage(fresh, "scd2-fresh"), key, tracked, null_safe), "scd2-changed")
    if changed.isEmpty():
        return finished
    folder = new_path(spark, "scd2-pending")
    change = new_versions(table.where("is_current"), changed, key, **options)
    opened = stage(change.opened, "scd2-opened")
    ended = _stage_in(change.current.where("NOT is_current").select(*table.columns), f"{folder}/closing")
    touched = _stage_in(ended.withColumn("is_current", F.lit(True)).select(*layout).distinct(), f"{folder}/touched")
    partitions = _partition_list(touched, layout)
    rows = opened.select(*table.columns)
    if partitions:
        before = _in_partitions(table.where(_within(layout, partitions)), touched, layout, "left_semi")
        kept = before.join(ended.select("customer_key"), "customer_key", "left_anti")
        rows = kept.select(*table.columns).unionByName(rows)
    rows = _stage_in(rows, f"{folder}/rows")
    _mark(spark, name, {"folder": folder, "keys": ["customer_key"], CLOSING: True})
    _insert(spark, ended, name, layout, overwrite=False)
    _replace(spark, name, layout, rows, touched, partitions)
    _unmark(spark, name, folder)
    return True


def _close_again(spark: SparkSession, name: str, layout: Sequence[str], folder: str) -> None:
    """Append those of the staged closed versions that a lost run had not appended.

    They end when that run began, so versions that ended before are not read.
    """
    table = spark.table(name)
    ended = spark.read.schema(table.schema).parquet(f"{folder}/closing")
    since = ended.agg(F.min("end_date")).first()[0]
    if since is not None:
        closed = table.where(~F.col("is_current") & (F.col("end_date") >= F.lit(since)))
        closing = not_in(ended, closed, ["customer_key"], fits_broadcast(ended))
        _insert(spark, stage(closing, "scd2-closing"), name, layout, overwrite=False)


def table_location(spark: SparkSession, name: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return found["data_type"]


def table_files(spark: SparkSession, name: str) -> DataFrame:
    """Data files of a table with their partition folder."""
    location = table_location(spark, name)
    files = file_inventory(spark, location).where(F.col("path").endswith(".parquet"))
    folder = F.regexp_extract("path", r"/((?:[^/=]+=[^/]*/)*)[^/]*$", 1)
    return files.withColumn("partition", folder)


def decoded(url: str) -> Column:
    """``path`` of a file's address in the listing's spelling: not percent-encoded."""
    return F.url_decode(F.replace(F.col(url), F.lit("+"), F.lit("%2B"))).alias("path")


def one_spelling(files: DataFrame) -> DataFrame:
    """``path`` with one slash after the scheme, however many it was listed with."""
    return files.withColumn("path", F.regexp_replace("path", "^([a-zA-Z0-9+.-]+):/+", "$1:/"))


def read_files(spark: SparkSession, name: str) -> DataFrame:
    """``path`` of the files that hold the rows a reader of the table sees."""
    return spark.table(name).select(decoded("_metadata.file_path")).distinct()


def table_orphans(spark: SparkSession, name: str, older_than: Column, folder: str | None = None) -> DataFrame:
    """Files below ``folder``, by default the table's own, that the table does not read."""
    listed = file_inventory(spark, folder or table_location(spark, name))
    return orphan_files(one_spelling(listed), one_spelling(read_files(spark, name)), older_than)
