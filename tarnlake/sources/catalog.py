"""Catalogue metadata as a relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tarnlake.sinks.derived import table_derived
from tarnlake.sources.policy import local_rows


def catalog_columns(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """``database, table, column`` of every table in the databases that exist.

    Listing is a catalogue call per table; only names are held by the driver.  A
    table without columns gives one row with a NULL column.  Derived partitions
    are no governed columns and are left out.
    """
    rows = []
    for database in databases:
        if not spark.catalog.databaseExists(database):
            continue
        for table in spark.catalog.listTables(database):
            if table.isTemporary:
                continue
            name = f"`{database}`.`{table.name}`"
            derived = {} if table.tableType == "VIEW" else table_derived(spark, name)
            columns = [c for c in spark.catalog.listColumns(name) if c.name not in derived]
            rows += [(database, table.name, c.name) for c in columns] or [(database, table.name, None)]
    return local_rows(spark, rows, ["database", "table", "column"])
