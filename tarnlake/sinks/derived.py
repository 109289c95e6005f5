"""Partition columns derived from a time column, kept with the table they partition.

A mapping such as ``{"event_day": "ts", "event_month": "month(ts)"}`` is stored as a
table property, so whoever appends, merges, compacts or reads a span of time needs
the table's name only.  A bare column means its day.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake import schemas

PROPERTY = "tarnlake.derived"
# Each keeps the order of times, so a span of times is a span of its values.
TRANSFORMS = {
    "day": F.to_date,
    "month": lambda time: F.trunc(time, "month"),
    "year": lambda time: F.trunc(time, "year"),
}


class Derived(NamedTuple):
    transform: str
    source: str

    def of(self, time: Column) -> Column:
        return TRANSFORMS[self.transform](time)

    def __str__(self) -> str:
        return f"{self.transform}({self.source})"


def parse(text: str) -> Derived:
    """``month(ts)`` or, for its day, ``ts``."""
    found = re.fullmatch(r"\s*(\w+)\s*\(\s*(.+?)\s*\)\s*", text)
    out = Derived(found[1].lower(), found[2]) if found else Derived("day", text.strip())
    if out.transform not in TRANSFORMS:
        raise ValueError(f"no partition transform {out.transform}: {', '.join(TRANSFORMS)}")
    return out


def parse_all(columns: Mapping[str, str], layout: Sequence[str]) -> dict[str, Derived]:
    """Those of ``columns`` that ``layout`` partitions by."""
    return {name: parse(text) for name, text in columns.items() if name in layout}


def to_property(derived: Mapping[str, Derived]) -> str:
    return json.dumps({name: str(d) for name, d in derived.items()})


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_derived(spark: SparkSession, name: str) -> dict[str, Derived]:
    """The derived partition columns of a table.

    A table without the property has those that ``schemas.DAY_COLUMNS`` names.
    """
    layout = partition_columns(spark, name)
    if not layout:
        return {}
    text = properties(spark, name).get(PROPERTY)
    return parse_all(schemas.DAY_COLUMNS if text is None else json.loads(text), layout)


def add_derived(df: DataFrame, derived: Mapping[str, Derived]) -> DataFrame:
    """``df`` with the derived columns computed from their sources, replacing any it has."""
    lacking = sorted({d.source for d in derived.values()} - set(df.columns))
    if lacking:
        raise ValueError(f"partitions are derived from absent columns: {lacking}")
    return df.withColumns({name: d.of(F.col(d.source)) for name, d in derived.items()}) if derived else df


def span(df: DataFrame, time: str, low: str, high: str, derived: Mapping[str, Derived]) -> Column:
    """``low <= time < high`` with the bounds it puts on every partition column derived from ``time``."""
    kind = df.schema[time].dataType
    lo, hi = F.lit(low).cast(kind), F.lit(high).cast(kind)
    inside = [(F.col(time) >= lo) & (F.col(time) < hi)]
    inside += [F.col(name).between(d.of(lo), d.of(hi)) for name, d in derived.items() if d.source == time]
    return reduce(and_, inside)
