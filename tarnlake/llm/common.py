"""Helpers shared by the text operators.

Operators read only the columns they name, so further columns of an input, also
ones named like a result column, change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarnlake.session import data_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows handled at once in a Python worker: keeps memory flat on long texts.
SLICE = 128


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# What a task may be sent whole, whatever the session's own limit for broadcasts.
BROADCAST_BYTES = 64 << 20


def sent_whole(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table marked for broadcast if it is measured to be within ``limit``; else as it is, to be shuffled."""
    return F.broadcast(stored) if data_bytes(stored) <= limit else stored


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` is much the faster and does just that where all characters are ASCII.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def aside(docs: DataFrame, *own: str) -> DataFrame:
    """``own`` columns and ``__rest``, a struct of all others, which then cannot clash with working columns."""
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in own]
    return docs.select(*own, F.struct(F.lit(0).alias("none"), *rest).alias("__rest"))


def whole(rows: DataFrame, like: DataFrame, **new: Column) -> DataFrame:
    """Rows of ``aside(like, ...)`` with the columns of ``like`` again, some of them ``new``."""
    return rows.select(*[
        (new[c] if c in new else F.col(c) if c in rows.columns else F.col("__rest")[f"c{i}"]).alias(c)
        for i, c in enumerate(like.columns)])


def map_batches(
    df: DataFrame, columns: Sequence[str], ddl: str, make: Callable[[], Callable[..., dict]],
) -> DataFrame:
    """``make()`` once a task, then its result on the column lists of each slice of rows.

    Text columns arrive as UTF-8 bytes, others as Python values; the function
    returns lists by output column, of any common length.  If it has a ``finish``,
    that gives more rows after the task's last slice.
    """
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def rows(out: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                cells = [
                    (c.cast(pa.binary()) if pa.types.is_string(c.type) else c.cast(pa.large_binary())
                     if pa.types.is_large_string(c.type) else c).to_pylist() for c in part.columns]
                yield rows(work(*cells))
        if hasattr(work, "finish"):
            yield rows(work.finish())

    return df.select(*columns).mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], keep: Column | None = None,
) -> DataFrame:
    """At most ``per_class[k]`` labelled documents of each class: ``doc_id, label, text``.

    Chosen by the order of a hash of the id, so every row is as likely as any
    other and the choice is the same on every run.  An id labelled twice has the
    larger label.  Ids are bounded before the join and rows after it, so neither
    repeated ids nor a large table make the sample grow.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known if keep is None else known.where(keep)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == k).orderBy(*order).limit(n) for k, n in per_class.items()]
    ids = picked[0]
    for more in picked[1:]:
        ids = ids.unionByName(more)
    # Bounded by per_class: a few thousand pairs of numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.col("text").isNotNull())
    return rows.orderBy(*order, F.xxhash64("text")).limit(2 * sum(per_class.values()))
