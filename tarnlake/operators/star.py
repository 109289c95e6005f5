"""Star schema operators: versioned customer dimension, transaction fact, sales mart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.functions.columns import with_missing
from tarnlake.operators.upsert import require_unique, upsert
from tarnlake.session import batch_time, stage


def random_key(key: str) -> Column:
    return F.expr("uuid()")


def replayable_key(key: str) -> Column:
    """The same key for the same business key and start time, so a run can be replayed."""
    return F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col("start_date").cast("string")), 256)


class Scd2Change(NamedTuple):
    """Parts of a dimension after a run; their union is the new dimension."""

    closed: DataFrame   # versions that were closed before this run
    current: DataFrame  # open versions, of which the changed ones are now closed
    opened: DataFrame   # versions opened by this run


def changed_rows(
    current: DataFrame, fresh: DataFrame, key: str, tracked: Sequence[str], null_safe: bool = False,
) -> DataFrame:
    """Rows of ``fresh`` that are new or differ from their open version.

    A comparison with NULL on either side is not a change unless ``null_safe``.
    """
    before = current.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__was_{c}") for c in tracked])

    def differs(c: str) -> Column:
        old, new = F.col(f"__was_{c}"), F.col(c)
        return ~new.eqNullSafe(old) if null_safe else new != old

    known = fresh.where(F.col(key).isNotNull())
    found = known.join(before, known[key] == before["__key"], "left").where(
        F.col("__key").isNull() | reduce(or_, [differs(c) for c in tracked]))
    changed = found.select(*fresh.columns)
    # A NULL key matches no version, so such rows always count as new and skip the join.
    return changed.unionByName(fresh.where(F.col(key).isNull()))


def new_versions(
    dim: DataFrame, changed: DataFrame, key: str = "customer_id", batch_ts: Column | None = None,
    surrogate=random_key, surrogate_name: str = "customer_key",
) -> Scd2Change:
    """Close the open version of each changed row and open a new one.

    One ``batch_ts`` does both, so validity intervals are half open and adjacent.
    An open version that several changed rows match is an error.  ``changed`` is
    read several times and should be stored.
    """
    now = batch_time() if batch_ts is None else batch_ts
    ending = changed.select(key).withColumn("is_current", F.lit(False)).withColumn("end_date", now)
    expired = upsert(dim.where("is_current"), ending, [key], ["is_current", "end_date"], None, stored=True)
    stamped = (
        changed
        .withColumn("start_date", now)
        .withColumn("end_date", F.lit(None))
        .withColumn("is_current", F.lit(True))
    )
    if "ingested_at" in dim.columns:
        stamped = stamped.withColumn("ingested_at", now)
    opened = with_missing(stamped.withColumn(surrogate_name, surrogate(key)), dim.schema)
    return Scd2Change(dim.where("NOT coalesce(is_current, false)"), expired, opened)


def scd2_apply(
    dim: DataFrame, fresh: DataFrame, key: str = "customer_id",
    tracked: Sequence[str] = tuple(schemas.TRACKED), null_safe: bool = False,
    on_duplicate: str = "reference", **options,
) -> DataFrame:
    """The whole dimension after a type-2 step; further options as ``new_versions``.

    ``on_duplicate="error"`` rejects repeated keys in ``fresh``, which otherwise
    fail only when they match an open version.
    """
    if on_duplicate == "error":
        require_unique(fresh, [key], "fresh rows")
    elif on_duplicate != "reference":
        raise ValueError("on_duplicate must be 'reference' or 'error'")
    changed = stage(changed_rows(dim.where("is_current"), fresh, key, tracked, null_safe), "scd2-changed")
    parts = new_versions(dim, changed, key, **options)
    return parts.closed.unionByName(parts.current).unionByName(parts.opened)


def expire_current(dim: DataFrame, updates: DataFrame, key: str, batch_ts: Column) -> DataFrame:
    """Close the open versions of the keys in ``updates``; nothing is inserted."""
    ending = updates.select(key).withColumn("is_current", F.lit(False)).withColumn("end_date", batch_ts)
    return upsert(dim, ending, [key], ["is_current", "end_date"], None, target_filter="is_current")


def fact_rows(txns: DataFrame, dim: DataFrame, batch_ts: Column | None = None) -> DataFrame:
    """Transactions keyed to the *current* dimension row, or ``UNKNOWN``.

    Transactions are the left side, so a customer who holds a third of them is
    split by AQE when the dimension is too large to broadcast.
    """
    now = batch_time() if batch_ts is None else batch_ts
    keys = dim.where("is_current").select("customer_id", "customer_key")
    joined = txns.drop("customer_key", "ingested_at").join(keys, "customer_id", "left")
    stamped = joined.withColumn(
        "customer_key", F.coalesce("customer_key", F.lit(schemas.UNKNOWN_KEY))).withColumn("ingested_at", now)
    return stamped.select([c for c in schemas.FACT_TRANSACTIONS.names if c in stamped.columns])


def build_fact(
    txns: DataFrame, dim: DataFrame, fact: DataFrame, batch_ts: Column | None = None,
    on_duplicate: str = "reference",
) -> DataFrame:
    """The fact after all transactions are merged in; matched facts get the newest key."""
    rows = fact_rows(txns, dim, batch_ts)
    updates = [c for c in schemas.FACT_UPDATES if c in rows.columns]
    return upsert(fact, rows, ["transaction_id"], updates, rows.columns, on_duplicate, ["ingested_at"])


def mart_sales(fact: DataFrame) -> DataFrame:
    """Sales per day, region and product category.

    Amounts are summed as decimals: the total does not depend on task order.
    """
    amount = F.col("amount").try_cast("decimal(18,2)")
    return fact.groupBy(
        F.to_date("transaction_time").alias("sales_day"), "region_code", "product_category",
    ).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(amount).cast("double").alias("revenue"),
        F.try_divide(F.sum(amount).cast("double"), F.count(amount)).alias("avg_amount"),
        F.countDistinct("customer_id").alias("customers"),
    )
