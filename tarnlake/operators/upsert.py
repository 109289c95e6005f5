"""Keyed upsert of one DataFrame into another, with table-MERGE semantics.

* A NULL key never matches: NULL-key source rows are always inserted.
* Only ``update_cols`` change on a match; only ``insert_cols`` are filled on insert.
* A target row matched by more than one source row is an error.
* Repeated source keys that match nothing are all inserted.

The source is stored once and measured.  Within Spark's broadcast limit it is
broadcast, and the target, scanned in place, is not shuffled.  Beyond the limit
the target is the left side of a shuffled left join: a key that holds a third of
it is split by AQE's skew join, which a full outer join would rule out and an
aggregate between shuffle and join would prevent.  Repeated source keys are set
aside before any join, and target keys are made distinct in each map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import data_bytes, fits_broadcast, stage, within_broadcast

DUPLICATE_POLICIES = ("reference", "error", "latest")


class DuplicateKeyError(ValueError):
    """A source holds more than one row for a key."""


def _not_null(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by all other columns.

    NULL keys are distinct from each other, so rows with one are all kept.
    ``row_number() = 1`` lets Spark drop all but one row per key in each map
    task (WindowGroupLimit), so a hot key does not reach one reducer whole.
    """
    rest = [c for c in df.columns if c not in {*order_by, *keys}]
    latest_first = [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    kept = df.where(_not_null(keys)).withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    if not any(df.schema[k].nullable for k in keys):
        return kept
    return kept.unionByName(df.where(~_not_null(keys)))


def duplicate_keys(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None) -> DataFrame:
    """Keys held by more than one source row, with their ``copies``.

    With a ``target`` only keys that match it are returned: the keys an upsert
    would reject.
    """
    counts = source.where(_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = counts.where("copies > 1")
    if target is None:
        return repeated
    return repeated.join(target.select(*keys).distinct(), list(keys), "left_semi")


def require_unique(source: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise when a non-NULL key repeats.  Names the key columns, never values."""
    if not duplicate_keys(source, keys).isEmpty():
        raise DuplicateKeyError(f"{what} has repeated keys in {list(keys)}")


def keys_among(table: DataFrame, rows: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Distinct keys of ``table`` that stored ``rows`` hold too.

    When the rows are ``small`` enough to broadcast, the table's keys are filtered
    in place; otherwise they are made distinct in each map task, then shuffled.
    """
    keys = list(keys)
    if small:
        return table.select(*keys).join(F.broadcast(rows.select(*keys)), keys, "left_semi").distinct()
    return table.select(*keys).distinct().join(rows.select(*keys), keys, "left_semi")


def not_in(rows: DataFrame, table: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Stored ``rows`` whose key is not in ``table``."""
    found = keys_among(table, rows, keys, small) if small else table.select(*keys).distinct()
    return rows.join(found, list(keys), "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str] | None,
    on_duplicate: str = "reference",
    order_by: Sequence[str] = (),
    target_filter: Column | str | None = None,
    stored: bool = False,
) -> DataFrame:
    """The rows of ``target`` after merging ``source`` into it.

    ``insert_cols=None`` updates only.  ``target_filter`` limits which target
    rows may match.  ``on_duplicate``: ``"reference"`` rejects a repeated key
    only when it matches, ``"error"`` rejects any repeated key, ``"latest"``
    first keeps the greatest row per key by ``order_by``.  ``stored`` says that
    the source is a plain scan already, which spares the staged copy.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    keys = list(keys)
    if on_duplicate == "latest":
        source, stored = dedupe_latest(source, keys, order_by), False
    if not stored:
        source = stage(source, "upsert-source")
    eligible = F.expr(target_filter) if isinstance(target_filter, str) else target_filter
    present = target if eligible is None else target.where(eligible)

    # Source rows that can match: keys are unique and not NULL.
    single, rest = source.where(_not_null(keys)), source.where(~_not_null(keys))
    if on_duplicate != "latest":
        repeated = stage(duplicate_keys(source, keys), "upsert-repeated")
        size = data_bytes(repeated)
        if size:
            if on_duplicate == "error":
                raise DuplicateKeyError(f"source has repeated keys in {keys}")
            few = within_broadcast(source.sparkSession, size)
            ambiguous = keys_among(present, repeated, keys, few).count()
            if ambiguous:
                raise DuplicateKeyError(f"{ambiguous} target keys in {keys} are matched by several source rows")
            # Their keys match nothing, so these rows are inserted without a join.
            rest = rest.unionByName(source.join(repeated, keys, "left_semi"))
            if few:
                single = single.join(F.broadcast(repeated), keys, "left_anti")
            else:
                single = stage(single.join(repeated, keys, "left_anti"), "upsert-single")

    small = fits_broadcast(source)
    updated = _updated(target, single, keys, list(update_cols), eligible, small)
    if insert_cols is None:
        return updated
    fresh = not_in(single, present, keys, small).unionByName(rest)
    filled = set(insert_cols)
    inserted = fresh.select([
        (F.col(f.name) if f.name in filled else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ])
    return updated.unionByName(inserted)


def _updated(
    target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
    eligible: Column | None, small: bool,
) -> DataFrame:
    """Target rows, with matched ones overwritten.  Source keys are unique."""
    side = source.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c).alias(f"__new_{c}") for c in update_cols],
        F.lit(True).alias("__hit"),
    )
    tagged = target if eligible is None else target.withColumn("__eligible", F.coalesce(eligible, F.lit(False)))
    same = [tagged[k] == side[f"__k_{k}"] for k in keys]
    if eligible is not None:
        same.append(tagged["__eligible"])
    joined = tagged.join(F.broadcast(side) if small else side, reduce(and_, same), "left")
    hit = F.col("__hit").isNotNull()
    return joined.select([
        (F.when(hit, F.col(f"__new_{f.name}").cast(f.dataType)).otherwise(target[f.name]).alias(f.name)
         if f.name in update_cols else target[f.name])
        for f in target.schema.fields
    ])
