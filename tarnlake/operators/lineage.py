"""Tags along column lineage: what a column inherits from the columns it is made from.

Lineage is rows ``from_database, from_table, from_column, database, table, column``: the
latter column is made from the former.  It may branch, join and even form cycles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarnlake.session import stage

COLUMN = ["database", "table", "column"]
# How strict the values of the PII tag are.
PII_RANKS = {"none": 0, "quasi": 1, "direct": 2}


def _rank(value: Column, ranks: Mapping[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in ranks.items():
        out = F.when(value == name, F.lit(rank)).otherwise(out)
    return out


def _name(rank: Column, ranks: Mapping[str, int]) -> Column:
    return F.get(F.array(*[F.lit(n) for n, _ in sorted(ranks.items(), key=lambda r: r[1])]), rank)


def same_name_lineage(catalog: DataFrame, flows: DataFrame) -> DataFrame:
    """Lineage of tables whose columns keep their names; ``flows`` are ``from_database, from_table, database, table``.

    ``catalog`` is a listing as of ``catalog_columns``.  A column that only one of the two
    tables has is made there or dropped, and inherits nothing.
    """
    columns = catalog.where("column IS NOT NULL").distinct()
    source = columns.select(*[F.col(c).alias(f"from_{c}") for c in COLUMN])
    return flows.join(source, ["from_database", "from_table"]).join(columns, ["database", "table"]).where(
        "from_column = column").select("from_database", "from_table", "from_column", *COLUMN)


def inherited(tags: DataFrame, lineage: DataFrame, tag: str = "PII", ranks: Mapping[str, int] = PII_RANKS) -> DataFrame:
    """Stored ``database, table, column, rank``: the strictest value of all columns that one is made from, itself included.

    Ranks only rise along lineage, one step of it a round, so the rounds end with the longest path and in
    cycles too.  Every round is a map-side maximum and a join; only columns whose rank rose go on.
    Columns without a tag that is ranked, and whose sources have none, are left out.
    """
    own = tags.where(F.col("tag") == tag).select(*COLUMN, _rank(F.col("value"), ranks).alias("rank"))
    edges = stage(lineage.select("from_database", "from_table", "from_column", *COLUMN).distinct(), "lineage-edges")
    known = stage(own.where("rank IS NOT NULL").groupBy(*COLUMN).agg(F.max("rank").alias("rank")), "lineage-ranks")
    risen = known
    while True:
        source = risen.select(*[F.col(c).alias(f"from_{c}") for c in COLUMN], "rank")
        offered = edges.join(source, [f"from_{c}" for c in COLUMN]).groupBy(*COLUMN).agg(F.max("rank").alias("offered"))
        rises = offered.join(known, COLUMN, "left").where(F.col("offered") > F.coalesce("rank", F.lit(-1))).select(
            *COLUMN, F.col("offered").alias("rank"))
        seen = Observation()
        risen = stage(rises.observe(seen, F.count(F.lit(1)).alias("n")), "lineage-risen")
        if not seen.get["n"]:
            return known
        known = stage(known.unionByName(risen).groupBy(*COLUMN).agg(F.max("rank").alias("rank")), "lineage-ranks")


def weaker_than_source(
    tags: DataFrame, lineage: DataFrame, tag: str = "PII", ranks: Mapping[str, int] = PII_RANKS,
) -> DataFrame:
    """Columns tagged less strictly than a column they are made from: ``database, table, column, value, inherited``.

    A made column without the tag counts too, with a NULL ``value``, unless all it inherits is the least strict.
    """
    now = tags.where(F.col("tag") == tag).groupBy(*COLUMN).agg(F.max_by("value", F.coalesce(_rank(F.col("value"), ranks), F.lit(-1))).alias("value"))
    found = inherited(tags, lineage, tag, ranks).join(now, COLUMN, "left")
    least = min(ranks.values())
    return found.where(F.col("rank") > F.coalesce(_rank(F.col("value"), ranks), F.lit(least))).select(
        *COLUMN, "value", _name(F.col("rank"), ranks).alias("inherited"))


def strengthened(
    tags: DataFrame, lineage: DataFrame, tag: str = "PII", ranks: Mapping[str, int] = PII_RANKS,
) -> DataFrame:
    """Tag rows that would make every weaker column as strict as its strictest source."""
    return weaker_than_source(tags, lineage, tag, ranks).select(
        *COLUMN, F.lit(tag).alias("tag"), F.col("inherited").alias("value"))
