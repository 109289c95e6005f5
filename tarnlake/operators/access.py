"""Row filters, column exclusion and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The data filters granted to analyst roles.
ROW_FILTERS = {"apac_analyst": "region_code = 'APAC'"}
EXCLUDED_COLUMNS = {"marketing_analyst": ["ssn", "phone_number"]}


def apply_access(df: DataFrame, row_filter: str = "TRUE", excluded_columns: Sequence[str] = ()) -> DataFrame:
    """What a principal may see.  Apply it before any expression of the user's.

    Unknown excluded columns are refused: a misspelt name would expose data.
    """
    unknown = sorted(set(excluded_columns) - set(df.columns))
    if unknown:
        raise ValueError(f"excluded columns not in the table: {unknown}")
    return df.where(F.expr(row_filter)).drop(*excluded_columns)


def access_for(df: DataFrame, role: str) -> DataFrame:
    """``apply_access`` with the filters of a known analyst role."""
    if role not in ROW_FILTERS and role not in EXCLUDED_COLUMNS:
        raise ValueError(f"no data filter for role {role!r}")
    return apply_access(df, ROW_FILTERS.get(role, "TRUE"), EXCLUDED_COLUMNS.get(role, ()))


def mask(df: DataFrame, how: Mapping[str, str]) -> DataFrame:
    """Replace columns by ``"null"``, ``"sha2"`` or ``"redact"`` forms of themselves."""
    unknown = sorted(set(how) - set(df.columns))
    if unknown:
        raise ValueError(f"masked columns not in the table: {unknown}")

    def masked(name: str) -> Column:
        kind = how[name]
        if kind == "null":
            return F.lit(None).cast(df.schema[name].dataType)
        if kind == "sha2":
            return F.sha2(F.col(name).cast("string"), 256)
        if kind == "redact":
            return F.mask(F.col(name).cast("string"))
        raise ValueError(f"unknown mask {kind!r}")

    return df.withColumns({name: masked(name) for name in how})
