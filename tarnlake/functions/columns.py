"""Column expressions shared by the operators.  All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.strip and str.split take for whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a regular expression.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def to_double(c: Column) -> Column:
    """Cast to double; a malformed value gives NULL."""
    return c.try_cast("double")


def to_time(c: Column) -> Column:
    """Parse an ISO timestamp string; a malformed value gives NULL."""
    return F.try_to_timestamp(c)


def sha256_hex(c: Column, salt: str = "") -> Column:
    """SHA-256 as lower-case hex; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt), c) if salt else c, 256)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def normal_text(c: Column) -> Column:
    """Surrounding whitespace removed, lower case."""
    return F.lower(strip(c))


def unquote(c: Column) -> Column:
    """Surrounding whitespace, then double quotes, then single quotes removed."""
    return F.btrim(F.btrim(strip(c), F.lit('"')), F.lit("'"))


def header_key(c: Column) -> Column:
    """Column name in the form the name rules compare: lower case, no ``_`` or ``-``."""
    return F.regexp_replace(F.lower(c), "[_-]", "")


def json_number(c: Column, path: str) -> Column:
    """Number at a JSON path; NULL when absent or not a number."""
    return F.get_json_object(c, path).try_cast("double")


def iso_day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def location_parts(c: Column) -> Column:
    """Storage location as struct(bucket, prefix, table); table is the last folder."""
    bare = F.replace(c, F.lit("s3://"), F.lit(""))
    prefix = F.when(F.instr(bare, "/") > 0, F.regexp_replace(bare, "^[^/]*/", "")).otherwise("")
    return F.struct(
        F.substring_index(bare, "/", 1).alias("bucket"),
        prefix.alias("prefix"),
        F.substring_index(F.btrim(prefix, F.lit("/")), "/", -1).alias("table"),
    )


def normalize_columns(df: DataFrame, snake: bool = False) -> DataFrame:
    """Column names lower-cased and stripped; ``snake`` also joins words with ``_``."""
    names = [name.lower().strip() for name in df.columns]
    if snake:
        names = ["_".join(name.replace("-", " ").split()) for name in names]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"column names collide after normalising: {repeated}")
    return df.toDF(*names)


def with_missing(df: DataFrame, schema) -> DataFrame:
    """``df`` in the order and types of ``schema``; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
