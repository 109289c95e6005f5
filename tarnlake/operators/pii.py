"""PII detection by column name and by column content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import BLANKS, header_key, unquote

DIRECT = "direct"

# Substrings of a normalised column name that mark it direct PII.
NAME_MARKERS = {
    "ssn": ["ssn", "socialsecurity"],
    "email": ["email"],
    "phone": ["phone", "telephone"],
    "credit_card": ["creditcard", "ccnum"],
}

# Patterns a whole cell must match.
CONTENT_PATTERNS = {
    "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "email": r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$",
    "phone": r"^\+?1?\s*[-.]?\(?\d{3}\)?[-.]?\s*\d{3}[-.]?\s*\d{4}$",
    "credit_card": r"^\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}$",
}

# What any match has in common, tested before the regular expression runs.
# Upper bounds allow for the trailing newline that ``$`` accepts.
_NECESSARY = {
    "ssn": lambda v: F.length(v).between(11, 12),
    "email": lambda v: v.contains("@"),
    "phone": lambda v: F.length(v) >= 10,
    "credit_card": lambda v: F.length(v).between(16, 20),
}


def name_kind(name: Column) -> Column:
    """Kind of PII a column name suggests, or NULL; the first marker wins."""
    key = header_key(name)
    kind = F.lit(None).cast("string")
    for label, words in reversed(NAME_MARKERS.items()):
        hit = key.contains(words[0])
        for word in words[1:]:
            hit = hit | key.contains(word)
        kind = F.when(hit, F.lit(label)).otherwise(kind)
    return kind


def content_hit(value: Column, kind: str) -> Column:
    """Whether a cleaned cell matches a pattern; digits and spaces are Unicode-aware."""
    return _NECESSARY[kind](value) & value.rlike("(?dU)" + CONTENT_PATTERNS[kind])


def pii_by_name(columns: DataFrame, column: str = "column") -> DataFrame:
    """Rows of a column listing whose name suggests PII, with ``kind`` and ``pii``.

    One narrow pass, so it covers the catalogue of every table at once.
    """
    return (
        columns.withColumn("kind", name_kind(F.col(column)))
        .where("kind IS NOT NULL").withColumn("pii", F.lit(DIRECT))
    )


def _profile(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column with hits per pattern, in one pass over ``cells``.

    Column i of ``cells`` is ``c{i}``.  Every task reduces its rows to one row of
    counters before anything is shuffled, whatever the size of the table.
    """
    counters = []
    for i in range(len(names)):
        value = F.col(f"c{i}")
        counters.append(F.count(value).alias(f"n{i}"))
        counters += [F.count_if(content_hit(value, kind)).alias(f"{kind}{i}") for kind in CONTENT_PATTERNS]
    rows = [
        F.struct(
            F.lit(name).alias("column"), F.col(f"n{i}").alias("cells"),
            *[F.col(f"{kind}{i}").alias(f"{kind}_hits") for kind in CONTENT_PATTERNS])
        for i, name in enumerate(names)
    ]
    return cells.agg(*counters).select(F.inline(F.array(*rows)))


def _with_patterns(profile: DataFrame) -> DataFrame:
    hits = [F.when(F.col(f"{kind}_hits") > 0, F.lit(kind)) for kind in CONTENT_PATTERNS]
    return profile.withColumn("patterns", F.concat_ws(",", *hits))


def content_profile(df: DataFrame) -> DataFrame:
    """Pattern hits of every column; scans all rows, reports counts, never values."""
    if not df.columns:
        raise ValueError("a table without columns has no content to profile")
    cells = df.select([unquote(F.col(f"`{c}`").cast("string")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return _with_patterns(_profile(cells, df.columns))


def pii_by_content(df: DataFrame, min_rate: float = 0.0) -> DataFrame:
    """Columns in which a cell matches a pattern.

    One hit is enough by default; ``min_rate`` asks for a share of non-NULL cells.
    """
    profile = content_profile(df)
    best = F.greatest(*[F.col(f"{kind}_hits") for kind in CONTENT_PATTERNS])
    rate = best / F.when(F.col("cells") > 0, F.col("cells"))
    return profile.where((best > 0) & (rate >= F.lit(min_rate))).withColumn("pii", F.lit(DIRECT))


def detect_pii(df: DataFrame) -> DataFrame:
    """Columns of ``df`` holding PII: ``column, pii, source, patterns``.

    A column flagged by its name is reported as such; content adds the others.
    """
    kind = name_kind(F.col("column"))
    source = F.when(kind.isNotNull(), F.lit("name")).when(F.col("patterns") != "", F.lit("content"))
    return (
        content_profile(df).withColumn("source", source).where("source IS NOT NULL")
        .select("column", F.lit(DIRECT).alias("pii"), "source", "patterns")
    )


def detect_pii_in_lines(lines: DataFrame, headers: Sequence[str], column: str = "value") -> DataFrame:
    """``detect_pii`` over raw comma-separated lines.

    Lines are split at every comma; a line whose cell count differs from the
    header is skipped.
    """
    parts = F.split(F.col(column), ",", -1)
    cells = lines.select(parts.alias("p")).where(F.size("p") == len(headers)).select(
        [unquote(F.get("p", F.lit(i))).alias(f"c{i}") for i in range(len(headers))])
    profile = _with_patterns(_profile(cells, headers))
    kind = name_kind(F.col("column"))
    source = F.when(kind.isNotNull(), F.lit("name")).when(F.col("patterns") != "", F.lit("content"))
    return (
        profile.withColumn("source", source).where("source IS NOT NULL")
        .select("column", F.lit(DIRECT).alias("pii"), "source", "patterns")
    )


def pii_in_text(df: DataFrame, text: str, by: Sequence[str]) -> DataFrame:
    """Pattern hits among the whitespace-separated tokens of whole texts, per ``by``.

    Counters are reduced in each task before the shuffle, so a group that holds
    most of the texts costs the shuffle one row per task.
    """
    tokens = df.select(*by, F.explode_outer(F.split(F.col(text), BLANKS)).alias("__t"))
    values = tokens.select(*by, F.btrim(F.btrim("__t", F.lit('"')), F.lit("'")).alias("__v"))
    return values.groupBy(*by).agg(
        *[F.count_if(content_hit(F.col("__v"), kind)).alias(f"{kind}_hits") for kind in CONTENT_PATTERNS])


def pii_tags(detected: DataFrame, database: str, table: str) -> DataFrame:
    """Detections as tag rows ``database, table, column, tag, value``."""
    return detected.select(
        F.lit(database).alias("database"), F.lit(table).alias("table"), "column",
        F.lit("PII").alias("tag"), F.col("pii").alias("value"))
