"""Removal of repeated three-line windows, with DataFrame functions only.

Lines are split at ``\\n`` and compared without blanks at their ends; blank lines
are passed over.  Every three consecutive lines of a document make a window.  A
window found again, in any document, is removed there: its first occurrence by
doc_id and position stays, and the lines of overlapping later ones are merged.

Windows are known by two 64-bit hashes.  Their table is stored once and read for
the first occurrences and for the later ones; only texts that may change are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.bloom import likely_in
from tarnlake.llm.common import aside, whole
from tarnlake.session import stage

LINES = 3
KEY = ["doc_id", "text_hash"]


def window_table(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``doc_id, text_hash, pos, h1, h2, at``: each window, its place among its document's
    windows and the raw line numbers it covers."""
    split = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.filter(
            F.transform(F.split("text", "\n"), lambda line, i: F.struct(F.trim(line, F.lit(" \t\r")).alias("l"), i.alias("i"))),
            lambda x: x.l != "").alias("x"))
    hashed = split.where(F.size("x") >= lines).select(
        *KEY, F.transform("x", lambda x: F.struct(
            F.xxhash64(x.l).alias("a"), F.xxhash64(x.l, F.lit(1)).alias("b"), x.i.alias("i"))).alias("x"))

    def window(p):
        own = [F.get("x", p + j) for j in range(lines)]
        return F.struct(
            p.alias("pos"), F.xxhash64(*[o.a for o in own]).alias("h1"), F.xxhash64(*[o.b for o in own]).alias("h2"),
            F.array(*[o.i for o in own]).alias("at"))

    starts = F.sequence(F.lit(0), F.size("x") - lines)
    return hashed.select(*KEY, F.explode(F.transform(starts, window)).alias("w")).select(*KEY, "w.*")


def later_windows(windows: DataFrame) -> DataFrame:
    """Windows of a stored table that occur earlier, in another document or further up."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), *KEY, "pos")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = stage(first.where("n > 1").drop("n"), "window-first")
    found = windows.join(first, ["h1", "h2"])
    return found.where(place > F.col("first")).select(*KEY, "pos", "at")


def _with_gone(docs: DataFrame, lines: int) -> DataFrame:
    """``docs`` with ``__gone``, the raw line numbers to remove, NULL for none."""
    windows = stage(window_table(docs.select("doc_id", "text"), lines), "windows")
    removed = later_windows(windows).groupBy(*KEY).agg(
        F.array_distinct(F.flatten(F.collect_set("at"))).alias("__gone"))
    removed = stage(removed, "windows-removed")
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    key = removed.select(F.col("doc_id"), F.col("text_hash").alias("__hash"))
    maybe = likely_in(key, ["doc_id", "__hash"])
    named = removed.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"), "__gone")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h"))
    # Only texts that may change are shuffled.
    changed = rows.where(maybe).join(named, same, "left").drop("__id", "__h")
    return rows.where(~maybe).withColumn("__gone", F.lit(None).cast("array<int>")).unionByName(changed).drop("__hash")


def _left() -> Column:
    """The text without the lines in ``__gone``."""
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "__gone")
    left = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    return F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left)


def drop_repeated_windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``doc_id, text, n_lines, n_removed``: texts without the lines of repeated windows.

    Kept lines, blank ones among them, stay as they are.  A text of fewer than three
    lines is never changed; NULL stays NULL with no lines.  Rows equal in doc_id and
    text are one document.  A NULL doc_id comes after all others.
    """
    return _with_gone(docs.select("doc_id", "text"), lines).select(
        "doc_id", _left().alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"))


def clean(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` with such texts, ``n_chars`` to match if it is there; rows that lose every line with a word go."""
    own = ["doc_id", "text"] + (["n_chars"] if "n_chars" in docs.columns else [])
    changed = F.col("__gone").isNotNull()
    rows = _with_gone(aside(docs, *own), lines).withColumn("__text", _left())
    rows = rows.where(~changed | F.col("__text").rlike(r"[^ \t\r\n]"))
    new = {"text": F.col("__text")}
    if "n_chars" in own:
        length = F.length("__text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return whole(rows, docs, **new)
