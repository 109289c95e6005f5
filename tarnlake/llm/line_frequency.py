"""Quality rules: counts of a text, and lines that too many documents of a host share.

Lines are normalised and hashed, each different text of a host counts once for each
different line, and lines in more texts of a host than its limit are boilerplate: they are
removed, and a document with too little left is rejected.  The limit is a share of the host's
texts, with a floor for small hosts, so verdicts do not depend on the size of the corpus, and
copies of a text make none of its lines boilerplate.  Texts are read once for
the counts; what is shuffled afterwards is a hash and two numbers a line.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import map_batches
from tarnlake.session import stage

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
# A line is boilerplate in more than this share of a host's different texts, and more than this many of them ...
MAX_PERCENT, MAX_DOCUMENTS = 1, 50
# ... and a document is depleted if it keeps fewer words or a smaller share of them.
KEPT_WORDS, KEPT_PERCENT = 50, 50
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, their first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code, span = ids[:n], len(number)
    for j in range(1, window):
        # Pairs are numbered anew, so that codes stay below the square of the word count.
        code = np.unique(code * span + ids[j:j + n], return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for j in range(window):
        covered[j:j + n] |= again
    return int(covered.sum())


def normalised(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def text_counts(text: bytes | None) -> dict:
    """Counts of one text; ``lines`` holds hash and words of each line with a word."""
    raw = text or b""
    words, shown = raw.split(), raw.decode()
    split = [line for line in raw.split(b"\n") if line.strip()]
    return {
        "n_words": len(words),
        "word_chars": len(shown) - sum(shown.count(c) for c in BLANKS),
        "n_symbols": sum(raw.count(c.encode()) for c in SYMBOLS),
        "n_dup_lines": len(split) - len(set(split)),
        "n_repeat_words": repeat_words(words),
        "lines": [{"h": xxhash.xxh3_64_intdigest(normalised(x)) - (1 << 63), "w": len(x.split())} for x in split],
    }


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def profile(docs: DataFrame, host: Column) -> DataFrame:
    """``doc_id``, the counts and the hashed lines of every row, stored with a row number."""
    def make():
        def work(ids, hosts, hashes, texts):
            found = [text_counts(t) for t in texts]
            return {"doc_id": ids, "host": [None if h is None else h.decode() for h in hosts], "text_hash": hashes,
                    **{k: [f[k] for f in found] for k in text_counts(None)}}
        return work

    rows = docs.select("doc_id", host.cast("string").alias("host"), F.xxhash64("text").alias("text_hash"), "text")
    counts = map_batches(
        rows, ["doc_id", "host", "text_hash", "text"],
        f"doc_id long, host string, text_hash long, {COUNTS}, lines array<struct<h: long, w: int>>", make)
    return stage(counts.withColumn("row", F.monotonically_increasing_id()), "lines-profile")


def boilerplate(profiles: DataFrame, max_documents: int = MAX_DOCUMENTS, max_percent: float = MAX_PERCENT) -> DataFrame:
    """``key`` of each line in more than its host's limit of different texts, with their number."""
    # Copies are one text: reduced in each task before the shuffle.
    texts = stage(profiles.where(F.size("lines") > 0).groupBy("host", "text_hash").agg(F.first(
        F.array_distinct(F.transform("lines", lambda x: x.h))).alias("lines")), "lines-texts")
    hosts = texts.groupBy(F.xxhash64("host").alias("of")).agg(F.count("*").alias("texts"))
    own = texts.select("host", F.explode("lines").alias("h"))
    shared = own.groupBy(F.xxhash64("host").alias("of"), F.xxhash64("host", "h").alias("key")).agg(
        F.count("*").alias("documents")).where(F.col("documents") > max_documents)
    limit = F.col("texts") * F.lit(max_percent)
    return shared.join(hosts, "of").where(100 * F.col("documents") > limit).select("key", "documents")


def line_quality(
    docs: DataFrame, host: Column | str = "source", max_documents: int = MAX_DOCUMENTS,
    kept_words: int = KEPT_WORDS, kept_percent: int = KEPT_PERCENT, max_percent: float = MAX_PERCENT,
) -> DataFrame:
    """One row per document: its counts, ``n_removed_words``, ``removed`` (numbers among
    the lines with a word), ``base_failed`` and ``kept``.

    A NULL or blank text has no words and fails.  Rows with a NULL host are one
    host.  Every row gets its own verdict, but copies of a text count once.
    """
    host = F.col(host) if isinstance(host, str) else host
    found = profile(docs, host)
    common = stage(boilerplate(found, max_documents, max_percent), "lines-common")
    lines = found.select("row", "host", F.posexplode("lines").alias("i", "l")).select(
        "row", "i", F.col("l.w").alias("w"), F.xxhash64("host", "l.h").alias("key"))
    gone = lines.join(common.select("key"), "key").groupBy("row").agg(
        F.sum("w").alias("n_removed_words"), F.sort_array(F.collect_list("i")).alias("removed"))
    gone = stage(gone, "lines-gone")
    rows = found.drop("lines", "host", "text_hash").join(gone, "row", "left").drop("row")
    rows = rows.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_removed_words") > 0) & (
        (left < kept_words) | (100 * left < kept_percent * F.col("n_words")))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def without_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, text`` of the kept documents, their common lines taken out.

    Documents need a ``doc_id`` each: rows without one, or that share one, stay whole.
    """
    verdicts = stage(line_quality(docs, **options), "lines-verdicts")
    once = verdicts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("kept").alias("kept"), F.first("removed").alias("removed"))
    rows = docs.select("doc_id", "text").join(once, "doc_id", "left").where("coalesce(kept, true)")
    split = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    worded = F.transform(F.filter(split, lambda s: s.x.rlike(r"[^\x20\x09-\x0D]")), lambda s: s.i)
    gone = F.transform("removed", lambda i: F.get(worded, i))
    kept = F.array_except(F.transform(split, lambda s: s.i), gone)
    text = F.array_join(F.transform(kept, lambda i: F.get(split, i).x), "\n")
    return rows.select(
        "doc_id", F.when(F.col("removed").isNull() | (F.col("n") > 1), F.col("text")).otherwise(text).alias("text"))
