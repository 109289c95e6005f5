"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

A benchmark item's windows are every ten consecutive words of it; an item of fewer
is one window.  A window is a set of word shingles.  A document that contains it
contains all of them, so one is enough to find it: the rarest, which is the
necessary prefix at a containment of one.  Shingles are ordered by how often the
documents hold them, documents are joined on the prefixes only, and a match fixes
where the window would start in the document.  Places where the window cannot lie
within the document are dropped, at the rest its words are compared.

Windows of equal words are one, whatever items and positions they are from, so a
repetitive text meets each of them once at a place, and every comparison is of one
window's words: the work grows with the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.bloom import likely_in
from tarnlake.llm.common import aside, lower_ascii, sent_whole, whole
from tarnlake.session import stage

WINDOW, SHINGLE = 10, 5
KEY = ["doc_id", "text_hash"]
# Every ASCII character that is not a letter or a digit.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; NULL has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


def shingle_hashes(width: int) -> Column:
    """Hashes of each ``width`` consecutive entries of ``hashes``, the hashes of the words."""
    starts = F.when(F.size("hashes") >= width, F.sequence(F.lit(0), F.size("hashes") - width))
    return F.transform(starts, lambda p: F.xxhash64(F.lit(width), *[F.get("hashes", p + j) for j in range(width)]))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, item_hash, words, length, width`` of items with words; ``length`` is a window's."""
    own = items.select("item_id", F.xxhash64("text").alias("item_hash"), words_of(F.col("text")).alias("words"))
    own = own.where(F.size("words") > 0).dropDuplicates(["item_id", "item_hash"])
    return own.withColumn("length", F.least(F.lit(window), F.size("words"))).withColumn(
        "width", F.least(F.lit(shingle), F.col("length")))


def _shingles(rows: DataFrame, keep: list, widths: list[int]) -> DataFrame:
    """``keep, size, width, at, h``: every shingle of the ``size`` words at its position."""
    rows = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    each = [rows.select(
        *[F.col(c) for c in rows.columns if c != "hashes"], F.size("hashes").alias("size"), F.lit(w).alias("width"),
        F.posexplode(shingle_hashes(w)).alias("at", "h")) for w in widths]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def distinct_windows(own: DataFrame) -> DataFrame:
    """``item_id, wid, text, length, width``: the windows of ``item_windows``, once an item; equal words have one ``wid``."""
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    each = own.select("item_id", "words", "length", "width", starts.alias("of")).select(
        "item_id", F.array_join(F.expr("slice(words, of, length)"), " ").alias("text"), "length", "width")
    return each.withColumn("wid", F.xxhash64("text")).dropDuplicates(["item_id", "text"])


def prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Stored ``text, wid, length, h, at``: the shingle of each window that documents hold least, and its place in it.

    Windows with a shingle that no document holds are left out.
    """
    # At most ``shingle`` different values.
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    texts = windows.select("text", "wid", "length", "width").dropDuplicates(["text"])
    shingled = texts.withColumn("words", F.split("text", " "))
    of_windows = _shingles(shingled, ["text", "wid", "length", F.col("width").alias("own")], widths) if widths else None
    if of_windows is None:
        return texts.select("text", "wid", "length", F.lit(0).cast("long").alias("h"), F.lit(0).alias("at"))
    of_windows = stage(of_windows.where("width = own"), "decon-shingles")
    listed = sent_whole(stage(of_windows.select("h").distinct(), "decon-listed"))
    seen = stage(
        _shingles(words_and_key(docs), [], widths).join(listed, "h").groupBy("h").agg(F.count("*").alias("seen")), "decon-seen")
    ranked = of_windows.join(seen, "h", "left").groupBy("text", "wid", "length").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0).cast("long")).alias("seen"), "h", "at")).alias("best"))
    return stage(ranked.where("best.seen > 0").select("text", "wid", "length", "best.h", "best.at"), "decon-prefix")


def words_and_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))


def candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, length, text``: places where a window's prefix fits and the window lies within the text."""
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    prefix = prefixes(docs, windows)
    if not widths:
        return words_and_key(docs).select("doc_id", "text_hash", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("text")).where("false")
    fits = sent_whole(prefix.withColumnRenamed("at", "of"))
    found = _shingles(words_and_key(docs), KEY, widths).join(fits, "h").withColumn("start", F.col("at") - F.col("of"))
    # Length and position: the window starts and ends within the document.
    return found.where("start >= 0 AND start + length <= size").select(*KEY, "start", "length", "text")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Stored ``__id, __hash, n_hit, n_items, item_ids`` of documents, by doc_id and text hash, that hold a window."""
    items = items.where("item_id IS NOT NULL")
    windows = stage(distinct_windows(item_windows(items, window, shingle)), "decon-windows")
    # Sets: rows equal in doc_id and text give each place once.  A list is no longer than the
    # text times the windows that share a rarest shingle, and holds a window's words an entry.
    places = candidates(docs, windows).groupBy(*KEY).agg(F.collect_set(F.struct("start", "length", "text")).alias("places"))
    places = stage(places, "decon-places")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = places.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "places")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    # Only texts with a place are shuffled, to be compared with the windows.  They are
    # split below the join: above it, Catalyst would split them anew for every word compared.
    near = rows.where(likely_in(places.select(*KEY), KEY)).select(*KEY, words_of(F.col("text")).alias("words"))
    near = near.join(found, same).select(*KEY, "words", "places")
    held = F.filter("places", lambda p: F.array_join(F.slice("words", p.start + 1, p.length), " ") == p.text)
    near = near.select(*KEY, held.alias("held")).where(F.size("held") > 0)
    covered = F.flatten(F.transform("held", lambda p: F.sequence(p.start, p.start + p.length - 1)))
    near = stage(near.select(
        *KEY, F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("held", lambda p: p.text)).alias("texts")).dropDuplicates(KEY), "decon-held")
    # Which items have these windows; an item once a document.
    own = windows.select("text", F.col("item_id").cast("string").alias("item_id")).distinct()
    named = near.select(*KEY, F.explode("texts").alias("text")).join(sent_whole(stage(own, "decon-owners")), "text")
    ids = named.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    ids = ids.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "item_ids")
    out = near.drop("texts").join(ids, same).select(
        "__id", "__hash", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids")
    return stage(out, "decon-hits")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, item_ids``.

    ``n_hit`` counts the words inside any occurrence of a window, ``item_ids`` are the
    items with an occurring window, sorted as strings.  A NULL or blank text has no
    words; items without words, or with a NULL item_id, match nothing.  An item_id
    on several rows is one item with all their windows.  Rows equal in doc_id and
    text get equal results; every row gets one.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    rows = rows.join(hits(docs, items, window, shingle), same, "left")
    none = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    found = hits(docs, items, window, shingle)
    rows = aside(docs, "doc_id", "text").withColumn("__h", F.xxhash64("text"))
    key = found.select(F.col("__id").alias("doc_id"), F.col("__hash").alias("__h"))
    maybe = likely_in(key, ["doc_id", "__h"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash"))
    return whole(rows.where(~maybe).unionByName(rows.where(maybe).join(found, same, "left_anti")), docs)
