"""Texts that share most of their word shingles: a rare-first prefix-filtered Jaccard join.

A text is the set of its distinct shingles of ``width`` words; two texts link if
``100 * common >= percent * union``.  Shingles are ordered by the number of texts that
hold them, rarest first.  Of a set of n, the first ``n - ceil(percent * n / 100) + 1``
are its prefix, and two sets that link share a shingle of their prefixes.  Shingles of
a single text lie first and match nothing, so most sets have no prefix left to join.

The first shingle that two sets share, at the positions i and j, bounds how far they
differ: i + j shingles before it, and the suffixes after it by at least the bits in
which 256-bit parities of the suffixes differ.  Pairs pass the length, positional and
suffix filter within the join and are then verified once, by intersection.

Counts of texts are kept by the lower 48 bits of a shingle's hash, so a shingle may seem
to be in several texts that is in one; it then lies later in the order, where it matches
nothing, and no result changes.  A filter of bounded size tells which shingles may be in
several texts.  A text in which so many are in no other that its prefix holds only these
links with nothing, and its shingles are never shuffled to be looked up.  The filter
passes more of them once a corpus has far more than ``FILTER_WORDS`` repeated shingles.

Texts with equal sets are one class before anything is joined.  Within a bucket, the
classes that share a prefix shingle, only classes that are not yet connected are
compared: first all with the class whose shingle comes earliest, then with a growing
sample of those outside that class's component, in the last round with all of them.
So no pair of two components is left out, and a group of copies needs no more than a
few comparisons a member.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.bloom import likely_in
from tarnlake.llm.common import map_batches
from tarnlake.llm.components import connected_components
from tarnlake.session import data_bytes, stage

WIDTH, PERCENT = 4, 85
# Expected number of compared classes of a bucket grows by this factor a round.
GROWTH = 64
PARITY_WORDS = 4
# Bytes of text hashed at once.
SEGMENT = 1 << 19
# Ids of copies that are broadcast.
COPIES_BYTES = 16 << 20
# Bits of a hash by which texts are counted, hashes a task sums at once, and those a task reduces.
COUNTED, FLUSH, BUCKET = 48, 2_000_000, 2_000_000
# 64-bit words of the filter at most (32 MB in every worker), and of a block of it; bits for each key.
FILTER_WORDS, FILTER_BLOCK, FILTER_BITS = 1 << 22, 1 << 12, 10

_random = np.random.default_rng(42)
_BYTES = _random.integers(0, 1 << 64, 256, np.uint64)
_BYTES[[9, 10, 11, 12, 13, 32]] = 0
_BASE = np.uint64(int(_random.integers(0, 1 << 61)) * 8 + 5)
_FACTORS = _random.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Shingles:
    """Hashes of the distinct shingles of texts, ascending.

    Words are hashed side by side: with T a random number for each byte, zero for blanks,
    and B odd, the hash of a word is the difference of running sums of T * B^position at its
    ends, by the inverse of B^start.  A shingle's is the sum of its words' with a random factor
    for each place.
    """

    def __init__(self, width: int):
        self.width, self.powers, self.inverses = width, np.ones(0, np.uint64), np.ones(0, np.uint64)

    def _tables(self, size: int) -> None:
        if size > len(self.powers):
            for name, base in (("powers", _BASE), ("inverses", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word starts, and its hash."""
        at = np.frombuffer(text, np.uint8)
        blank = np.concatenate([[True], _BLANK[at], [True]])
        starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        self._tables(len(at))
        sums = np.zeros(len(at) + 1, np.uint64)
        np.cumsum(_BYTES[at] * self.powers[:len(at)], out=sums[1:])
        return starts, _mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def _batches(self, texts: list[bytes]) -> Iterator[list[bytes]]:
        """Texts of ``SEGMENT`` bytes together; a longer one is alone."""
        batch, size = [], 0
        for text in texts:
            if batch and size + len(text) > SEGMENT:
                yield batch
                batch, size = [], 0
            batch.append(text)
            size += len(text)
        if batch:
            yield batch

    def _long(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a text of any length, cut at blanks."""
        out, at = [], 0
        while at < len(text):
            blank = re.compile(rb"[\x09-\x0D ]").search(text, at + SEGMENT)
            end = blank.start() if blank else len(text)
            out.append(self.words(text[at:end])[1])
            at = end
        return np.concatenate(out)

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """One array a text; many are hashed at once."""
        out = []
        for batch in self._batches([(t or b"").lower() for t in texts]):  # bytes: only A-Z change
            if len(batch) == 1 and len(batch[0]) > SEGMENT:
                words = self._long(batch[0])
                counts = [len(words)]
            else:
                starts, words = self.words(b"\n".join(batch))
                ends = np.cumsum([len(t) + 1 for t in batch])
                counts = np.diff(np.searchsorted(starts, ends), prepend=0)
            sums = np.zeros(max(0, len(words) - self.width + 1), np.uint64)
            for k in range(self.width):
                sums += words[k:len(sums) + k] * _FACTORS[k]
            sums, at = _mixed(sums), 0
            for n in counts:
                if n >= self.width:
                    own = np.sort(sums[at:at + n - self.width + 1])
                    out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
                elif n:  # the whole sequence, by factors of its length
                    out.append(_mixed((words[at:at + n] * _FACTORS[8 * n:9 * n]).sum(keepdims=True)))
                else:
                    out.append(np.zeros(0, np.uint64))
                at += n
        return out


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def prints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, text_hash, key, n`` of every row: a 128-bit key of its set (NULL if empty) and the set's size."""
    def make():
        shingles = Shingles(width)

        def work(ids, hashes, texts):
            sets = shingles(texts)
            return {"doc_id": ids, "text_hash": hashes, "n": [len(s) for s in sets],
                    "key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]}
        return work

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_batches(rows, ["doc_id", "text_hash", "text"],
                       f"doc_id {_id_type(docs)}, text_hash long, key binary, n long", make)


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text`` of one row of each class of ``found``; rows equal in both stay together.

    The copies to leave out are broadcast if they are measured to be few; else only rows
    that a Bloom filter takes for copies are shuffled.
    """
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = found.where("key IS NOT NULL").groupBy("key").agg(
        F.min(own).alias("best"), F.count("*").alias("copies")).where("copies > 1").select("key", "best")
    best = stage(best, "jaccard-best")
    copies = found.select("key", own.alias("own")).join(best, "key").where("own <> best").select(
        F.col("own.doc_id").alias("__id"), F.col("own.text_hash").alias("__hash")).distinct()
    copies = stage(copies, "jaccard-copies")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = (F.col("text_hash") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    if data_bytes(copies) <= COPIES_BYTES:
        return rows.join(F.broadcast(copies), same, "left_anti").select("doc_id", "text")
    maybe = likely_in(copies.select(F.col("__id").alias("doc_id"), F.col("__hash").alias("text_hash")), ["doc_id", "text_hash"])
    return rows.where(~maybe).unionByName(rows.where(maybe).join(copies, same, "left_anti")).select("doc_id", "text")


def prefix_size(percent: int) -> Column:
    """Of a set of ``n`` shingles."""
    return F.expr(f"n - (n * {percent} + 99) div 100 + 1")


def _counted(h: np.ndarray) -> np.ndarray:
    return h & np.uint64((1 << COUNTED) - 1)


class CountTexts:
    """Sorted hashes of a task's texts with their counts, as bytes by bucket, whenever many are held.

    Hashes of one text and those of several come apart, the former without counts.
    """

    def __init__(self, width: int, buckets: int):
        self.shingles, self.held, self.n = Shingles(width), [], 0
        self.edges = np.array([((k << COUNTED) + buckets - 1) // buckets for k in range(buckets + 1)], np.uint64)

    def __call__(self, texts):
        own = self.shingles(texts)
        self.held += own
        self.n += sum(map(len, own))
        return self.finish() if self.n > FLUSH else {"bucket": [], "hashes": [], "counts": []}

    def finish(self):
        h, n = np.unique(_counted(np.concatenate(self.held or [np.zeros(0, np.uint64)])), return_counts=True)
        self.held, self.n = [], 0
        out = {"bucket": [], "hashes": [], "counts": []}
        for keys, counts in ((h[n == 1], None), (h[n > 1], n[n > 1].astype(np.uint32))):
            cuts = np.searchsorted(keys, self.edges)
            for k in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[k], cuts[k + 1])
                out["bucket"].append(int(k))
                # Six of the eight bytes: the upper two are zero.
                out["hashes"].append(keys[part].view(np.uint8).reshape(-1, 8)[:, :COUNTED // 8].tobytes())
                out["counts"].append(b"" if counts is None else counts[part].tobytes())
        return out


def _unpacked(hashes: bytes) -> np.ndarray:
    out = np.zeros((len(hashes) * 8 // COUNTED, 8), np.uint8)
    out[:, :COUNTED // 8] = np.frombuffer(hashes, np.uint8).reshape(-1, COUNTED // 8)
    return out.view(np.uint64).ravel()


def repeated(docs: DataFrame, width: int, total: int) -> DataFrame:
    """Stored ``g, texts`` of shingles in several texts; ``total`` shingles set the number of buckets.

    A hash comes to its bucket once for each ``FLUSH`` hashes of a task, however many texts hold it.
    """
    buckets = max(16, -(-total // BUCKET))

    def reduce(rows: pa.Table) -> pa.Table:
        parts = [(_unpacked(h), np.frombuffer(c, np.uint32) if c else None) for h, c in zip(
            rows["hashes"].to_pylist(), rows["counts"].to_pylist())]
        h = np.concatenate([p for p, _ in parts])
        n = np.concatenate([np.ones(len(p), np.int64) if c is None else c.astype(np.int64) for p, c in parts])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        texts, keys = np.add.reduceat(n, first), h[first]
        return pa.table({"g": keys[texts > 1].view(np.int64), "texts": texts[texts > 1]})

    counts = map_batches(docs, ["text"], "bucket int, hashes binary, counts binary", lambda: CountTexts(width, buckets))
    return stage(counts.groupBy("bucket").applyInArrow(reduce, "g long, texts long"), "jaccard-repeated")


def _bits(g: np.ndarray) -> np.ndarray:
    """Four bits of a 64-bit word for each hash, by bits of it that do not choose the word."""
    out = np.zeros(len(g), np.uint64)
    for shift in (24, 30, 36, 42):
        out |= np.uint64(1) << ((g >> np.uint64(shift)) & np.uint64(63))
    return out


def filter_words(several: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes ``g``: every one has its four bits in the word that its lower bits choose."""
    size = FILTER_BLOCK
    keys = several.count()
    while size < FILTER_WORDS and size * 64 < FILTER_BITS * keys:
        size *= 2

    def build(rows: pa.Table) -> pa.Table:
        g = rows["g"].to_numpy().view(np.uint64)
        words = np.zeros(FILTER_BLOCK, np.uint64)
        np.bitwise_or.at(words, (g & np.uint64(FILTER_BLOCK - 1)).astype(np.int64), _bits(g))
        return pa.table({"block": pa.array([rows["block"][0].as_py()], pa.int64()), "words": pa.array([words.tobytes()], pa.binary())})

    blocks = several.select(F.shiftright("g", 12).bitwiseAND(F.lit(size // FILTER_BLOCK - 1).cast("long")).alias("block"), "g")
    words = np.zeros(size, np.uint64)
    # FILTER_WORDS words at most, whatever the corpus.
    for row in stage(blocks.groupBy("block").applyInArrow(build, "block long, words binary"), "jaccard-filter").toLocalIterator():
        words[row["block"] * FILTER_BLOCK:(row["block"] + 1) * FILTER_BLOCK] = np.frombuffer(row["words"], np.uint64)
    return words


def profiles(docs: DataFrame, total: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Stored ``key, n, shared`` of classes that may link: shingles of several texts, rarest first.

    ``docs`` has one row of each class, ``total`` shingles in all.  The other
    ``n - size(shared)`` shingles are in no other text: they come first in the order and
    in no intersection.
    """
    several = repeated(docs, width, total)
    words = docs.sparkSession.sparkContext.broadcast(filter_words(several))

    def make():
        shingles, filled = Shingles(width), words.value

        def work(texts):
            out = {"key": [], "n": [], "hashes": []}
            for own in shingles(texts):
                g, n = _counted(own), len(own)
                bits = _bits(g)
                maybe = own[filled[(g & np.uint64(len(filled) - 1)).astype(np.int64)] & bits == bits]
                if n and n - len(maybe) < n - -(-percent * n // 100) + 1:
                    out["key"].append(xxhash.xxh3_128_digest(own.tobytes()))
                    out["n"].append(n)
                    out["hashes"].append(maybe.view(np.int64))
            return out
        return work

    rows = map_batches(docs, ["text"], "key binary, n long, hashes array<long>", make)
    rows = rows.select("key", "n", F.explode("hashes").alias("h")).withColumn(
        "g", F.col("h").bitwiseAND(F.lit((1 << COUNTED) - 1)))
    rows = rows.join(several, "g").groupBy("key").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_set(F.struct("texts", "h"))).alias("s"))
    rows = rows.select("key", "n", F.col("s.h").alias("shared"))
    return stage(rows.where(F.col("n") - F.size("shared") < prefix_size(percent)), "jaccard-profiles")


def postings(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``h, key, n, at, s0..s3``: each prefix shingle that other texts hold, its position, the parity of what follows."""
    cols = [f"s{k}" for k in range(PARITY_WORDS)]

    def make():
        def work(keys, sizes, lists):
            out = {c: [] for c in ["h", "key", "n", "at", *cols]}
            for key, n, shared in zip(keys, sizes, lists):
                h = np.array(shared, np.int64)
                own = n - len(h)
                k = min(len(h), n - -(-percent * n // 100) + 1 - own)
                cell = h.view(np.uint64) >> np.uint64(56)
                bits = np.zeros((len(h) + 1, PARITY_WORDS), np.uint64)
                bits[np.arange(len(h)), cell >> np.uint64(6)] = np.uint64(1) << (cell & np.uint64(63))
                after = np.bitwise_xor.accumulate(bits[::-1])[::-1][1:].view(np.int64)
                out["h"] += h[:k].tolist()
                out["at"] += range(own, own + k)
                out["key"] += [key] * k
                out["n"] += [n] * k
                for c, values in zip(cols, after[:k].T):
                    out[c] += values.tolist()
            return out
        return work

    ddl = "h long, key binary, n long, at long, " + ", ".join(f"{c} long" for c in cols)
    return map_batches(found, ["key", "n", "shared"], ddl, make)


def _needed(percent: int) -> str:
    """Common shingles that sets of ``n`` and ``m`` need, rounded up."""
    return f"((n + m) * {percent} + {99 + percent}) div {100 + percent}"


def may_link(percent: int) -> Column:
    """The filters on a pair that shares a prefix shingle: sizes ``n, m``, positions ``at, dst_at``, parities."""
    apart = " + ".join(f"bit_count(s{k} ^ dst_s{k})" for k in range(PARITY_WORDS))
    need = _needed(percent)
    return F.expr(
        f"100 * least(n, m) >= {percent} * greatest(n, m) AND least(n - at, m - dst_at) >= {need} "
        f"AND at + dst_at + {apart} <= n + m - 2 * ({need})")


def verified(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The ``src, dst`` pairs whose sets link."""
    a = found.select(F.col("key").alias("src"), "n", F.col("shared").alias("a"))
    b = found.select(F.col("key").alias("dst"), F.col("n").alias("m"), F.col("shared").alias("b"))
    both = pairs.join(a, "src").join(b, "dst")
    return both.where(F.size(F.array_intersect("a", "b")) >= F.expr(_needed(percent))).select("src", "dst")


def _candidates(members: DataFrame, hubs: DataFrame, percent: int, tried: DataFrame | None = None) -> DataFrame:
    """Stored pairs of a bucket's ``members`` with its ``hubs`` in other components that pass the filters.

    Pairs that share several prefix shingles come once, pairs that were ``tried`` not again.
    """
    other = hubs.select("h", *[F.col(c).alias(d) for c, d in [
        ("key", "dst"), ("n", "m"), ("at", "dst_at"), ("part", "dst_part"), *[(f"s{k}", f"dst_s{k}") for k in range(PARITY_WORDS)]]])
    pairs = members.join(other, "h").where((F.col("part") != F.col("dst_part")) & may_link(percent))
    pairs = pairs.select(F.least("key", "dst").alias("src"), F.greatest("key", "dst").alias("dst")).distinct()
    return stage(pairs if tried is None else pairs.join(tried, ["src", "dst"], "left_anti"), "jaccard-pairs")


def connect(
    found: DataFrame, percent: int = PERCENT, growth: int = GROWTH, likely: DataFrame | None = None,
) -> DataFrame:
    """``node, component_id`` of the classes of ``profiles`` that link with another; keys name the components.

    ``likely``: ``src, dst`` pairs that are verified first, so that what they connect is not compared again.
    """
    rows = stage(postings(found, percent), "jaccard-postings")
    busy = stage(rows.groupBy("h").agg(F.count("*").alias("members")).where("members > 1").select("h"), "jaccard-busy")
    members, known = rows.join(busy, "h").withColumn("part", F.col("key")), None
    if likely is not None:
        known = stage(verified(likely, found, percent), "jaccard-known")
        begun = stage(connected_components(known), "jaccard-begun")
        members = members.drop("part").join(begun.withColumnRenamed("node", "key"), "key", "left").select(
            *rows.columns, F.coalesce("component_id", "key").alias("part"))
    members = stage(members, "jaccard-members")
    first = members.groupBy("h").agg(F.min(F.struct("at", "n", "key")).alias("f")).select("h", F.col("f.key").alias("first"))
    first = stage(first, "jaccard-first")
    hubs = members.join(first, "h").where(F.col("key") == F.col("first"))
    tried = _candidates(members, hubs, percent)
    links = verified(tried, found, percent)
    links = stage(links if known is None else links.unionByName(known), "jaccard-links")
    roots = stage(connected_components(links), "jaccard-roots")
    growth = sample = max(2, growth)
    while True:
        parts = members.drop("part").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
            *rows.columns, F.coalesce("component_id", "key").alias("part"))
        # The component of a bucket's first class; what is outside it must still meet all the rest.
        main = parts.join(first, "h").where(F.col("key") == F.col("first")).select("h", F.col("part").alias("main"))
        parts = stage(parts.join(stage(main, "jaccard-main"), "h"), "jaccard-parts")
        outside = parts.where("part <> main").groupBy("h").agg(F.count("*").alias("outside"))
        outside = stage(outside, "jaccard-outside")
        largest = outside.agg(F.max("outside")).first()[0]
        if largest is None:
            return roots
        members = stage(parts.join(outside, "h"), "jaccard-split")
        share = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) * F.col("outside") < F.lit(sample << 20)
        pairs = _candidates(members, members.where((F.col("part") != F.col("main")) & share), percent, tried)
        new = stage(verified(pairs, found, percent), "jaccard-new")
        if not new.isEmpty():
            links = stage(links.unionByName(new), "jaccard-links")
            roots = stage(connected_components(links), "jaccard-roots")
        if sample >= largest:
            return roots
        members, tried, sample = members.select(*rows.columns, "part"), tried.unionByName(pairs), sample * growth


def similar(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, growth: int = GROWTH,
    likely: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Stored ``doc_id, text_hash, key, n, part`` of every row; rows of one component have one ``part``.

    ``part`` is the key of a set of the component; a text without words has neither.
    ``likely`` gives pairs of keys that another method links, of one row of each class
    and the ``text_hash, key`` of all; they are verified first.
    """
    found = stage(prints(docs, width), "jaccard-prints")
    total = found.agg(F.sum("n")).first()[0] or 0
    each = one_of_each(docs, found)
    roots = connect(profiles(each, total, width, percent), percent, growth, likely(each, found) if likely else None)
    parts = found.join(roots.withColumnRenamed("node", "key"), "key", "left")
    return stage(parts.select("doc_id", "text_hash", "key", "n", F.coalesce("component_id", "key").alias("part")), "jaccard-similar")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, growth: int = GROWTH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, the smallest doc_id reachable over links.

    A text of fewer than ``width`` words is one shingle.  A NULL or blank text has none
    and links with nothing, not even another such: its component is its own doc_id.
    Rows are known by their text, so a repeated doc_id ties nothing; a row with a NULL
    doc_id takes its component's smallest and names none.  No rows in, no rows out.
    """
    found = similar(docs, width, percent, growth)
    ids = stage(found.where("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("smallest")), "jaccard-ids")
    named = found.where("part IS NOT NULL").join(ids, "part").withColumnRenamed("smallest", "component_id")
    alone = found.where("part IS NULL").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return named.select(*cols).unionByName(alone.select(*cols))
