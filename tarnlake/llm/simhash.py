"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of
its word shingles.  Two fingerprints link at ``RADIUS`` or fewer differing bits.
Candidates come from 2^(radius+1) - 1 tables.  Table ``v`` keeps the bits ``i``
with an odd inner product of ``v`` and the label of ``i``, a vector of radius+1
bits.  Any ``RADIUS`` labels span less than the whole space, so some nonzero ``v``
is orthogonal to all of them: its table ignores every differing bit, and the pair
shares a bucket there.  No linked pair is missed.

Equal fingerprints are one class before any table is built, so exact copies cost
one row.  Within a bucket only the links that connect its members are produced,
never all pairs.  A bucket with more than ``bucket_rows`` different fingerprints is
not gathered: its members are linked through the fingerprints around them instead
(see ``dense_links``), with work linear in their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.bloom import likely_in
from tarnlake.llm.common import aside, map_batches, whole
from tarnlake.llm.components import connected_components
from tarnlake.session import stage

BITS, RADIUS, SEED, WIDTH = 64, 3, 42, 3
BUCKET_ROWS = 1024


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """Unsigned fingerprint; zero for a text without words."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, n)
        end = np.cumsum(size + 1) - 1
        spans = zip((end - size)[: n - width + 1].tolist(), end[width - 1:].tolist())
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    h = np.array(hashes, np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id`` and signed ``fp`` of every row."""
    def make():
        return lambda ids, texts: {"doc_id": ids, "fp": [signed(fingerprint(t, width)) for t in texts]}

    return map_batches(docs, ["doc_id", "text"], "doc_id long, fp long", make)


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """One mask for each nonzero vector of radius+1 bits; bit i is labelled i mod (2^(radius+1)-1) + 1."""
    top = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(bits) if (i % top + 1 & v).bit_count() % 2) for v in range(1, top + 1)]


def _spanning(nodes: list[int], prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect each connected set of ``nodes`` to its smallest member."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    left, found = set(range(len(nodes))), []
    for root in sorted(left, key=nodes.__getitem__):
        if root not in left:
            continue
        left.discard(root)
        front = [root]
        while front:
            near_front = np.flatnonzero(near[front].any(axis=0)).tolist()
            front = [i for i in near_front if i in left]
            left.difference_update(front)
            found += [(nodes[i], nodes[root]) for i in front]
    return found


def bucket_links(buckets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``src > dst`` links within each bucket of ``nodes``, ``prints`` (arrays of bounded length)."""
    def run(batches):
        for batch in batches:
            out = []
            for nodes, prints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += _spanning(nodes, np.array(prints, np.int64).view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["src", "dst"])

    return buckets.select("nodes", "prints").mapInArrow(run, "src long, dst long")


def dense_links(members: DataFrame) -> DataFrame:
    """Links that connect all members within three bits, without comparing pairs.

    Two fingerprints differ in at most three bits exactly if some value lies within
    one bit of the first and two bits of the second.  Each value takes the smallest
    node within one bit of it as its hub, and every node within two bits links to
    that hub: they are at most three bits apart, and all pairs become connected.
    """
    bit = [signed(1 << i) for i in range(BITS)]
    one = [0, *bit]
    two = one + [signed((1 << i) | (1 << j)) for i in range(BITS) for j in range(i)]

    def around(flips: list[int]) -> DataFrame:
        values = F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: F.col("fp").bitwiseXOR(f))
        return members.select("node", F.explode(values).alias("at"))

    hubs = stage(around(one).groupBy("at").agg(F.min("node").alias("hub")), "simhash-hubs")
    found = around(two).join(hubs, "at").where("node <> hub")
    return found.select(
        F.greatest("node", "hub").alias("src"), F.least("node", "hub").alias("dst")).distinct()


def links(classes: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``src > dst`` links over stored classes ``node, fp`` that connect whatever is within ``radius`` bits."""
    masks = F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for k, m in enumerate(covering_masks(BITS, radius))])
    rows = classes.select("node", "fp", F.explode(masks).alias("b")).select("node", "fp", "b.k", "b.key")
    busy = stage(rows.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-busy")
    members = stage(rows.join(busy, ["k", "key"]), "simhash-members")
    small = members.where(F.col("n") <= bucket_rows).groupBy("k", "key").agg(
        F.collect_list(F.struct("node", "fp")).alias("m"))
    found = bucket_links(
        small.select(F.col("m.node").alias("nodes"), F.col("m.fp").alias("prints")), radius).distinct()
    large = stage(members.where(F.col("n") > bucket_rows).select("node", "fp").distinct(), "simhash-dense")
    if large.isEmpty():
        return found
    if radius != RADIUS:
        raise ValueError(f"buckets of over {bucket_rows} fingerprints are handled at radius {RADIUS} only")
    return found.unionByName(dense_links(large))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, the smallest doc_id reachable over links.

    A NULL or blank text has fingerprint zero and links like any other.  A row with
    a NULL doc_id takes the component of its fingerprint and names none; if only
    such rows have it, component_id is NULL.  Rows that share a doc_id are one
    document.  No rows in, no rows out.
    """
    prints = stage(fingerprints(docs, width), "simhash-prints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-classes")
    named = classes.where("node IS NOT NULL")
    found = links(named, radius, bucket_rows)
    # A document on several rows ties the classes that its texts are in.
    repeated = stage(prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n")).where("n > 1").select("doc_id"), "simhash-repeated")
    if not repeated.isEmpty():
        ties = prints.join(repeated, "doc_id").join(named, "fp").where("doc_id <> node")
        found = found.unionByName(ties.select(F.col("doc_id").alias("src"), F.col("node").alias("dst")))
    roots = connected_components(found)
    fates = stage(
        classes.join(roots, "node", "left").select("fp", F.coalesce("component_id", "node").alias("component_id")),
        "simhash-fates")
    return prints.join(fates, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.

    Of a repeated doc_id one row stays.  Rows without doc_id go if a named document
    is in their component; else one row of each fingerprint stays.
    """
    found = stage(near_duplicates(docs, **options), "simhash-found")
    lost = found.where("doc_id <> component_id").select("doc_id").distinct()
    again = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    unsure = stage(lost.withColumn("n", F.lit(0).cast("long")).unionByName(again), "simhash-unsure")
    rows = aside(docs, "doc_id", "text")
    named = rows.where("doc_id IS NOT NULL")
    # Rows that certainly stay are not shuffled.
    maybe = likely_in(unsure, ["doc_id"])
    ids = unsure.select(F.col("doc_id").alias("__id"), "n")
    same = F.col("doc_id") == F.col("__id")
    kept = named.where(~maybe).unionByName(named.where(maybe).join(ids, same, "left_anti"))
    if not unsure.where("n > 1").isEmpty():
        first = named.where(maybe).join(ids.where("n > 1"), same, "left_semi").dropDuplicates(["doc_id"])
        kept = kept.unionByName(first)
    if not found.where("component_id IS NULL").isEmpty():
        kept = kept.unionByName(_unnamed_first(rows.where("doc_id IS NULL"), found))
    return whole(kept, docs)


def _unnamed_first(unnamed: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each text of the rows without doc_id whose component has no name."""
    alone = found.where("component_id IS NULL").select("fp").distinct()
    prints = map_batches(
        unnamed.select(F.lit(None).cast("long").alias("doc_id"), "text").dropDuplicates(["text"]),
        ["doc_id", "text"], "text string, fp long",
        lambda: lambda ids, texts: {
            "text": [None if t is None else t.decode() for t in texts],
            "fp": [signed(fingerprint(t)) for t in texts]})
    texts = prints.join(alone, "fp").dropDuplicates(["fp"]).select(F.col("text").alias("__text"))
    return unnamed.join(texts, F.col("text").eqNullSafe(F.col("__text")), "left_semi").dropDuplicates(["text"])
