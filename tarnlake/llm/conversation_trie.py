"""A prefix trie of conversations, with figures of every node and its subtree.

A conversation's path is the sequence of its turns' digests.  Paths, and ids among
equal paths, are ordered; splitters cut the order into shards.  All members of a node
are neighbours in the order, so a node whose members lie on both sides of a splitter
is a prefix of that splitter's path.  The trie of the splitters' paths, the skeleton,
is broadcast; it is as large as the splitters, whatever the number of conversations.

Every shard is sorted and read once with a stack of the current path: nodes outside the
skeleton are finished where they stand, and each skeleton node gets one partial row a
shard.  Partial rows are summed by node, and sums over subtrees follow the skeleton.
Members that end in a skeleton node, perhaps a third of all, are passed on as chunks of
their joined ids and hashed in the order of the shards, never held together.

Memory is bounded by the longest conversation: 24 bytes a turn in one row.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarnlake.session import stage

# Conversations a shard has on average, and the limits of the number of shards.
SHARD_ROWS, LEAST_SHARDS, MOST_SHARDS = 100_000, 16, 4096
# Conversations sampled for each splitter; bytes of splitter paths that every task may be sent.
OVERSAMPLE, SPLITTER_BYTES = 20, 16 << 20
# A splitter's path is cut at this many turns: it then splits no node below.
SPLITTER_TURNS = 1024
DIGEST = 16
# Rows a task gives out at once, and characters of a chunk of ids.
FLUSH_ROWS, CHUNK = 8192, 1 << 16
# Turns of another conversation that a conversation starts with are fewer than this.
SHARED_TURNS, FAMILY = 6, 100

# kind 0: a finished node; 1: a skeleton node's part in a shard; 2: a chunk of the ids that end in one.
SHARD_DDL = (
    "kind int, conv_id long, depth long, parent long, parent_node int, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, node int, length long, shard int, seq int")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: (digest, length in code points) of each turn in order.

    Turns are ordered by number, NULL first, equal numbers by role and then by a digest
    of role and text.  A NULL role or text is empty.  Rows without conv_id belong to no
    conversation.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), digest.alias("digest"), F.char_length(text).alias("length")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return turns.select("conv_id", F.transform("t", lambda t: F.struct(t.digest, t.length)).alias("turns"))


def rebuilt(conversations: DataFrame, shared: int = SHARED_TURNS, family: int = FAMILY) -> DataFrame:
    """``conv_id, turns`` where a conversation's first turns are those of the first one of its family.

    Conversation c takes ``h = crc32(c) % shared`` turns, or all there are, of
    conversation ``c - c % family``, none if that is absent, and goes on with its own
    turns after its first h.
    """
    own = stage(turns_of(conversations), "trie-turns")
    first = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, shared - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("int")
    rows = own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % family).alias("first"), h.alias("h"))
    none = F.expr("slice(turns, 1, 0)")
    return rows.join(first, "first", "left").select("conv_id", F.concat(
        F.coalesce(F.expr("slice(head, 1, h)"), none), F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


class Skeleton:
    """The trie of splitter paths, nodes numbered in preorder, 0 the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(set(splitters))
        self.children: list[dict[bytes, int]] = [{}]
        self.parent, self.depth = [-1], [0]
        for path, _ in self.splitters:  # sorted: a new node follows all nodes before it in preorder
            node = 0
            for at in range(0, len(path), DIGEST):
                step = path[at:at + DIGEST]
                if step not in self.children[node]:
                    self.children[node][step] = len(self.parent)
                    self.children.append({})
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][step]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def choose_splitters(paths: DataFrame, shards: int | None = None) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` of the paths, evenly spaced in a sample by a hash of the id."""
    if shards is None:
        shards = min(MOST_SHARDS, max(LEAST_SHARDS, math.ceil(paths.count() / SHARD_ROWS)))
    sample = paths.select(F.substring("path", 1, DIGEST * SPLITTER_TURNS).alias("path"), "conv_id").orderBy(
        F.xxhash64("conv_id"), "conv_id").limit(OVERSAMPLE * shards)
    # Numbered by rank, so that only the chosen rows reach the driver.
    stored = stage(sample, "trie-sample")
    size = stored.agg(F.count("*").alias("n"), F.sum(F.octet_length("path")).alias("bytes")).first()
    n = size["n"]
    if not n:
        return []
    shards = max(1, min(shards, n, int(SPLITTER_BYTES * n / max(1, size["bytes"]))))
    ranked = stored.withColumn("r", F.row_number().over(Window.orderBy("path", "conv_id")) - 1)
    step = F.floor(F.col("r") * shards / n) > F.floor((F.col("r") - 1) * shards / n)
    return [(bytes(r["path"]), r["conv_id"]) for r in ranked.where((F.col("r") > 0) & step).collect()]


class Node:
    """A node on the current path: what is known of it and of its subtree outside the skeleton."""

    __slots__ = ("conv_id", "length", "node", "n_convs", "n_children", "n_leaves", "saved", "ends", "n_ends", "held", "seq", "below")

    def __init__(self, conv_id: int, length: int, node: int | None):
        self.conv_id, self.length, self.node = conv_id, length, node
        self.n_convs = self.n_children = self.n_leaves = self.saved = self.n_ends = self.held = self.seq = 0
        self.ends = hashlib.sha256() if node is None else []
        # Finished children that wait for this node's smallest member.
        self.below: list[list] = []


class Shard:
    """The rows of one sorted shard, ``add`` by ``add``; ``rows`` may be taken out at any time."""

    def __init__(self, skeleton: Skeleton, number: int):
        self.skeleton, self.number, self.rows = skeleton, number, []
        self.stack: list[Node] = []
        self.path: list[bytes] = []

    def add(self, conv_id: int, path: bytes, lengths: list[int]) -> None:
        steps = [path[at:at + DIGEST] for at in range(0, len(path), DIGEST)]
        same = 0
        for a, b in zip(self.path, steps):
            if a != b:
                break
            same += 1
        self.pop(same)
        if not self.stack:
            self.stack.append(Node(conv_id, 0, 0))
        for depth in range(same, len(steps)):
            above = self.stack[-1].node
            node = None if above is None else self.skeleton.children[above].get(steps[depth])
            self.stack.append(Node(conv_id, lengths[depth], node))
        for node in self.stack:
            node.n_convs += 1
            if conv_id < node.conv_id:
                node.conv_id = conv_id
        self.path = steps
        self.end(self.stack[-1], str(conv_id))

    def end(self, n: Node, conv_id: str) -> None:
        """Note a member that ends in a node."""
        if n.node is None:
            n.ends.update(f",{conv_id}".encode() if n.n_ends else conv_id.encode())
        else:
            n.ends.append(conv_id)
            n.held += len(conv_id) + 1
            if n.held > CHUNK:
                self.chunk(n)
        n.n_ends += 1

    def chunk(self, n: Node) -> None:
        self.rows.append((2, *[None] * 8, ",".join(n.ends), n.node, None, self.number, n.seq))
        n.ends, n.held, n.seq = [], 0, n.seq + 1

    def pop(self, depth: int) -> None:
        """Finish all nodes below ``depth``."""
        while len(self.stack) > depth + 1:
            n, above = self.stack.pop(), self.stack[-1]
            if n.node is not None:  # what lies below is summed over the skeleton
                self.part(n, len(self.stack))
                continue
            for row in n.below:
                row[3] = n.conv_id
            self.rows += n.below
            leaves, saved = (n.n_leaves if n.n_children else 1), n.saved + (n.n_convs - 1) * n.length
            row = [0, n.conv_id, len(self.stack), None, above.node, n.n_convs, n.n_children, leaves, saved,
                   n.ends.hexdigest(), None, None, None, None]
            (self.rows if above.node is not None else above.below).append(row)
            above.n_children += 1
            above.n_leaves += leaves
            above.saved += saved

    def part(self, n: Node, depth: int) -> None:
        if n.ends:
            self.chunk(n)
        self.rows.append((1, n.conv_id, depth, None, None, n.n_convs, n.n_children, n.n_leaves, n.saved, None, n.node,
                          n.length, self.number, None))

    def finish(self) -> None:
        self.pop(0)
        if self.stack:
            self.part(self.stack.pop(), 0)


def _shard_rows(paths: DataFrame, splitters: list[tuple[bytes, int]]) -> DataFrame:
    """Rows ``SHARD_DDL`` of all shards of ``conv_id, path, lengths``."""
    dealt_schema = StructType.fromDDL("shard int, conv_id long, path binary, lengths array<int>")
    schema = StructType.fromDDL(SHARD_DDL)
    arrow, dealt_arrow = to_arrow_schema(schema), to_arrow_schema(dealt_schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton = Skeleton(splitters)
        for batch in batches:
            shard = pa.array([skeleton.shard(p, c) for c, p in zip(batch[0].to_pylist(), batch[1].to_pylist())], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip([shard, *batch.columns], dealt_arrow)], schema=dealt_arrow)

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton, current = Skeleton(splitters), None
        for batch in batches:
            for number, conv_id, path, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.number != number:
                    before, current = current, Shard(skeleton, number)
                    if before is not None:
                        before.finish()
                        current.rows = before.rows
                current.add(conv_id, path, lengths)
                if len(current.rows) > FLUSH_ROWS:
                    yield batch_of(current.rows)
                    current.rows = []
        if current is not None:
            current.finish()
            yield batch_of(current.rows)

    dealt = paths.select("conv_id", "path", "lengths").mapInArrow(deal, dealt_schema)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    return dealt.mapInArrow(read, schema)


def _hashed(chunks: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the chunks of a node in order, one at a time."""
    schema = StructType.fromDDL("node int, ends_sha256 string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for own, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                if own != node:
                    out += [] if node is None else [(node, state.hexdigest())]
                    node, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        out += [] if node is None else [(node, state.hexdigest())]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    ordered = chunks.repartition("node").sortWithinPartitions("node", "shard", "seq")
    return ordered.select("node", "ends").mapInArrow(run, schema)


def _skeleton_nodes(skeleton: Skeleton, parts: DataFrame) -> list[tuple]:
    """The skeleton's nodes from their summed parts, subtree sums taken along it: as many rows as it has nodes."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    found = {r["node"]: r for r in parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("length").alias("length"), *sums).collect()}
    leaves = {k: r["n_leaves"] for k, r in found.items()}
    saved = {k: r["saved_tokens"] + (r["n_convs"] - 1) * r["length"] for k, r in found.items()}
    children = {k: r["n_children"] + len(skeleton.children[k]) for k, r in found.items()}
    for k in sorted(found, reverse=True):  # preorder: a subtree's nodes follow its top
        leaves[k] = leaves[k] if children[k] else 1
        if k:
            leaves[skeleton.parent[k]] += leaves[k]
            saved[skeleton.parent[k]] += saved[k]
    return [(k, r["conv_id"], skeleton.depth[k], found[skeleton.parent[k]]["conv_id"] if k else None,
             r["n_convs"], children[k], leaves[k], saved[k]) for k, r in found.items()]


def trie_nodes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``conv_id, turns``, turns being (digest, length) in order.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (the root: NULL);
    ``n_convs`` counts members, ``n_children`` children, ``n_leaves`` the childless nodes of
    the subtree, its top included; ``saved_tokens`` sums (members - 1) * length over the
    subtree; ``ends_sha256`` hashes the ids, ascending and comma-joined, of members that end
    in the node.  A conversation without turns ends in the root.  ``shards`` changes the
    work, not the result.  No conversations, no nodes.
    """
    spark = conversations.sparkSession
    paths = stage(conversations.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.digest)), "")).alias("path"),
        F.transform("turns", lambda t: t.length.cast("int")).alias("lengths")), "trie-paths")
    splitters = choose_splitters(paths, shards)
    rows = stage(_shard_rows(paths, splitters), "trie-shards")
    top = _skeleton_nodes(Skeleton(splitters), rows.where("kind = 1"))
    top = spark.createDataFrame(
        top, "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    hashes = _hashed(rows.where("kind = 2"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    skeleton = top.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*COLUMNS)
    # At most as many rows as the splitters have turns: SPLITTER_BYTES / DIGEST.
    names = F.broadcast(top.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("named")))
    local = rows.where("kind = 0").join(names, "parent_node", "left").withColumn(
        "parent_conv_id", F.coalesce("parent", "named")).withColumnRenamed("ends", "ends_sha256").select(*COLUMNS)
    return skeleton.unionByName(local)
