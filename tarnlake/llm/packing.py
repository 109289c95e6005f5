"""Sequence packing by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id.  Whole windows are cut off a long
document; what is left is an item.  Items are dealt at random into blocks of
bounded size, and the items of a block are divided into windows of near-equal
length: partial partitions start with one item each, and the two with the largest
spread are merged again and again, the largest sums of one with the smallest of
the other.  If a window then exceeds the capacity, the block gets one window more.

Only piece lengths and checksums are shuffled, never ids.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import map_batches
from tarnlake.session import stage

CAPACITY, END_ID = 4096, 2
# Mean number of windows, and at most so many items, that a block holds on average.
BLOCK_WINDOWS, BLOCK_ITEMS = 256, 8192
# Chunks of text whose ids a worker keeps, at about 200 bytes each.
CACHE_CHUNKS = 1_000_000
_MARK = b"\x01"
# A word of ASCII or Latin-1 letters, which is one token sequence, and closing punctuation, which is another; no
# apostrophe, as in "'s".
_word = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?)\]}]*)").fullmatch
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class ChunkTokenizer:
    """Ids of a tokenizer that drops white space and never joins text across it.

    Then a text's ids are those of its blank-separated chunks, and most chunks
    have been seen before.  Of an unseen word with closing punctuation both are looked
    up again.  Unseen words are tokenized together: each ends with its only id that
    closes a word.  If their number does not say so, and for chunks that are no words,
    they are kept apart by a control character with one id of its own; chunks that hold
    that character go one by one.  ``tests/llm`` compares with the plain call.
    """

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}
        (self.mark,) = self._ids([_MARK.decode()])[0]
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> None:
        words, others, closed = set(), [], []
        for chunk in chunks:
            if found := _word(chunk):
                word, end = found.groups()
                words.add(word)
                if end:
                    closed.append((chunk, word, end))
            else:
                others.append(chunk)
        self._learn_words(list(words.difference(self.known)))
        self._learn_others([*others, *{end for _, _, end in closed}.difference(self.known, others)])
        for chunk, word, end in closed:
            self.known[chunk] = self.known[word] + self.known[end]

    def _learn_words(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 512):
            part = words[at:at + 512]
            ids = np.array(self._ids([b" ".join(part).decode()])[0], "<u4")
            cuts = np.flatnonzero(self.closes[ids]) + 1
            if len(cuts) != len(part):
                self._learn_others(part)
                continue
            raw, low = ids.tobytes(), 0
            for word, high in zip(part, cuts.tolist(), strict=True):
                self.known[word] = raw[4 * low:4 * high]
                low = high

    def _learn_others(self, chunks: list[bytes]) -> None:
        plain = [c for c in chunks if _MARK not in c]
        odd = [c for c in chunks if _MARK in c]
        for at in range(0, len(plain), 512):
            part = plain[at:at + 512]
            ids = np.array(self._ids([(b" " + _MARK + b" ").join(part).decode()])[0], "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            raw, low = ids.tobytes(), 0
            for chunk, high in zip(part, [*cuts.tolist(), len(ids)], strict=True):
                self.known[chunk] = raw[4 * low:4 * high]
                low = high + 1
        for chunk, ids in zip(odd, self._ids([c.decode() for c in odd])):
            self.known[chunk] = np.array(ids, "<u4").tobytes()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > self.limit:
            self.known.clear()
        # Lower case is part of the vocabulary; special tokens are found before it.
        parts = [(t if b"<|" in t else t.lower()).split() for t in texts]
        new = set().union(*parts).difference(self.known)
        if new:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in parts]


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer_at(path: str, limit: int) -> ChunkTokenizer:
    """One tokenizer a worker process, so that later tasks find its chunks."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path, limit)
    _tokenizers[path].limit = limit
    return _tokenizers[path]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
    cache_chunks: int = CACHE_CHUNKS,
) -> DataFrame:
    """Every document cut into whole windows and a rest; with ``keep_ids`` also the ids."""
    end = np.array([end_id], "<u4").tobytes()

    def make() -> Callable[..., dict]:
        encode = tokenizer_at(path, cache_chunks)

        def work(doc_ids: list, texts: list) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for doc_id, raw in zip(doc_ids, encode([t or b"" for t in texts])):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, capacity):
                    own = raw[4 * start:4 * (start + capacity)]
                    ids = np.frombuffer(own, "<u4") if keep_ids else None
                    row = (doc_id, start, len(own) // 4, zlib.crc32(own), total, ids)
                    for name, value in zip(out, row):
                        out[name].append(value)
            return out
        return work

    return map_batches(docs, ["doc_id", "text"], PIECE + (", ids array<long>" if keep_ids else ""), make)


def karmarkar_karp(sizes: list[int], k: int) -> list[list[int]]:
    """Item positions of ``k`` near-equal sets."""
    # A partial partition: its sums less the smallest, falling, and the items of each.
    heap = [(-size, i, np.array([size]), [[i]]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a, items_a = heapq.heappop(heap)
        _, _, b, items_b = heapq.heappop(heap)
        if len(a) + len(b) <= k:
            sums, items = np.concatenate([a, b]), items_a + items_b
        else:
            sums = np.zeros(k, np.int64)
            sums[:len(a)] = a
            sums[k - len(b):] += b[::-1]
            items = items_a + [[] for _ in range(k - len(a))]
            for slot, own in zip(range(k - 1, k - 1 - len(b), -1), items_b):
                items[slot] = items[slot] + own
        by = np.argsort(-sums, kind="stable")
        sums, items = sums[by], [items[i] for i in by.tolist()]
        low = sums[-1] if len(sums) == k else 0
        heapq.heappush(heap, (int(low - sums[0]), order, sums - low, items))
        order += 1
    return heap[0][3] if heap else []


def pack_block(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until every one fits."""
    whole = [[i] for i, size in enumerate(sizes) if size == capacity]
    rest = [i for i, size in enumerate(sizes) if size < capacity]
    k = max(1, -(-sum(sizes[i] for i in rest) // capacity))
    while rest:
        windows = [[rest[i] for i in w] for w in karmarkar_karp([sizes[i] for i in rest], k)]
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return whole + [w for w in windows if w]
        k += 1
    return whole


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    block_windows: int = BLOCK_WINDOWS, block_items: int = BLOCK_ITEMS, keep_ids: bool = False,
    cache_chunks: int = CACHE_CHUNKS,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    A NULL or blank text has the end id only.  Repeated rows, and rows with a NULL
    doc_id, are packed each by itself.  No rows in, no rows out.
    """
    cut = pieces(docs, path, capacity, end_id, keep_ids, cache_chunks).withColumn("row", F.monotonically_increasing_id())
    cut = stage(cut, "pack-pieces")
    size = cut.agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).first()
    blocks = max(1, -(-(size["tokens"] or 0) // (block_windows * capacity)), -(-size["n"] // block_items))
    # By a hash of the row, so blocks are even however documents are sorted.
    rows = cut.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    narrow = rows.drop("ids")

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        sizes = table["length"].to_pylist()
        block = table["block"][0].as_py() if len(sizes) else 0
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for number, window in enumerate(pack_block(sizes, capacity)):
            at = 0
            for i in window:
                sequence[i], offset[i] = (block << 32) + number, at
                at += sizes[i]
        own = table.select(["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return own.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    placed = narrow.groupBy("block").applyInArrow(
        place, f"row long, {PIECE}, sequence_id long, offset long")
    if keep_ids:
        return placed.join(cut.select("row", "ids"), "row").drop("row")
    return placed.drop("row")
