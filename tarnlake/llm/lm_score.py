"""Cross-entropy difference: how much better a target model predicts a document than a matched background model.

Both are bigram models over all words of the corpus, with the same smoothing, and the
background counts are scaled to the target's number of tokens.  A document is scored
against all others: its own words are taken off the counts of its side first, so a score
does not tell who was counted.

With c the counts of the others, k the scale of a side and P1 its unigram model, the loss of
a word w after a word h is -log of (k c(h,w) + S P1(w)) / (k c(h) + S), which is

    -log(S P1(w)) + log(k c(h) + S) - log(1 + k c(h,w) / (S P1(w)))

The first two terms need counts of words only, and the last is zero for a bigram of a single
document.  The most frequent words and bigrams are counted first and sent to every task,
which sums up what they tell of its texts.  Of all other tokens it sends the bigram on, once:
to a bucket by the bigram's hash, or by the word's if the word is not among the most frequent.
A bucket then holds all tokens of its bigrams, and of its words, since each token ends one
bigram.  It counts them and tells every chunk of texts what its own tokens add.  What is sent
to all tasks changes the work, not the result.  A word is known by its 64-bit hash, a bigram
by one of both, or by its frequent word and a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import map_batches, sent_whole
from tarnlake.llm.jaccard_join import _FACTORS as FACTORS, _mixed as mixed, SEGMENT, Shingles
from tarnlake.session import stage

# Weight of the unigram model, in tokens of history.
SMOOTHING = 50.0
# Counts sent to every task, of words and of bigrams: 24 bytes each.
CACHE = 1 << 18
# Tokens of a chunk, which a task sums at once, and of a bucket at most, about.
FLUSH, BUCKET = 1 << 20, 2_000_000
# A bigram that is one in so many of a chunk's tokens may be among the most frequent.
SHARE = 1 << 15
# Upper bits of a hash by which it is found among the most frequent.
SLOTS = 20
# The word before the first and after the last.
EDGE = np.uint64(0x5EED)
SIDES = ("background", "target")
# What a row tells: what is known of a chunk's texts, or their tokens with a frequent word, or with another.
BASE, FREQUENT, RARE = range(3)


class Words(Shingles):
    """The hashes of all words of texts in order, an edge before the first and after the last."""

    def __init__(self):
        super().__init__(1)

    def __call__(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        for batch in self._batches([(t or b"").lower() for t in texts]):
            if len(batch) == 1 and len(batch[0]) > SEGMENT:
                words, counts = self._long(batch[0]), None
            else:
                starts, words = self.words(b"\n".join(batch))
                counts = np.diff(np.searchsorted(starts, np.cumsum([len(t) + 1 for t in batch])), prepend=0)
            at = 0
            for n in [len(words)] if counts is None else counts:
                yield np.concatenate([[EDGE], words[at:at + n], [EDGE]]) if n else words[:0]
                at += n


def bigrams(words: np.ndarray) -> np.ndarray:
    """A hash for each two neighbours."""
    return mixed(words[:-1] * FACTORS[0] + words[1:] * FACTORS[1])


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, end: int) -> np.ndarray:
    return np.diff(starts, append=end)


class Chunks:
    """``rows`` of every ``FLUSH`` tokens of a task: of their texts' sides and, if asked for, ids, and of all tokens
    the text, the word and the bigram that ends there.  The texts of a chunk come by side and length."""

    def __init__(self, columns: Sequence[str], rows: Callable[..., dict]):
        self.words, self.columns, self.rows = Words(), columns, rows
        self.held: tuple[list, list, list] = ([], [], [])
        self.n = 0

    def __call__(self, target, texts, ids=()):
        words = list(self.words(texts))
        for held, more in zip(self.held, (target, words, ids)):
            held += more
        self.n += sum(map(len, words))
        return self.finish() if self.n > FLUSH else {c: [] for c in self.columns}

    def finish(self):
        target, words, ids = self.held
        self.held, self.n = ([], [], []), 0
        if not target:
            return {c: [] for c in self.columns}
        target, sizes = np.array(target, bool), np.array([len(w) for w in words])
        order = np.argsort(np.where(target, -sizes, sizes), kind="stable")
        target, sizes, words, ids = target[order], sizes[order], [words[i] for i in order], [ids[i] for i in order] if ids else ids
        every = np.concatenate(words)
        ends = np.ones(len(every), bool)
        ends[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        ends = np.flatnonzero(ends)
        text = np.repeat(np.arange(len(sizes)), np.maximum(0, sizes - 1))
        pairs = bigrams(every)[ends - 1] if len(ends) else every
        return self.rows(target, ids, text, every[ends], pairs)


COUNTS_DDL = "kind int, g long, background long, target long"
COUNTS = ("kind", "g", *SIDES)


def _counted(target, ids, text, words, pairs):
    """The words of a chunk, and the bigrams that may be among the most frequent, with their tokens by side."""
    out: dict[str, list] = {c: [] for c in COUNTS}
    for k in (0, 1):
        mine = target[text] == k
        for kind, keys in enumerate((words, pairs)):
            keys = np.sort(keys[mine])
            first = _starts(keys)
            n = _lengths(first, len(keys))
            if kind:
                often = n > len(keys) // SHARE
                first, n = first[often], n[often]
            out["kind"] += [kind] * len(first)
            out["g"] += keys[first].view(np.int64).tolist()
            out[SIDES[k]] += n.tolist()
            out[SIDES[1 - k]] += [0] * len(first)
    return out


def _sums(rows: DataFrame, make: Callable[[], Callable[..., dict]], name: str) -> DataFrame:
    """Tokens by side, ``make`` counting those of a task, stored."""
    sums = [F.sum(s).alias(s) for s in SIDES]
    return stage(map_batches(rows, ["target", "text"], COUNTS_DDL, make).groupBy("kind", "g").agg(*sums), name)


class Known:
    """The counts by side of some hashes, which are found by their upper bits."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.slots = np.searchsorted(keys, np.arange(1 << SLOTS, dtype=np.uint64) << np.uint64(64 - SLOTS)).astype(np.int32)

    def find(self, g: np.ndarray) -> np.ndarray:
        """Where each of ``g`` is, -1 if it is not here."""
        if not len(self.keys):
            return np.full(len(g), -1, np.int32)
        last = len(self.keys) - 1
        at = np.minimum(self.slots[(g >> np.uint64(64 - SLOTS)).astype(np.int64)], last)
        open_ = np.flatnonzero(self.keys[at] < g)
        while len(open_):
            open_ = open_[at[open_] < last]
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] < g[open_]]
        return np.where(self.keys[at] == g, at, np.int32(-1))


class CountKnown:
    """Tokens of a task that end one of ``keys``, by side."""

    def __init__(self, keys: np.ndarray):
        self.known = Known(keys, np.zeros((2, len(keys)), np.int64))
        self.chunks = Chunks(COUNTS, self.add)

    def add(self, target, ids, text, words, pairs):
        at = self.known.find(pairs)
        for k in (0, 1):
            self.known.counts[k] += np.bincount(at[(at >= 0) & (target[text] == k)], minlength=len(self.known.keys))
        return {c: [] for c in COUNTS}

    def __call__(self, target, texts):
        return self.chunks(target, texts)

    def finish(self):
        self.chunks.finish()
        some = np.flatnonzero(self.known.counts.any(axis=0))
        return {"kind": [1] * len(some), "g": self.known.keys[some].view(np.int64).tolist()} | {
            s: self.known.counts[k, some].tolist() for k, s in enumerate(SIDES)}


def _most_frequent(table: DataFrame, cache: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts by side of the ``cache`` most frequent rows of a stored table or fewer: all above some frequency."""
    n = F.col("background") + F.col("target")
    # By frequency, in powers of a twentieth: a few hundred rows.
    step = F.floor(F.log(n) * 20)
    held, least = 0, None
    for row in table.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        held += row["n"]
        if held > cache:
            break
        least = row["step"]
    top = table.where(step >= F.lit(least)) if least is not None else table.limit(0)
    # At most ``cache`` rows.
    rows = top.select("g", *SIDES).toPandas()
    keys = rows["g"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows[list(SIDES)].to_numpy(np.float64)[order].T


@dataclass
class Sizes:
    """Tokens by side, different words, and the weight of a count by side."""

    tokens: list[float]
    words: int
    scale: list[float]


def unigram(count, own, sizes: Sizes, k: int, log=np.log):
    """Log of S * P1 of a side, ``own`` tokens of ``count`` and ``own_all`` in all left out."""
    c, n = own
    return log(SMOOTHING * (sizes.scale[k] * (count - c) + 1) / (sizes.scale[k] * (sizes.tokens[k] - n) + sizes.words))


def word_terms(count, own, sizes: Sizes, k: int, log=np.log):
    """The loss of one token of a word, as the word that comes and as the one before the next."""
    return log(sizes.scale[k] * (count - own[0]) + SMOOTHING) - unigram(count, own, sizes, k, log)


def _planes(n: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then the next, and so on, which compresses better."""
    return n.astype(np.int32).view(np.uint8).reshape(len(n), 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, len(planes) // 4).T).view(np.int32).ravel()


def _steps(n: np.ndarray) -> bytes:
    """Ascending numbers, by what they grow."""
    return _planes(np.diff(n, prepend=0))


def _ascending(planes: bytes) -> np.ndarray:
    return np.cumsum(_numbers(planes), dtype=np.int64)


ROWS_DDL = "bucket int, chunk long, kind int, ids array<{}>, texts binary, tokens binary, n_all binary, first binary, second binary"
ROWS = [part.split()[0] for part in ROWS_DDL.split(", ")]
SUMS_DDL = "chunk long, ids array<{}>, texts binary, n_all binary, background binary, target binary"


class Score:
    """What is known of a chunk's texts, and the tokens that have to be looked up, by bucket.

    Of texts with such tokens, the place in the chunk, the number of these tokens and of all, negative for the
    target's; then of the tokens the bigram, and the word if it is rare, else how often its text has it.
    """

    def __init__(self, words: Known, pairs: Known, sizes: Sizes, buckets: int):
        self.words, self.pairs, self.sizes, self.buckets = words, pairs, sizes, buckets
        self.chunk = TaskContext.get().partitionId() << 32

    def __call__(self, target, ids, text, words, pairs):
        self.chunk += 1
        n_all = np.bincount(text, minlength=len(target))
        signed = np.where(target, -n_all, n_all)
        word = self.words.find(words)
        rare = word < 0
        lost = text[rare], pairs[rare], words[rare]
        text, pairs, word = text[~rare], pairs[~rare], word[~rare]
        sums, n = self.of_words(target, n_all, text, word)
        pair = self.pairs.find(pairs)
        here = pair >= 0
        sums += self.of_pairs(target, n_all, text[here], word[here], n[here], pair[here])
        out: dict[str, list] = {c: [] for c in ROWS}
        self.put(out, self.chunk % self.buckets, BASE, ids, np.arange(len(target)), n_all * 0, signed, *(s.tobytes() for s in sums))
        text, pairs, word, n = text[~here], pairs[~here], word[~here], n[~here]
        shift = _shift(len(self.words.keys))
        keys = word.astype(np.uint64) << shift | pairs & ((np.uint64(1) << shift) - np.uint64(1))
        self.send(out, FREQUENT, signed, pairs, text, keys, n, _planes)
        self.send(out, RARE, signed, lost[2], *lost, np.ndarray.tobytes)
        return out

    def put(self, out, bucket, kind, ids, texts, tokens, n_all, first, second):
        for c, v in zip(ROWS, (bucket, self.chunk, kind, ids, _steps(texts), _planes(tokens), _steps(n_all), first, second)):
            out[c].append(v)

    def send(self, out, kind, signed, by, text, first, second, pack):
        bucket = ((by >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.min_scalar_type(self.buckets))
        order = np.argsort(bucket, kind="stable")
        bucket, text, first, second = bucket[order], text[order], first[order], second[order]
        cuts = _starts(bucket)
        for k, end in zip(cuts, [*cuts[1:], len(bucket)]):
            at = _starts(text[k:end])
            texts = text[k:end][at]
            self.put(out, int(bucket[k]), kind, None, texts, _lengths(at, end - k), signed[texts], first[k:end].tobytes(), pack(second[k:end]))

    def of_words(self, target, n_all, text, word):
        """What frequent words add, and of each token how often its text has the word."""
        order = np.argsort(text * len(self.words.keys) + word, kind="stable")
        first = _starts(text[order], word[order])
        n = _lengths(first, len(order))
        times = np.empty(len(order), np.int64)
        times[order] = np.repeat(n, n)
        text, word = text[order[first]], word[order[first]]
        sums = np.zeros((2, len(target)))
        for k in (0, 1):
            own = _own(target[text] == k, n, n_all[text])
            sums[k] = np.bincount(text, n * word_terms(self.words.counts[k, word], own, self.sizes, k), len(target))
        return sums, times

    def of_pairs(self, target, n_all, text, word, n, pair):
        """What the most frequent bigrams add."""
        order = np.argsort(text * len(self.pairs.keys) + pair, kind="stable")
        first = _starts(text[order], pair[order])
        m, at = _lengths(first, len(order)), order[first]
        text, word, n, pair = text[at], word[at], n[at], pair[at]
        sums = np.zeros((2, len(target)))
        for k in (0, 1):
            sums[k] = np.bincount(text, pair_terms(
                self.pairs.counts[k, pair], m, target[text] == k, n, n_all[text], self.words.counts[k, word], self.sizes, k), len(target))
        return sums


def _own(mine, n, n_all):
    return n * mine, n_all * mine


def pair_terms(count, m, mine, n, n_all, word_count, sizes: Sizes, k: int):
    """What ``m`` tokens of a bigram take off the loss of a text, which holds its word ``n`` times."""
    one = unigram(word_count, _own(mine, n, n_all), sizes, k, lambda x: x)
    return -m * np.log1p(sizes.scale[k] * (count - m * mine) / one)


def _shift(words: int) -> np.uint64:
    """Bits of a bigram's hash beside the place of its frequent word; those that choose a bucket are others."""
    return np.uint64(64 - max(1, words.bit_length()))


def _look_up(rows: pa.Table, words: np.ndarray, sizes: Sizes) -> pa.Table:
    """What the tokens of a bucket add to the texts of each chunk, and what was known of them."""
    cells = {c: rows[c].to_pylist() for c in ROWS[2:] if c != "ids"}
    order, out = [], {c: [] for c in ("texts", "n_all", *SIDES)}

    def tell(row: int, *values: bytes | None) -> None:
        order.append(row)
        for held, v in zip(out.values(), values):
            held.append(v)

    for kind in (BASE, FREQUENT, RARE):
        own = [i for i, k in enumerate(cells["kind"]) if k == kind]
        if kind == BASE:
            for i in own:
                tell(i, *(cells[c][i] for c in ("texts", "n_all", "first", "second")))
        elif own:
            texts = [_ascending(cells["texts"][i]) for i in own]
            n_all = np.concatenate([_ascending(cells["n_all"][i]) for i in own])
            tokens = np.concatenate([_numbers(cells["tokens"][i]) for i in own])
            first = np.concatenate([np.frombuffer(cells["first"][i], np.uint64) for i in own])
            second = [cells["second"][i] for i in own]
            text = np.repeat(np.arange(len(n_all), dtype=np.int32), tokens)
            found = _of_frequent(first, np.concatenate(list(map(_numbers, second))), text, n_all, words, sizes) if kind == FREQUENT else (
                _of_rare(first, np.concatenate([np.frombuffer(s, np.uint64) for s in second]), text, n_all, sizes))
            for i, of, sums in zip(own, texts, np.split(found, np.cumsum(list(map(len, texts)))[:-1], axis=1)):
                some = sums.any(axis=0)
                if some.any():
                    tell(i, _steps(of[some]), None, *(s[some].tobytes() for s in sums))
    rows = rows.take(order)
    return pa.table([rows["chunk"], rows["ids"], *(pa.array(v, pa.binary()) for v in out.values())], ["chunk", "ids", *out])


def _by_pair(keys, text, target):
    """Distinct (bigram, text) of bigrams that several texts hold: one of their tokens, how many, and those of all by side."""
    order = np.argsort(keys, kind="stable")
    keys, text = keys[order], text[order]
    first = _starts(keys, text)
    m = _lengths(first, len(keys))
    start = _starts(keys[first])
    texts = _lengths(start, len(first))
    of_target = target[text[first]]
    counts = [np.repeat(np.add.reduceat(m * (of_target == k), start) if len(m) else m, texts) for k in (0, 1)]
    several = np.repeat(texts > 1, texts)
    return order[first[several]], m[several], [c[several] for c in counts]


def _of_frequent(keys, n, text, n_all, words: np.ndarray, sizes: Sizes) -> np.ndarray:
    target = n_all < 0
    at, m, counts = _by_pair(keys, text, target)
    word = (keys[at] >> _shift(words.shape[1])).astype(np.int64)
    own, n = text[at], n[at]
    return np.array([np.bincount(own, pair_terms(
        counts[k], m, target[own] == k, n, np.abs(n_all[own]), words[k, word], sizes, k), len(n_all)) for k in (0, 1)])


def _of_rare(keys, words, text, n_all, sizes: Sizes) -> np.ndarray:
    """All of a rare word's tokens are here: they count the word too."""
    target = n_all < 0
    _, word = np.unique(words, return_inverse=True)
    count = [np.bincount(word[target[text] == k], minlength=len(word)) for k in (0, 1)]
    each, to, n = np.unique(word * len(n_all) + text, return_inverse=True, return_counts=True)
    which, owner = each // len(n_all), each % len(n_all)
    at, m, counts = _by_pair(keys, text, target)
    own = text[at]
    out = []
    for k in (0, 1):
        terms = n * word_terms(count[k][which], _own(target[owner] == k, n, np.abs(n_all[owner])), sizes, k)
        more = pair_terms(counts[k], m, target[own] == k, n[to[at]], np.abs(n_all[own]), count[k][word[at]], sizes, k)
        out.append(np.bincount(owner, terms, len(n_all)) + np.bincount(own, more, len(n_all)))
    return np.array(out)


def _scores(rows: pa.Table) -> pa.Table:
    """The texts of a chunk, everything summed up."""
    texts, sums = ([_ascending(t) for t in rows["texts"].to_pylist()], {s: rows[s].to_pylist() for s in SIDES})
    base = rows["ids"].is_valid().to_pylist().index(True)
    n_all = np.abs(_ascending(rows["n_all"][base].as_py()))
    losses = []
    for s in SIDES:
        loss = np.zeros(len(n_all))
        for at, more in zip(texts, sums[s]):
            loss[at] += np.frombuffer(more, np.float64)
        losses.append(loss / np.maximum(1, n_all))
    none = n_all == 0
    return pa.table([rows["ids"][base].values, np.maximum(0, n_all - 1), pa.array(losses[1], mask=none), pa.array(losses[0], mask=none),
                     np.where(none, 0, losses[1] - losses[0])], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def _texts(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, target, text``, the rows of each task in the same order whenever it runs."""
    ids = stage(targets.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("target", F.lit(True)), "lm-targets")
    sent = sent_whole(ids)
    rows = docs.select("doc_id", "text").join(sent, "doc_id", "left").select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")
    # Rows that come by a shuffle come in any order.
    return rows if sent is not ids else rows.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")


def score_against(docs: DataFrame, labels: DataFrame, is_target: Column, cache: int = CACHE) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` of all documents, losses in nats a token.

    The target is the documents whose label row fulfils ``is_target``, the background all
    others; the end of a text counts as a token.  ``score`` is the target's loss less the
    background's: the lower, the more like the target.  A text without words has no losses
    and score 0.  If a side has no words, its model knows nothing but that.  A document on
    several rows, or of several copies, is left out once: its copies are other documents.
    ``docs`` is a stored table: three passes read it, and a task that is run again has to
    find its texts in the same order.
    """
    rows = _texts(docs, labels.where(is_target))
    every = _sums(rows, lambda: Chunks(COUNTS, _counted), "lm-counts")
    every_word, often = every.where("kind = 0"), every.where("kind = 1")
    total = every_word.agg(F.count("*").alias("words"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SIDES]).first()
    tokens = [float(total[s]) for s in SIDES]
    sizes = Sizes(tokens, total["words"], [tokens[1] / tokens[0] if all(tokens) else 1.0, 1.0])
    words = _most_frequent(every_word, cache)
    # So far these bigrams are counted where they are frequent; now everywhere.
    asked, _ = _most_frequent(often, cache)
    spark = docs.sparkSession.sparkContext
    some = spark.broadcast(asked)
    pairs = _most_frequent(_sums(rows, lambda: CountKnown(some.value), "lm-bigrams"), max(1, len(asked))) if len(asked) else (asked, np.zeros((2, 0)))
    known = spark.broadcast((words, pairs))
    buckets = max(16, -(-int(sum(tokens)) // BUCKET))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score():
        return Chunks(ROWS, Score(*(Known(*c) for c in known.value), sizes, buckets))

    def look_up(bucket: pa.Table) -> pa.Table:
        return _look_up(bucket, known.value[0][1], sizes)

    sent = map_batches(rows, ["target", "text", "doc_id"], ROWS_DDL.format(id_type), score)
    sums = sent.groupBy("bucket").applyInArrow(look_up, SUMS_DDL.format(id_type))
    return sums.groupBy("chunk").applyInArrow(
        _scores, f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, score double")
