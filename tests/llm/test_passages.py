"""Decontamination against brute force and on very repetitive texts."""

import re
import time

import numpy as np
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items):
    """(words, words hit, ids of items with a window that occurs)."""
    words, hit, ids = words_of(text), set(), set()
    places = {}
    for size in range(1, 11):
        for i in range(len(words) - size + 1):
            places.setdefault(tuple(words[i:i + size]), []).append(i)
    for item_id, item in items:
        own = words_of(item)
        if item_id is None or not own:
            continue
        size = min(10, len(own))
        for k in range(len(own) - size + 1):
            for i in places.get(tuple(own[k:k + size]), []):
                hit.update(range(i, i + size))
                ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


def test_repetitive_texts_match_brute_force(spark):
    random = np.random.default_rng(9)

    def text(n, kinds):
        return " ".join(f"w{x}" for x in random.integers(0, kinds, n))
    items = [(i, text(int(random.integers(1, 60)), int(random.integers(2, 5)))) for i in range(30)]
    items += [(50, "w0 w1 " * 30), (51, "w0"), (52, "W1, w1"), (52, "w0 w0 w0"), (53, ""), (54, None), (None, "w0 w1"), (55, "rare words that no text holds")]
    docs = [(i, text(int(random.integers(0, 300)), int(random.integers(1, 6)))) for i in range(60)]
    docs += [(100, "w0 w1 " * 500), (101, None), (102, ""), (103, "w1 " * 400), (103, "w1 " * 400), (None, "w0 w2")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.decontaminate(rows, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = sorted(((d, *plain_hits(t, items)) for d, t in docs), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found), key=str) == want
    assert all(r.n_items == len(r.item_ids) for r in found)


def test_a_long_repetitive_text_takes_seconds(spark):
    docs = spark.createDataFrame([(1, "a b " * 10_000), (2, "a b c " * 6_000), (3, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b " * 200), (2, "b c a " * 100)], "item_id long, text string")
    decontaminate.decontaminate(docs.limit(1), items.limit(1)).collect()  # compiled
    start = time.time()
    found = {r.doc_id: (r.n_hit, r.item_ids) for r in decontaminate.decontaminate(docs, items).collect()}
    assert found == {1: (20_000, ["1"]), 2: (18_000, ["2"]), 3: (0, [])}
    assert time.time() - start < 30
