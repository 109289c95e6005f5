"""URL filter: rules first, then a Bloom filter cascade over the hosts of the corpus.

Level 0 of a cascade holds the listed keys.  Unlisted keys of the corpus that pass
it are held by level 1, listed keys that pass level 1 by level 2, and so on until
no key passes wrongly.  Every key of the corpus is known when the cascade is
built, so the answer is exact for all of them, without a join: a filter is an
array of longs that comes to the query as a scalar subquery.

Keys are dealt into shards by their hash and each shard has a cascade of its own,
so no array exceeds a bound that does not grow with the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.bloom import passes, word_array
from tarnlake.session import stage

# Listed keys of a shard: its first level has about 10 to 20 bits for each.
SHARD_KEYS = 1 << 20


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or a url without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def match_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule over columns ``host, path`` and its verdict; NULL if none fits.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


class Cascade:
    """Levels of one shard; ``listed`` tells for every key of the universe whether it is listed."""

    def __init__(self, keys: DataFrame):
        """``keys``: stored, distinct ``key`` with boolean ``listed``."""
        self.levels: list[tuple[Column, int, int]] = []
        count = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
        held, other = count.get(True, 0), count.get(False, 0)
        side, n, against = True, held, other
        rest = {True: keys.where("listed"), False: keys.where("NOT listed")}
        while n:
            # First level: as few wrong passes as keys to hold; deeper ones halve the rest.
            rate = min(0.5, n / against) if not self.levels and against else 0.5
            hashes = max(1, round(-math.log2(rate)))
            size = max(64, math.ceil(n * hashes / math.log(2)))
            level = len(self.levels)
            words = stage(word_array(rest[side], ["key"], level, size, hashes), "cascade-level")
            self.levels.append((words.scalar(), size, hashes))
            passed = stage(rest[not side].where(self._level(level)), "cascade-passed")
            rest[not side], side = passed, not side
            n, against = passed.count(), n

    def _level(self, i: int) -> Column:
        words, size, hashes = self.levels[i]
        return passes(words, ["key"], i, size, hashes)

    def listed(self) -> Column:
        """Over a column ``key``: the first level a key does not pass decides."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(~self._level(i), F.lit(i % 2 == 1)).otherwise(answer)
        return answer


def mark_listed(rows: DataFrame, key: str, listed: Column | DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``rows`` with a boolean ``listed``: whether their key is on the list.

    ``listed`` is the list: a table with a column ``key``, of any size, or a predicate over
    ``key``.  Either meets each distinct key once, when the cascade is built; keys of the list that
    the rows lack, NULL and repeated ones change nothing.  A NULL key is not listed.
    """
    universe = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.lit(1).alias("one"))
    if isinstance(listed, DataFrame):
        on_list = listed.select("key").where("key IS NOT NULL").distinct().withColumn("__on", F.lit(True))
        universe, listed = universe.join(on_list, "key", "left"), F.col("__on").isNotNull()
    universe = stage(universe.select("key", listed.alias("listed")), "cascade-keys")
    held = universe.where("listed").count()
    shards = max(1, -(-held // shard_keys))
    shard = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards))
    answer = F.lit(False)
    for i in reversed(range(shards)):
        answer = F.when(shard == i, Cascade(universe.where(shard == i)).listed()).otherwise(answer)
    return rows.withColumn("key", F.col(key)).withColumn("listed", F.col("key").isNotNull() & answer).drop("key")


def hosts_by_content(pages: DataFrame, bad: Column, percent: int = 50) -> DataFrame:
    """``key``: hosts of which at least ``percent`` of the pages fulfil ``bad``; pages without a host name none."""
    host, _ = url_parts(F.col("url"))
    share = pages.select(host.alias("key"), F.coalesce(bad, F.lit(False)).alias("bad")).where("key <> ''").groupBy("key").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    return share.where(100 * F.col("n_bad") >= percent * F.col("n")).select("key")


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: Column | DataFrame, shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict``: a rule's verdict, else block for listed hosts and allow for others.

    A NULL url, or one without ``://``, has an empty host and path, which no rule
    fits.  Every row gets one row, repeated ones too.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(rules)
    marked = mark_listed(parts, "host", listed, shard_keys)
    return marked.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
