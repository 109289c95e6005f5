"""Language of web pages by fusing evidence in Bayes' rule.

The evidence is the visible text (character n-grams), the language that the markup
declares, the last label of the host and the host itself.  How far declarations
and suffixes can be trusted, and what is usual on a host, is counted over all
pages from the posteriors of their texts: grouped sums, smoothed from host to
domain to the whole corpus, with a page's own share taken out of every one.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import labelled_sample, map_batches
from tarnlake.llm.url_cascade import url_parts
from tarnlake.session import stage

# Sample bound by language; cells of the n-gram model; languages at most.
SAMPLE, BITS, MAX_LANGUAGES = 500, 16, 256
# N-grams are not independent: a text counts as so many at most.
EFFECTIVE = 60
# Pages of the next wider group that a group's own counts are worth.
PRIOR = 5.0
HIDDEN = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible(page: bytes | None) -> str:
    """Text of a page: no markup, scripts, styles or comments, entities resolved."""
    return html.unescape(HIDDEN.sub(b" ", page or b"").decode("utf-8", "replace"))


def grams(text: str) -> np.ndarray:
    """Cells of the 1- to 3-grams of the lower-cased letters of each word, with its ends."""
    letters = np.array([ord(c) if c.isalpha() else 32 for c in text.lower()] + [32], np.uint64)
    out = []
    for n in (1, 2, 3):
        if len(letters) >= n:
            code = letters[: len(letters) - n + 1].copy()
            for j in range(1, n):
                code = code << np.uint64(21) | letters[j: len(letters) - n + 1 + j]
            blank = np.uint64(sum(32 << 21 * j for j in range(n)))
            code = code[code != blank] + np.uint64(n)
            out.append((code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray

    def likelihood(self, text: str) -> np.ndarray:
        """Log likelihood of each language, for ``EFFECTIVE`` n-grams at most; zeros without letters."""
        cells = grams(text)
        if not len(cells):
            return np.zeros(len(self.languages))
        return self.log_p[:, cells].mean(axis=1) * min(len(cells), EFFECTIVE)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """N-gram models from at most ``sample`` documents of each language in ``docs.lang``."""
    found = docs.where("lang IS NOT NULL").select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    languages = [r["lang"] for r in found]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return Model([], np.zeros((0, 1 << BITS)))
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    labels = docs.select("doc_id", number.alias("label"))
    rows = labelled_sample(docs, labels, "label", {k: sample for k in range(len(languages))})

    class Count:
        def __init__(self):
            self.held = np.zeros((len(languages), 1 << BITS), np.int64)

        def __call__(self, label, texts):
            for k, text in zip(label, texts):
                self.held[k] += np.bincount(grams(text.decode()), minlength=1 << BITS)
            return {"label": [], "cell": [], "n": []}

        def finish(self):
            label, cell = np.nonzero(self.held)
            return {"label": label, "cell": cell, "n": self.held[label, cell]}

    counts = map_batches(rows, ["label", "text"], "label int, cell int, n long", Count)
    held = counts.groupBy("label", "cell").agg(F.sum("n").alias("n")).toArrow()
    p = np.full((len(languages), 1 << BITS), 0.5)
    p[held["label"].to_numpy(), held["cell"].to_numpy()] += held["n"].to_numpy()
    return Model(languages, np.log(p / p.sum(axis=1, keepdims=True)))


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """Stored rows ``page_id, host, domain, suffix, declared, text_log`` (log likelihoods), with a row number."""
    host, _ = url_parts(F.col("url"))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*\slang\s*=\s*[\"']?([a-z]+)", 1))
    rows = pages.select(
        "page_id", host.alias("host"), declared.alias("declared"), F.coalesce("html", F.lit("")).alias("html"))
    sent = pages.sparkSession.sparkContext.broadcast(model)  # languages * 2^BITS doubles

    def make():
        own = sent.value
        return lambda ids, hosts, said, texts: {
            "page_id": ids, "host": [h.decode() for h in hosts], "declared": [s.decode() for s in said],
            "text_log": [own.likelihood(visible(t)) for t in texts]}

    found = map_batches(
        rows, ["page_id", "host", "declared", "html"],
        "page_id long, host string, declared string, text_log array<double>", make)
    return stage(found.select(
        "*", F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("suffix"),
        F.monotonically_increasing_id().alias("row")), "lang-evidence")


def _normalised(values: Column) -> Column:
    """exp of log values, divided by their sum."""
    up = F.transform(values, lambda v: F.exp(v - F.array_max(values)))
    return F.transform(up, lambda v: v / F.aggregate(up, F.lit(0.0), lambda a, x: a + x))


def identify(pages: DataFrame, model: Model, prior: float = PRIOR) -> DataFrame:
    """``page_id, lang, probability, text_lang, declared`` of every row.

    Ties go to the first language in order.  A NULL page or url has no text, an
    empty host and nothing declared, and takes what the remaining evidence says.
    Without any language in the model, all languages are NULL.
    """
    names, n = model.languages, len(model.languages)
    rows = evidence(pages, model)
    if not n:
        none = F.lit(None).cast("string")
        return rows.select(
            "page_id", none.alias("lang"), F.lit(None).cast("double").alias("probability"),
            none.alias("text_lang"), F.nullif("declared", F.lit("")).alias("declared"))
    rows = rows.withColumn("p", _normalised(F.col("text_log")))
    sums = F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(n)])

    def counted(key: str) -> DataFrame:
        """Sums of the text posteriors by ``key``: expected pages of each language."""
        return stage(rows.groupBy(key).agg(sums.alias(f"{key}_n")), f"lang-{key}")

    total = rows.agg(sums.alias("n")).first()["n"]
    joined = rows
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(counted(key), key)
    joined = joined.withColumn("all_n", F.array(*[F.lit(float(x or 0.0)) for x in total]))

    def summed(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def smoothed(counts: str, wider: str) -> Column:
        return F.zip_with(counts, wider, lambda c, w: (c + prior * w) / (summed(F.col(counts)) + prior))

    # A page's own posterior is left out of all counts that judge it.
    joined = joined.select("*", *[
        F.zip_with(f"{key}_n", "p", lambda c, p: F.greatest(c - p, F.lit(0.0))).alias(f"{key}_o")
        for key in ("host", "domain", "suffix", "declared", "all")])
    joined = joined.withColumn("base", F.transform("all_o", lambda x: (x + 1) / (summed(F.col("all_o")) + n)))
    joined = joined.withColumn("domain_p", smoothed("domain_o", "base"))
    joined = joined.withColumn("host_p", smoothed("host_o", "domain_p"))

    def given_language(key: str) -> Column:
        """log P(key's value | language), smoothed by one page; nothing declared says nothing."""
        own = F.zip_with(f"{key}_o", "all_o", lambda c, w: F.log((c + 1.0) / (w + float(n))))
        return F.when(F.col(key) == "", F.array_repeat(F.lit(0.0), n)).otherwise(own)

    logs = F.zip_with("text_log", F.transform("host_p", lambda p: F.log(p)), lambda a, b: a + b)
    for key in ("suffix", "declared"):
        logs = F.zip_with(logs, given_language(key), lambda a, b: a + b)
    joined = joined.withColumn("logs", logs).withColumn("q", _normalised(F.col("logs")))
    languages = F.array(*[F.lit(x) for x in names])

    def best(values: str) -> Column:
        return F.get(languages, F.array_position(values, F.array_max(values)).cast("int") - 1)

    return joined.select(
        "page_id", best("q").alias("lang"), F.array_max("q").alias("probability"), best("p").alias("text_lang"),
        F.nullif("declared", F.lit("")).alias("declared"))
