"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import (
    conversation_trie, decontaminate, jaccard_join, langid, line_frequency, line_windows, lm_score, nbsvm, packing,
    simhash, toxicity, url_cascade, whitening)
from tarnlake.llm.common import load

# Allow and block rules.
RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# A page is junk that holds runs of symbols; a host with a tenth of its pages junk is on the block list.
JUNK, JUNK_PERCENT = "[#*%]{3}", 10


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, folder, "labels")))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(load(spark, folder, "pages"), langid.train(load(spark, folder, "documents")))


def op4_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_frequency.line_quality(load(spark, folder, "documents")).drop("removed")


def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_against(
        load(spark, folder, "documents"), load(spark, folder, "labels"), F.col("quality") == 1)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load(spark, folder, "documents"), tokenizer_path())


def op7_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = nbsvm.train(docs, load(spark, folder, "labels"), keep=~held_out)
    return nbsvm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    return line_windows.drop_repeated_windows(load(spark, folder, "documents"))


def op9_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages")
    return url_cascade.judge_urls(pages, RULES, url_cascade.hosts_by_content(pages, F.col("html").rlike(JUNK), JUNK_PERCENT))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(load(spark, folder, "documents"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie_nodes(conversation_trie.rebuilt(load(spark, folder, "conversations")))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(load(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_simhash, op3_language, op4_line_frequency, op5_lm_score, op6_packing, op7_nbsvm,
        op8_line_windows, op9_url_cascade, op10_decontaminate, op11_jaccard_join, op12_conversation_trie,
        op13_whitening)}
