"""One query per operator over the shared tables, with production parameters and whole inputs; SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm import compaction, decontaminate, mixing, pii, quality, simhash, toxicity, warc, wavelet, weighted_sampling
from grantlake.llm.common import scratch, table

#: The key is a parameter of the operator; a run with data that matters passes its own secret one.
PII_KEY = "grantlake"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities")


def op2_consistent_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_likeness(table(spark, sf_dir, "documents"))


def op3_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, labels, F.col("source"), F.col("lang"))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest_of_pages(table(spark, sf_dir, "pages"))


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", F.size("clauses").alias("n_clauses"))


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", *[F.col("posteriors")[d].alias(f"p_{d}") for d in mixing.DOMAINS], "rate")


def op7_size_tiered_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = compaction.compacted(table(spark, sf_dir, "documents"), scratch(spark, "shards"))
    return store.read(shard_col="shard").select("doc_id", F.sha2("text", 256).alias("text_sha256"), "shard")


def op8_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.digests(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_surrogates, op2_consistent_weighted_sampling, op3_hierarchical_quality, op4_warc_transactions, op5_toxicity_grammar,
        op6_soft_mixing, op7_size_tiered_compaction, op8_wavelet_shards, op9_suffix_automaton, op10_simhash_golay,
    )
}

ORACLES: dict[str, str] = {"op4_warc_transactions": warc.ORACLE}
