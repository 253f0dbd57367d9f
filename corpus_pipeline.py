"""From raw documents to token shards: the stages run one after another, each on all that the one before kept.

A document's text is shuffled once, by the last stage, which orders it by id; all stages before work where it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm import decontaminate, mixing, simhash, toxicity, wavelet
from grantlake.llm.common import discard, materialise, table
from grantlake.llm.registry import tokenizer_path

#: Shares that the domains shall have of the mixture's expected tokens. No rate is below ``LEAST_RATE``: nothing is
#: thrown away, documents are repeated, as few as reach the shares and at most to ``MOST_TOTAL`` times all tokens.
MIXTURE = {"good": 0.90, "poor": 0.10}
LEAST_RATE, MOST_TOTAL = 1.0, 2.0


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the toxicity grammar scores 0.5 or more. The model is learned from the labels that are not held
    out. Null and empty texts match no clause and stay unless most labelled rows are toxic; repeated rows stay or go
    together; other columns, of any name, are carried along; an empty table gives an empty one."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of fingerprints, that with the smallest id. Blank texts (null ones too) are
    one component; rows without an id stay; an empty table gives an empty one."""
    return simhash.near_dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of test items out of texts, and leaves out documents that are hardly anything else. Null and empty
    texts and rows without a hit stay as they are; repeated rows are cut alike; an empty benchmark cuts nothing."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the domains' expected tokens have the shares of ``MIXTURE``. Rows of equal text and id
    are repeated alike; null texts count as one blank token; an empty table gives an empty one."""
    label = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    mixture, _, path = mixing.fit(docs, table(spark, sf_dir, "labels"), MIXTURE, label=label, total=None, most_total=MOST_TOTAL, min_rate=LEAST_RATE)
    discard(spark, path)
    return mixing.remix(docs, mixture)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents' token ids as wavelet shards and returns what their files say of each row. Null texts are
    empty ones; repeated rows are documents of their own; an empty table writes no file."""
    return wavelet.encode_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", remove_benchmark),
    ("mixing to target weights", mix_sources),
    ("token-ID output", token_shards),
]

#: No SQL: the first stage learns a model, and the second follows links of any length over 64-bit fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written to the shared folder and read by the next one."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, path = materialise(docs, "stage")
            if before:
                discard(spark, before)
            before = path
    return docs
