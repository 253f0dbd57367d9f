"""Latest row or group per key, best match per key, and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order`` (give a total one); planned with a limit within the window, so each
    task keeps one row per key before the shuffle."""
    return df.withColumn("__nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__nth = 1").drop("__nth")


def latest_group(df: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """All rows that share the key's largest value; where a key has nulls only, all of them."""
    return df.withColumn("__rank", F.dense_rank().over(W.partitionBy(*keys).orderBy(by.desc_nulls_last()))).where("__rank = 1").drop("__rank")


def filing_order(year: Column, period: str, ingested: str) -> list[Column]:
    """Newest filing first: tax year as a number, then period end and ingest time as text, nulls last."""
    return [year.desc_nulls_last(), F.col(period).desc_nulls_last(), F.col(ingested).desc_nulls_last()]


def best_match(pairs: DataFrame, key: str, name: str = "name_score", address: str = "addr_score", tie: str = "ein") -> DataFrame:
    """Of each key's candidates that with the largest ``2 * name + address``, then name, then the smallest ``tie``;
    scores are told apart to nine places."""
    total = 2 * F.col(name) + F.col(address)
    return latest_per_key(pairs, [key], [F.round(total, 9).desc(), F.round(name, 9).desc(), F.col(tie).asc()])


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raises ``ValueError`` where a key is null or repeats."""
    bad = df.groupBy(*keys).count().where(" or ".join(["count > 1", *[f"`{k}` is null" for k in keys]]))
    found = bad.limit(1).collect()
    if found:
        raise ValueError(f"not a key: {found[0].asDict()}")
