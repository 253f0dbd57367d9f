"""Grant recipients to organisations: blocking on ZIP, scores, rules, best match, join back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.functions.scalars import clean_address, clean_zip, full_name
from grantlake.operators.linkage import LOOSE, STRICT, Rules, candidates, join_back, match
from grantlake.plans.canonical import KEYS, basic_fields_keyed, private_grants_keyed, unique_names


def _side(unique: DataFrame, side: str, *keep: str) -> DataFrame:
    """Name, address and block of a key tuple. A tuple with a null city, state or ZIP can never join back, so it is
    left out before the block join, and the block of empty ZIPs with it."""
    rows = unique.where(F.col("addresscity_key").isNotNull() & F.col("addressstate_key").isNotNull() & F.col("addresszip_key").isNotNull())
    address = clean_address(*[F.col(c) for c in ("address1_key", "address2_key", "addresscity_key", "addressstate_key")])
    return rows.select(*keep, clean_zip(F.col("addresszip_key")).alias("block"), full_name(F.col("name1_key"), F.col("name2_key")).alias(f"name_{side}"), address.alias(f"addr_{side}"))


def _sides(privategrants: DataFrame, basic_fields: DataFrame, limit: int | None = None, firsts: bool = False) -> tuple[DataFrame, DataFrame]:
    grants, orgs = unique_names(private_grants_keyed(privategrants)), unique_names(basic_fields_keyed(basic_fields), "filerein_key")
    if limit is not None:
        grants, orgs = grants.orderBy(*KEYS).limit(limit), orgs.orderBy("filerein_key", *KEYS).limit(limit)
    orgs = _first_of_equals(orgs) if firsts else orgs
    return _side(grants.withColumn("recipient", F.struct(*KEYS)), "l", "recipient"), _side(orgs, "r", "filerein_key").distinct()


def stage_one(privategrants: DataFrame, basic_fields: DataFrame, rules: Rules = LOOSE) -> DataFrame:
    """All pairs that satisfy the loose rules, to choose thresholds from."""
    left, right = _sides(privategrants, basic_fields)
    return candidates(left, right, "block", "name", "addr", rules)


def _first_of_equals(orgs: DataFrame) -> DataFrame:
    """Of organisations alike in all keys the first, as the best match takes it; before their addresses are cleaned."""
    return orgs.groupBy(*KEYS).agg(F.min("filerein_key").alias("filerein_key"))


def match_recipients(privategrants: DataFrame, basic_fields: DataFrame, rules: Rules = STRICT, limit: int | None = None) -> DataFrame:
    """``recipeint_ein_key`` and the seven keys, one row per key tuple that has a match. A trial's ``limit`` takes the
    first key tuples of either side."""
    left, right = _sides(privategrants, basic_fields, limit, firsts=True)
    best = match(left, right, "block", "name", "addr", "recipient", "filerein_key", rules)
    return best.select(F.col("filerein_key").alias("recipeint_ein_key"), *[F.col(f"recipient.{k}").alias(k) for k in KEYS])


def grants_with_recipients(privategrants: DataFrame, basic_fields: DataFrame, rules: Rules = STRICT, limit: int | None = None) -> DataFrame:
    """Matched grant lines of all years: a year limits what is matched, not what is joined back."""
    return join_back(private_grants_keyed(privategrants), match_recipients(privategrants, basic_fields, rules, limit), KEYS)
