"""Fingerprints by improved consistent weighted sampling, from built-in functions only.

A document's terms are its lower-cased words, weighted by how often they occur. For sample ``k`` each term draws, from
hashes of the term and ``k`` alone, two Gamma(2, 1) variates ``r`` and ``c`` and a uniform ``b``; with weight ``w``,
``t = floor(ln w / r + b)`` and ``ln a = ln c - r (t - b) - r``. The term with the least ``a`` is the sample and
contributes a hash of ``(term, t)``. Two documents agree on a sample with a probability that equals their generalised
Jaccard similarity, the sum of the terms' smaller weights over the sum of the larger ones.

A sample is kept as one long, ``ln a`` in fixed point above the hash, so that the least one is a plain ``min`` over
longs within compiled code. What a term draws does not depend on its weight: the draws of a row serve the counts of
both the text and its edited form. ``ln c`` comes from a table of quantiles, which takes a third of the time of two
logarithms; its steps are smoothed by ``r`` and ``b``, which are continuous.
"""

from __future__ import annotations

from functools import cache
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLES = 80
GROUP = 4
BREAKS = r"[\s.,;:!?\"()]+"
HASH_BITS = 24
LEVELS = 1024
_SCALE = float(1 << 30)
_BLANK = (1 << 62) - 1  # a document without words: more than any sample
_MASK = (1 << HASH_BITS) - 1


def terms(text: Column) -> Column:
    """Array of words; a text without words gives blanks only."""
    return F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS)


@cache
def log_quantiles() -> tuple[float, ...]:
    """Logarithms of Gamma(2, 1) quantiles at the middles of ``LEVELS`` equal steps, then those of as many equal steps
    of the first step, where the logarithm falls without bound."""

    def quantile(p: float) -> float:
        low, high = 0.0, 60.0
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if 1 - (1 + mid) * exp(-mid) < p else (low, mid)
        return (low + high) / 2

    return tuple(log(quantile((i + 0.5) / n)) for n in (LEVELS, LEVELS * LEVELS) for i in range(LEVELS))


def _draws(term: str, first: str) -> list[list[Column]]:
    """What a term draws for samples ``first`` to ``first + GROUP - 1``, as columns ``__s``, ``__b``, ``__r``, ``__c``;
    in three steps, so that each is computed once."""
    js = range(GROUP)
    low, unit = F.lit((1 << 32) - 1), F.lit(2.0**-64)
    product = lambda x: (x.bitwiseAND(low).cast("double") + 0.5) * (F.shiftrightunsigned(x, 32).cast("double") + 0.5) * unit
    table, bits = F.array(*[F.lit(q) for q in log_quantiles()]), LEVELS.bit_length() - 1

    def quantile(x: Column) -> Column:
        at, finer = F.shiftrightunsigned(x, 64 - bits), F.shiftrightunsigned(x, 64 - 2 * bits)
        return F.get(table, F.when(at > 0, at).otherwise(finer + LEVELS).cast("int"))

    return [
        [F.xxhash64(F.col(first) + j, term).alias(f"__s{j}") for j in js],
        [F.xxhash64(f"__s{j}").alias(f"__x{j}") for j in js],
        [
            x
            for j in js
            for x in (
                (F.shiftrightunsigned(f"__s{j}", 11).cast("double") * F.lit(2.0**-53)).alias(f"__b{j}"),
                (-F.ln(product(F.col(f"__x{j}")))).alias(f"__r{j}"),
                quantile(F.xxhash64(f"__x{j}")).alias(f"__c{j}"),
            )
        ],
    ]


def _packed(j: int, log_weight: Column) -> Column:
    """Sample of a term with the natural logarithm of its weight. ``r`` is below 46 and ``ln c`` between -8 and 3, so
    that ``ln a + 128`` is positive and its fixed point has 38 bits at most; the hash of the term's draw is told apart
    by ``t`` in its low bits."""
    s, b, r, c = (F.col(f"__{x}{j}") for x in "sbrc")
    t = F.floor(log_weight / r + b)
    log_a = c - r * (t.cast("double") - b + 1.0)
    fixed = ((log_a + 128.0) * F.lit(_SCALE)).cast("bigint")
    return F.shiftleft(fixed, HASH_BITS).bitwiseOR(s.bitwiseXOR(t).bitwiseAND(F.lit(_MASK)))


def signature(rows: DataFrame, keys: list[str], term: str, weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """Of rows with one term each (a 64-bit hash; null: a blank) and one or more weights: for each value of ``keys``
    and each weight ``w`` an array ``sig_w`` of ``samples`` longs, its entries being the hashes of the samples, -1 for
    a document without words. Rows of a term within ``keys`` must have been summed up before.

    A row is repeated for each group of ``GROUP`` samples: an aggregate over many more would be too long a method for
    the JVM to compile. If rows already lie together by some of ``keys``, nothing is shuffled.
    """
    if samples % GROUP:
        raise ValueError(f"samples must be a multiple of {GROUP}")
    logs = [F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))).alias(f"__ln_{w}") for w in weights]
    drawn = rows.select(*keys, term, *logs, F.explode(F.array(*[F.lit(g * GROUP) for g in range(samples // GROUP)])).alias("__g"))
    for step in _draws(term, "__g"):
        drawn = drawn.select("*", *step)
    value = lambda j, w: F.when(F.col(f"__ln_{w}").isNull(), F.lit(None)).when(F.col(term).isNull(), F.lit(_BLANK)).otherwise(_packed(j, F.col(f"__ln_{w}")))
    mins = [F.min(value(j, w)).alias(f"__{w}_{j}") for w in weights for j in range(GROUP)]
    found = drawn.groupBy(*keys, "__g").agg(*mins)
    entry = lambda c: F.when(F.col(c) == _BLANK, F.lit(-1)).otherwise(F.col(c).bitwiseAND(F.lit(_MASK))).cast("bigint")
    part = F.struct("__g", *[F.array(*[entry(f"__{w}_{j}") for j in range(GROUP)]).alias(w) for w in weights])
    parts = found.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("__p"))  # samples / GROUP entries each
    return parts.select(*keys, *[F.flatten(F.col("__p")[w]).alias(f"sig_{w}") for w in weights])


def likeness(a: Column, b: Column) -> Column:
    """Share of samples on which two signatures agree: an estimate of the generalised Jaccard similarity."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def as_text(sig: Column) -> Column:
    """Six hexadecimal digits per sample; a document without words is all ``ffffff``."""
    digits, top = HASH_BITS // 4, F.lit(1 << HASH_BITS)
    return F.lower(F.array_join(F.transform(sig, lambda x: F.substring(F.hex(x.bitwiseAND(F.lit(_MASK)).bitwiseOR(top)), 2, digits)), ""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, samples: int = SAMPLES) -> DataFrame:
    """``(id_col, signature array<bigint>)``: one row per id. Rows that repeat an id are one document, their words
    taken together; null ids likewise. Null and empty texts have an all -1 signature. Other columns are not read."""
    rows = docs.select(F.col(id_col).alias("id"), F.explode(terms(F.col(text_col))).alias("w"))
    rows = rows.select("id", F.when(F.col("w") != "", F.xxhash64("w")).alias("term")).groupBy("id", "term").agg(F.count("*").alias("n"))
    found = signature(rows, ["id"], "term", ["n"], samples)
    return found.select(F.col("id").alias(id_col), F.col("sig_n").alias("signature"))


def _ranges(docs: DataFrame, id_col: str, rows_each: int, most: int = 100_000) -> list[int]:
    """Smallest ids of runs of about ``rows_each`` documents, each an id that exists (at most ``most`` of them)."""
    n = docs.select(id_col).count()
    pieces = max(1, min(most, n // rows_each))
    shares = [i / pieces for i in range(pieces)]
    got = docs.agg(F.percentile_approx(id_col, shares, 4 * max(pieces, 250)).alias("q"), F.min(id_col).alias("m")).first()
    return sorted({got.m, *(got.q or [])}) if got.m is not None else []


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value, by binary search."""
    array, n = F.array(*[F.lit(b).cast("bigint") for b in bounds]), F.lit(len(bounds))
    reaches = F.array(*[F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)])

    def halve(low: Column, reach: Column) -> Column:
        at = low + reach
        return F.when((at <= n) & (F.element_at(array, F.least(at, n)) <= value), at).otherwise(low)

    return F.aggregate(reaches, F.lit(0), halve)

def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, samples: int = SAMPLES, rows_each: int = 500) -> DataFrame:
    """Fingerprints each text and its edited text: the last ``floor(n / 2)`` of its ``n`` code points replaced by the
    first as many (or all) of the next document's, in ascending id order, the first one's following the last.

    Returns ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, a row for
    each document. Null texts are empty; null ids come first; of equal ids the one with the smaller hash of the text
    comes first. A single document is its own next one. Other columns are not read. An empty table gives an empty
    result.

    Documents are dealt once, by runs of their ids of which the bounds come from approximate quantiles, and each run
    also gets a copy of the next run's first id; words are counted and samples drawn where a run lies. Only what has a
    row per document is shuffled again, to bring fingerprints and digests together.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = _ranges(rows, "id", rows_each)
    least = rows.where("id is null").limit(1).count()
    runs = len(bounds)
    # Run 0 holds ids below the second bound, null ids too; the wrap-around copies are of the first id, or of null ids.
    run = F.greatest(_place(F.col("id"), bounds) - 1, F.lit(0)) if runs else F.lit(0)
    run = F.when(F.col("id").isNull(), F.lit(0)).otherwise(run)
    begins = F.col("id").isNull() if least else F.col("id") == F.lit(bounds[0] if bounds else 0)
    starts = F.col("id").isin(bounds[1:]) if runs > 1 else F.lit(False)
    copies = F.array_compact(F.array(
        F.struct(F.lit(0).alias("copy"), F.col("run").alias("run")),
        F.when(F.coalesce(starts, F.lit(False)), F.struct(F.lit(1).alias("copy"), (F.col("run") - 1).alias("run"))),
        F.when(F.coalesce(begins, F.lit(False)), F.struct(F.lit(2).alias("copy"), F.lit(max(runs - 1, 0)).alias("run"))),
    ))
    dealt = rows.withColumn("run", run.cast("int")).withColumn("at", F.explode(copies)).select("id", "text", F.col("at.copy").alias("copy"), F.col("at.run").cast("int").alias("run"), F.xxhash64("text").alias("h"))
    # What starts the next run is behind all of this one.
    line = W.partitionBy("run").orderBy(F.col("copy") == 2, F.col("id").asc_nulls_first(), "copy", "h")
    laid = dealt.select("run", "id", "copy", "text", F.row_number().over(line).alias("nth"), F.lead("text", 1, "").over(line).alias("following"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    laid = laid.select("run", "nth", "id", "copy", "text", n.cast("bigint").alias("n_chars"), F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("following"), F.lit(1), half)).alias("edited"))

    both = laid.select("run", "nth", F.explode(F.array(F.struct(F.lit(1).alias("own"), F.col("text").alias("text")), F.struct(F.lit(0).alias("own"), F.col("edited").alias("text")))).alias("x"))
    words = both.select("run", "nth", "x.own", F.explode(terms(F.col("x.text"))).alias("w")).select("run", "nth", "own", F.when(F.col("w") != "", F.xxhash64("w")).alias("term"))
    counts = words.groupBy("run", "nth", "term").agg(F.sum("own").alias("own"), F.sum(1 - F.col("own")).alias("edited"))
    signed = signature(counts, ["run", "nth"], "term", ["own", "edited"], samples)
    following = F.lead("sig_own").over(W.partitionBy("run").orderBy("nth"))
    signed = signed.select("run", "nth", "sig_own", "sig_edited", following.alias("sig_next"))
    signed = signed.select("run", "nth", as_text(F.col("sig_own")).alias("fingerprint"), as_text(F.col("sig_edited")).alias("edited_fingerprint"), likeness(F.col("sig_own"), F.col("sig_edited")).alias("near_edited"), likeness(F.col("sig_own"), F.col("sig_next")).alias("near_next"))
    facts = laid.where("copy = 0").select("run", "nth", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    out = facts.join(signed, ["run", "nth"])
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
