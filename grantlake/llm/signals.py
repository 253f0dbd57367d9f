"""Shape of a text as a few numbers, from built-in functions; no pass over the words leaves compiled code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = ("length", "word", "fresh", "lines", "stops", "commas", "marks", "pipes")


def with_signals(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``n_tokens bigint`` (words between blanks, at least 1) and a double ``f_<name>`` for each of ``NAMES``.
    A null text is an empty one."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def count(*chars: str) -> Column:
        return sum((F.length(body) - F.length(F.replace(body, F.lit(c)))) for c in chars)

    rows = rows.select("*", F.split(F.replace(body, F.lit("\n"), F.lit(" ")), " ").alias("__words"), F.length(body).alias("__n"), count("\n").alias("__l"), count(".").alias("__s"), count(",").alias("__c"), count("#", "%", "$", "&", "*", "!", "?").alias("__m"), count("|", "=", '"').alias("__p"))
    rows = rows.select("*", F.size("__words").cast("bigint").alias("n_tokens"), F.size(F.array_distinct("__words")).alias("__d"))
    share = lambda c: F.log1p(F.col(c) * 100.0 / F.col("n_tokens"))
    return rows.select("*", F.log1p("__n").alias("f_length"), F.log1p(F.col("__n") / F.col("n_tokens")).alias("f_word"), F.log(F.col("__d") / F.col("n_tokens") + 0.01).alias("f_fresh"), share("__l").alias("f_lines"), share("__s").alias("f_stops"), share("__c").alias("f_commas"), share("__m").alias("f_marks"), share("__p").alias("f_pipes")).drop("__words", "__n", "__l", "__s", "__c", "__m", "__p", "__d")
