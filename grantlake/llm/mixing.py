"""Mixing to target weights with soft membership.

A Gaussian naive Bayes classifier, its class moments being one aggregate over the labelled rows, gives each document a
posterior over domains. Rates ``x_i >= min_rate`` then minimise the squared distance between the expected token totals
``sum_i x_i n_i p_ik`` and the targets, by projected gradient steps. Distances are measured in the metric of the
inverse of ``sum_i n_i p_i p_i'`` over the documents whose rate is above its bound, and steps in that of the documents'
token counts: a step then solves the problem where no further bound becomes active, and a rate depends on a document's
posterior only.

A rate after ``s`` steps follows from the ``s`` residuals alone, so the state of the descent is a few numbers on the
driver: each step is one aggregate over a narrow table, and nothing is written between steps.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm.common import discard, materialise
from grantlake.llm.signals import NAMES, with_signals

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.70, "poor": 0.25, "toxic": 0.05}
TEMPER = 0.5  # the features are not independent: log densities count half


def domain(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a labelled row; null where the labels do not tell."""
    return F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 1, "good").when(F.col(quality) == 0, "poor")


def _moments(known: DataFrame, domains: tuple[str, ...]) -> dict[str, tuple[float, list[float], list[float]]]:
    """Of each domain its count, and means and variances of the features: a row per domain comes to the driver."""
    stats = [f(f"f_{n}").alias(f"{f.__name__}_{n}") for n in NAMES for f in (F.avg, F.var_pop)]
    rows = {r.domain: r for r in known.where(F.col("domain").isin(*domains)).groupBy("domain").agg(F.count("*").alias("n"), *stats).collect()}
    return {d: (float(r.n), [r[f"avg_{n}"] for n in NAMES], [max(r[f"var_pop_{n}"], 1e-3) for n in NAMES]) for d, r in rows.items()}


def posteriors(rows: DataFrame, moments: dict, domains: tuple[str, ...]) -> Column:
    """Array of the domains' posteriors; a domain without labelled rows gets 0, without any all get the same."""
    if not moments:
        return F.array(*[F.lit(1.0 / len(domains))] * len(domains))
    total, logs = sum(m[0] for m in moments.values()), []
    for d in domains:
        if d not in moments:
            logs.append(F.lit(-1e9))
            continue
        n, means, variances = moments[d]
        density = sum((-((F.col(f"f_{f}") - m) * (F.col(f"f_{f}") - m)) / (2 * v) for f, m, v in zip(NAMES, means, variances)), F.lit(-0.5 * sum(map(math.log, variances))))
        logs.append(F.lit(math.log(n / total)) + density * TEMPER)
    top = F.greatest(*logs)
    odds = F.array(*[F.exp(F.greatest(x - top, F.lit(-700.0))) for x in logs])
    return F.transform(odds, lambda o: o / F.aggregate(odds, F.lit(0.0), lambda s, x: s + x))


def _solve(matrix: list[list[float]], vector: list[float]) -> list[float]:
    """Gaussian elimination with pivoting and a small ridge; of the size of the domains."""
    n = len(vector)
    ridge = 1e-9 * max(matrix[i][i] for i in range(n)) + 1e-12
    rows = [[*r, v] for r, v in zip([[x + ridge * (i == j) for j, x in enumerate(r)] for i, r in enumerate(matrix)], vector)]
    for i in range(n):
        best = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for k in range(n):
            if k != i:
                f = rows[k][i] / rows[i][i]
                rows[k] = [a - f * b for a, b in zip(rows[k], rows[i])]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def _rate(steps: list[list[float]], min_rate: float) -> Column:
    """A document's rate after the given steps, from 1 (or ``min_rate``, if that is more)."""
    start = F.lit(float(max(1.0, min_rate)))
    if not steps:
        return start
    table = F.array(*[F.array(*[F.lit(v) for v in s]) for s in steps])
    dot = lambda s: F.aggregate(F.zip_with(F.col("p"), s, lambda a, b: a * b), F.lit(0.0), lambda t, y: t + y)
    return F.aggregate(table, start, lambda x, s: F.greatest(F.lit(float(min_rate)), x - dot(s)))


@dataclass(frozen=True)
class Mixture:
    """What the descent has found: it turns any document's text into a posterior and a rate."""

    moments: dict
    domains: tuple[str, ...]
    steps: list[list[float]]
    min_rate: float
    #: Of each domain the tokens that were aimed at and those expected at the rates found.
    reached: dict[str, tuple[float, float]]

    def posterior(self, rows: DataFrame) -> Column:
        return posteriors(rows, self.moments, self.domains)

    def rate(self) -> Column:
        """The rate, from a column ``p`` that has the posterior."""
        return _rate(self.steps, self.min_rate)


def fit(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", *, label: Column | None = None,
    min_rate: float = 0.0, relative: bool = False, total: float | None = 1.0, most_total: float = 2.0, tolerance: float = 1e-4, steps: int = 40,
) -> tuple[Mixture, DataFrame, str]:
    """The mixture, a table ``(id, n_tokens, p)`` with a row for each document, and that table's path.

    ``targets``: share of ``total`` times the tokens at hand for each domain, or with ``relative`` a factor of what the
    domain has at rate 1. If ``total`` is None it is the least one for which rates of ``min_rate`` or more reach the
    shares, but no more than ``most_total``. Unreachable targets (a domain without mass, or one that the classifier cannot tell from
    another) get the totals that are nearest in the steps' metric. The steps end when no domain misses its target by
    more than ``tolerance`` of all tokens, when not even a hundredth of a step brings the totals nearer, or after
    ``steps`` passes; a miss beyond the tolerance is warned of, and ``reached`` has the totals in any case. All labelled rows are used, one of each id; rows without an id or a domain are not. Null texts
    count as one blank token.
    """
    spark, targets = docs.sparkSession, targets or TARGETS
    domains, k = tuple(targets), len(targets)
    rows = with_signals(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text")), "__text").drop("__text")
    rows, signals = materialise(rows, "signals")
    marks = labels.select(F.col(id_col).alias("id"), (domain() if label is None else label).alias("domain")).where("domain is not null and id is not null")
    moments = _moments(rows.join(marks.groupBy("id").agg(F.min("domain").alias("domain")), "id"), domains)
    table, path = materialise(rows.select("id", "n_tokens", posteriors(rows, moments, domains).alias("p")), "posteriors")
    discard(spark, signals)

    entry = lambda i: F.element_at("p", i + 1)
    sums = lambda weight, rate: [F.sum(F.col("n_tokens") * entry(i) * entry(j) * weight).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)] + [F.sum(F.col("n_tokens") * entry(i) * rate).alias(f"t{i}") for i in range(k)]
    first = table.agg(*sums(F.lit(1.0), F.lit(1.0)), F.sum("n_tokens").alias("n")).first()
    n, matrix = first.n or 1, lambda r: [[r[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]
    if total is None:
        # The rates a.p with a = total * n * inverse(gram) * shares reach the shares; each entry must be min_rate or more.
        each = _solve(matrix(first), list(targets.values())) if first.n else [1.0]
        total = min(most_total, max(min_rate / (n * x) for x in each)) if min(each) > 0 else most_total
    goal = [t * ((first[f"t{i}"] or 0.0) if relative else n * total) for i, t in enumerate(targets.values())]
    history: list[list[float]] = []  # the steps that made the sum of squared misses smaller
    step, scale, best = None, 1.0, None
    for _ in range(steps):
        at = table.withColumn("x", _rate([*history, step] if step else [], min_rate)).agg(*sums((F.col("x") > min_rate).cast("double"), F.col("x"))).first()
        now = [at[f"t{i}"] or 0.0 for i in range(k)]
        squared = sum((a - g) ** 2 for a, g in zip(now, goal))
        if best is None or squared < 0.998 * best[0]:
            # What is at its bound does not answer a step; a little of all documents keeps the metric from vanishing.
            free = [[0.95 * x + 0.05 * y for x, y in zip(*rows)] for rows in zip(matrix(at), matrix(first))]
            best, scale = (squared, now, [a - g for a, g in zip(now, goal)], free), min(1.0, 2 * scale)
            history = [*history, step] if step else history
        else:
            scale /= 4
        if max(map(abs, best[2])) <= tolerance * n or scale < 0.01:
            break
        step = [scale * x for x in _solve(best[3], best[2])]
    _, now, miss, _ = best
    if first.n and max(map(abs, miss)) > tolerance * n:
        warnings.warn(f"targets missed after {len(history)} steps, in shares of all tokens: " + ", ".join(f"{d} {m / n:+.4f}" for d, m in zip(domains, miss)), stacklevel=2)
    return Mixture(moments, domains, history, min_rate, dict(zip(domains, zip(goal, now)))), table, path


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id_col, n_tokens bigint, posteriors map<string,double>, rate double)``, a row for each document; see
    :func:`fit` for targets and options. Repeated rows stay. An empty table gives an empty result."""
    mixture, table, _ = fit(docs, labels, targets, id_col, text_col, **options)
    named = F.map_from_arrays(F.array(*[F.lit(d) for d in mixture.domains]), F.col("p"))
    return table.select(F.col("id").alias(id_col), "n_tokens", named.alias("posteriors"), mixture.rate().alias("rate"))


def _repeated(rows: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Of ``(row, rate)`` each row as often as the whole part of the rate, and once more with a probability of the
    rest, decided by a hash of the id. Step by step, and without a condition on the number that the optimizer would move
    below the steps, spelling them out wherever they are named."""
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col(f"row.`{id_col}`")), 11).cast("double") * F.lit(2.0**-53)
    rows = rows.select("row", "rate", chance.alias("chance"))
    rows = rows.select("row", (F.floor("rate") + (F.col("chance") < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("n"))
    rows = rows.select("row", F.explode_outer(F.array_repeat(F.lit(1), F.col("n"))).alias("one")).where("one is not null")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def remix(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document as often as its rate says, columns as in ``docs``. A rate follows from the text alone, so it is
    worked out where the text is read, and nothing is joined or shuffled. Null texts count as empty; null ids share one
    draw; an empty table gives an empty result."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("__text"))
    rows = with_signals(rows, "__text")
    rows = rows.select("row", mixture.posterior(rows).alias("p")).select("row", mixture.rate().alias("rate"))
    return _repeated(rows, docs.columns, id_col)


def resample(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each document as often as a table of rates by id says, see :func:`remix`, which needs no join. Columns are those
    of ``docs``. Rows of one id (null ids too) share their least rate; ids without a rate are left out."""
    rates = mixed.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.min("rate").alias("rate"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.join(rates, F.col(f"row.`{id_col}`").eqNullSafe(F.col("id"))).select("row", "rate")
    return _repeated(found, docs.columns, id_col)
