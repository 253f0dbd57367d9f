"""Quality by hierarchical empirical Bayes.

Evidence of a document is the probability that a logistic classifier of its text's shape gives. Paths and hosts pool
the evidence of their documents: a host's mean is shrunk toward the global one and a path's toward its host's, each
by a strength that the method of moments finds from how much more the groups' means differ than chance explains. A
document's own evidence is left out of its path's and host's means, so that nothing counts twice. The score adds the
document's log odds and what its path's posterior says beyond the global prior.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm.common import materialise
from grantlake.llm.signals import NAMES, with_signals

MAX_LABELLED = 20_000


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _basis(x: np.ndarray) -> np.ndarray:
    """Features, their squares and products."""
    return np.column_stack([x, *[x[:, i] * x[:, j] for i in range(x.shape[1]) for j in range(i, x.shape[1])], np.ones(len(x))])


def fit(known: DataFrame, label: str = "quality", most: int = MAX_LABELLED) -> tuple[list[float], list[float], list[float]]:
    """Means, scales and coefficients of a ridge logistic regression on at most ``most`` labelled rows (those with the
    smallest hash of the id), which are a few numbers each. Without both labels it always gives their mean or 1/2."""
    rows = known.where(F.col(label).isNotNull()).orderBy(F.xxhash64("id"), "id").limit(most).select(*[f"f_{n}" for n in NAMES], label).collect()
    y = np.array([int(r[label] == 1) for r in rows])
    size = _basis(np.zeros((1, len(NAMES)))).shape[1]
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return [0.0] * len(NAMES), [1.0] * len(NAMES), [0.0] * (size - 1) + [float(np.log(share / (1 - share)))]
    raw = np.array([[r[f"f_{n}"] for n in NAMES] for r in rows])
    means, scales = raw.mean(axis=0), raw.std(axis=0) + 1e-6
    x = _basis(np.clip((raw - means) / scales, -6, 6))
    ridge, beta = np.diag([1.0] * (size - 1) + [1e-6]), np.zeros(size)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return means.tolist(), scales.tolist(), beta.tolist()


def evidence(model: tuple[list[float], list[float], list[float]]) -> Column:
    """Log odds of a document by the classifier, bounded to 12 either way."""
    means, scales, beta = model
    x = [F.greatest(F.least((F.col(f"f_{n}") - m) / s, F.lit(6.0)), F.lit(-6.0)) for n, m, s in zip(NAMES, means, scales)]
    terms = [*x, *[x[i] * x[j] for i in range(len(x)) for j in range(i, len(x))], F.lit(1.0)]
    return F.greatest(F.least(sum((t * b for t, b in zip(terms, beta)), F.lit(0.0)), F.lit(12.0)), F.lit(-12.0))


def _strength(groups: DataFrame, spread: float) -> float:
    """Pseudo-count of the prior: variance within groups over the variance between them, from one row of sums."""
    r = groups.where("n > 1").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("s") / F.col("n") * F.col("s")).alias("q"), F.sum("s").alias("s"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not r.k or r.k < 2:
        return 1e6
    about = r.q - r.s * r.s / r.n  # sum of squares between groups
    between = (about - (r.k - 1) * spread) / (r.n - r.nn / r.n)
    return float(min(1e6, spread / between)) if between > 0 else 1e6


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", *, label: str = "quality", most: int = MAX_LABELLED, keep_above: float = 0.5) -> DataFrame:
    """``(id_col, held_out, doc_score, host_posterior, path_posterior, score double, keep boolean)``, a row each.

    ``host`` and ``path`` are columns of ``docs``; null is a group of its own. Only labels of rows that are not held
    out (crc32 of the id) are learned from. A lone document's path has its host's posterior, a lone host the global
    prior. Null texts are empty ones. Groups are summed before they are shuffled; what joins back has a row per path.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    rows, _ = materialise(with_signals(rows, "__text").drop("__text"), "quality")
    marks = labels.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("quality"))
    model = fit(rows.join(marks, "id"), "quality", most)
    odds = evidence(model)
    rows, _ = materialise(rows.select("id", "host", "path", odds.alias("z")).withColumn("p", 1 / (1 + F.exp(-F.col("z")))), "evidence")
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss"))
    paths, _ = materialise(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    all_ = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.count("*").alias("k")).first()
    prior = min(max(all_.s / all_.n, 1e-4), 1 - 1e-4) if all_.n else 0.5
    spread = max(all_.within / max(1, all_.n - all_.k), 1e-9) if all_.n else 1.0
    of_host, of_path = _strength(hosts, spread), _strength(paths, spread)
    sites = paths.select("host", "path", F.col("n").alias("pn"), F.col("s").alias("ps")).join(hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs")), "host")
    found = rows.join(sites, ["host", "path"])
    host_mean = (F.col("hs") - F.col("p") + of_host * prior) / (F.col("hn") - 1 + of_host)
    found = found.withColumn("host_posterior", host_mean)
    found = found.withColumn("path_posterior", (F.col("ps") - F.col("p") + of_path * F.col("host_posterior")) / (F.col("pn") - 1 + of_path))
    clipped = F.greatest(F.least("path_posterior", F.lit(1 - 1e-4)), F.lit(1e-4))
    total = F.col("z") + F.ln(clipped / (1 - clipped)) - F.lit(float(np.log(prior / (1 - prior))))
    found = found.withColumn("score", 1 / (1 + F.exp(-total)))
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), F.col("p").alias("doc_score"), "host_posterior", "path_posterior", "score", (F.col("score") >= keep_above).alias("keep"))
