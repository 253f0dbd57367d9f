"""Checks after an ingest, in one aggregate over the new table."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.sources.registry import LINEAGE

LEAST_FILLED, LOW, HIGH = 0.99, 0.80, 2.00


@dataclass(frozen=True)
class Check:
    name: str
    status: str  # pass, warn or fail
    detail: str


class ValidationError(RuntimeError):
    def __init__(self, checks: list[Check]) -> None:
        super().__init__("; ".join(f"{c.name}: {c.detail}" for c in checks if c.status == "fail"))
        self.checks = checks


def measures(df: DataFrame, required: tuple[str, ...], lineage: tuple[str, ...] = LINEAGE) -> DataFrame:
    """One row: number of rows, of rows without some lineage value, and of filled values per required column."""
    there = [c for c in lineage if c in df.columns]
    missing = F.lit(False)
    for c in there:
        missing = missing | F.col(c).isNull()
    return df.agg(F.count("*").alias("n"), F.count_if(missing).alias("no_lineage"), *[F.count(c).alias(f"filled_{c}") for c in required if c in df.columns])


def validate(df: DataFrame, required: tuple[str, ...], prior_columns: list[str] | None = None, prior_rows: int | None = None, *, lineage: tuple[str, ...] = LINEAGE, raise_on_fail: bool = True) -> list[Check]:
    """All results; with ``raise_on_fail`` one error that carries them, if any check failed."""
    m, out = measures(df, required, lineage).first(), []
    out.append(Check("row_count_positive", "pass" if m.n > 0 else "fail", f"{m.n} rows"))
    absent = [c for c in lineage if c not in df.columns]
    bad = bool(absent) or m.no_lineage > 0
    out.append(Check("lineage_columns", "fail" if bad else "pass", f"absent: {absent}, rows with a null: {m.no_lineage}"))
    gone = [c for c in required if c not in df.columns]
    thin = [c for c in required if c not in gone and m.n and m[f"filled_{c}"] / m.n < LEAST_FILLED]
    out.append(Check("required_columns", "fail" if gone or thin else "pass", f"absent: {gone}, below {LEAST_FILLED}: {thin}"))
    now = {c for c in df.columns if c not in lineage}
    removed, added = (sorted(set(prior_columns) - now), sorted(now - set(prior_columns))) if prior_columns is not None else ([], [])
    out.append(Check("schema_drift", "fail" if removed else "warn" if added else "pass", f"removed: {removed}, added: {added}"))
    ratio = m.n / prior_rows if prior_rows else None
    out.append(Check("row_count_delta", "pass" if ratio is None or LOW <= ratio <= HIGH else "warn", f"ratio: {ratio}"))
    if raise_on_fail and any(c.status == "fail" for c in out):
        raise ValidationError(out)
    return out


def as_rows(checks: list[Check]) -> list[dict]:
    return [asdict(c) for c in checks]
