"""Grant analytics over the unioned grants: rows, totals, groups, pages, summaries, eligibility."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.scalars import any_ilike, round_away

ROLES = {"granter": "granter_ein", "grantee": "grantee_ein"}
#: Where the payer's and the payee's names are.
NAMES = {"granter": ("granter_name", "granter_name2"), "grantee": ("grantee_organization_name1", "grantee_organization_name2", "grantee_person_name")}
SORTS = {"taxyear", "grant_amount", "name"}


def union_grants(matched: DataFrame, schedule: DataFrame) -> DataFrame:
    """Set union: rows that are equal in every column (nulls too) count once."""
    return matched.unionByName(schedule).distinct()


def with_granter_name(grants: DataFrame, nonprofits: DataFrame, funders: DataFrame) -> DataFrame:
    """Adds ``resolved_granter_name``: by the identity table of the form that the grant comes from (a file hash marks
    the private-foundation form), then by the other one, then as the grant itself has it."""
    n = nonprofits.select(F.col("ein").alias("granter_ein"), F.col("name").alias("__n"))
    f = funders.select(F.col("ein").alias("granter_ein"), F.col("name").alias("__f"))
    own = F.when(F.col("filesha256").isNotNull(), F.col("__f")).otherwise(F.col("__n"))
    name = F.coalesce(own, "__f", "__n", "granter_name")
    return grants.join(n, "granter_ein", "left").join(f, "granter_ein", "left").withColumn("resolved_granter_name", name).drop("__n", "__f")


def for_eins(grants: DataFrame, eins: list[str], role: str, min_taxyear: int | None = None) -> DataFrame:
    """Rows of the organisations in a role; an unknown role raises, no EINs give no rows."""
    if role not in ROLES:
        raise ValueError(f"role must be one of {sorted(ROLES)}")
    out = grants.where(F.col(ROLES[role]).isin(list(eins)) if eins else F.lit(False))
    return out.where(F.col("taxyear") >= min_taxyear) if min_taxyear is not None else out


def summaries(grants: DataFrame, role: str) -> DataFrame:
    """Per organisation and year: sum as double, count, sorted distinct EINs and names of the payers."""
    return (
        grants.groupBy(F.col(ROLES[role]).alias("ein"), "taxyear")
        .agg(
            F.coalesce(F.sum("grant_amount"), F.lit(0)).cast("double").alias("total_grant_amount"),
            F.count("*").alias("grant_count"),
            F.array_sort(F.collect_set("granter_ein")).alias("granter_eins"),
            F.array_sort(F.collect_set("resolved_granter_name")).alias("granter_names"),
        )
    )


def summaries_named(grants: DataFrame, nonprofits: DataFrame, funders: DataFrame, role: str) -> DataFrame:
    """:func:`summaries` of grants whose payers have no names yet: summed up per payer first, so that names are looked
    up once for each payer of a group and not for each grant."""
    key = [F.col(ROLES[role]).alias("ein"), F.col("taxyear"), F.col("granter_ein"), F.col("granter_name"), F.when(F.col("filesha256").isNotNull(), "x").alias("filesha256")]
    per = grants.groupBy(*key).agg(F.sum("grant_amount").alias("part_sum"), F.count("*").alias("part_n"))
    return (
        with_granter_name(per, nonprofits, funders).groupBy("ein", "taxyear")
        .agg(
            F.coalesce(F.sum("part_sum"), F.lit(0)).cast("double").alias("total_grant_amount"),
            F.sum("part_n").alias("grant_count"),
            F.array_sort(F.collect_set("granter_ein")).alias("granter_eins"),
            F.array_sort(F.collect_set("resolved_granter_name")).alias("granter_names"),
        )
    )


@dataclass(frozen=True)
class GrantFilter:
    """What a listing may be narrowed by; unset fields do not narrow."""

    search: str | None = None
    year: int | None = None
    min_year: int | None = None
    max_year: int | None = None
    min_amount: float | None = None
    max_amount: float | None = None
    entity_ein: str | None = None
    sort: str = "taxyear"
    ascending: bool = False

    def condition(self, other: str) -> Column:
        out = F.lit(True)
        if self.search:
            out &= any_ilike(self.search, *[F.col(c) for c in NAMES[other]], F.col("grant_purpose"))
        for value, test in ((self.year, F.col("taxyear").__eq__), (self.min_year, F.col("taxyear").__ge__), (self.max_year, F.col("taxyear").__le__), (self.min_amount, F.col("grant_amount").__ge__), (self.max_amount, F.col("grant_amount").__le__)):
            if value is not None:
                out &= test(value)
        if self.entity_ein:
            out &= F.col(ROLES[other]) == self.entity_ein
        return out

    def order(self, other: str) -> list[Column]:
        """The chosen column, then year and amount unless chosen; descending ones have nulls first, ascending last."""
        column = {"name": NAMES[other][0]}.get(self.sort, self.sort if self.sort in SORTS else "taxyear")
        first = F.col(column).asc_nulls_last() if self.ascending else F.col(column).desc_nulls_first()
        return [first, *[F.col(c).desc_nulls_first() for c in ("taxyear", "grant_amount") if c != column]]


def _other(role: str) -> str:
    return "grantee" if role == "granter" else "granter"


def page_of(grants: DataFrame, role: str, ein: str, page: int, limit: int, by: GrantFilter = GrantFilter(), tie: list[str] = ()) -> DataFrame:
    rows = for_eins(grants, [ein], role).where(by.condition(_other(role)))
    return rows.orderBy(*by.order(_other(role)), *tie).offset((page - 1) * limit).limit(limit)


def totals(grants: DataFrame, role: str, ein: str, by: GrantFilter = GrantFilter()) -> DataFrame:
    rows = for_eins(grants, [ein], role).where(by.condition(_other(role)))
    return rows.agg(F.count("*").alias("total_count"), F.coalesce(F.sum("grant_amount"), F.lit(0)).cast("bigint").alias("total_amount"), F.coalesce(round_away(F.avg("grant_amount")), F.lit(0).cast("bigint")).alias("avg_amount"))



def _sums() -> list[Column]:
    return [F.count("*").alias("grant_count"), F.coalesce(F.sum("grant_amount"), F.lit(0)).cast("bigint").alias("total_amount"), F.coalesce(round_away(F.avg("grant_amount")), F.lit(0).cast("bigint")).alias("avg_amount")]


def grouped_by_year(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("taxyear").cast("string").alias("group_key")).agg(*_sums())


def entity_key(other: str) -> Column:
    """An organisation's EIN whatever its spelling; without an EIN the name."""
    return F.coalesce(F.col(ROLES[other]), F.concat(F.lit("__name:"), F.coalesce(F.col(NAMES[other][0]), F.lit(""))))


def grouped_by_entity(rows: DataFrame, other: str, nonprofits: DataFrame, funders: DataFrame) -> DataFrame:
    """Groups first, names after: identity tables, then the most frequent spelling (the smallest on ties). Spellings are
    counted before they are compared, so that no task holds all spellings of a group."""
    per = rows.groupBy(entity_key(other).alias("group_key"), F.col(ROLES[other]).alias("group_ein"), F.col(NAMES[other][0]).alias("__name"))
    per = per.agg(F.count("*").alias("__n"), F.sum("grant_amount").alias("__sum"), F.count("grant_amount").alias("__filled"))
    spelled = F.min(F.when(F.col("__name").isNotNull(), F.struct(-F.col("__n"), F.col("__name"))))["__name"]
    total = F.coalesce(F.sum("__sum"), F.lit(0)).cast("bigint")
    mean = F.sum("__sum").cast("double") / F.nullif(F.sum("__filled"), F.lit(0))
    out = per.groupBy("group_key", "group_ein").agg(F.sum("__n").alias("grant_count"), total.alias("total_amount"), F.coalesce(round_away(mean), F.lit(0).cast("bigint")).alias("avg_amount"), spelled.alias("__mode"))
    n = nonprofits.select(F.col("ein").alias("group_ein"), F.col("name").alias("__n"))
    f = funders.select(F.col("ein").alias("group_ein"), F.col("name").alias("__f"))
    label = F.coalesce("__n", "__f", "__mode", F.lit("Unknown"))
    return out.join(n, "group_ein", "left").join(f, "group_ein", "left").withColumn("label", label).drop("__n", "__f", "__mode")


def group_page(groups: DataFrame, by_year: bool, page: int, limit: int) -> DataFrame:
    """A page of groups: years from the latest (without a year first), entities from the largest total, key on ties."""
    order = [F.col("group_key").try_cast("int").desc_nulls_first()] if by_year else [F.col("total_amount").desc(), F.col("group_key").asc_nulls_last()]
    return groups.orderBy(*order).offset((page - 1) * limit).limit(limit)


def expand_group(grants: DataFrame, role: str, ein: str, group_key: str | None, by_year: bool, limit: int = 100, by: GrantFilter = GrantFilter(), tie: list[str] = ()) -> DataFrame:
    """The grants of one group of a listing, name-only groups too, in the listing's order."""
    other = _other(role)
    key = F.col("taxyear").cast("string") if by_year else entity_key(other)
    rows = for_eins(grants, [ein], role).where(by.condition(other)).where(key.eqNullSafe(F.lit(group_key)))
    return rows.orderBy(*by.order(other), *tie).limit(limit)


def number_of_groups(rows: DataFrame, key: Column) -> DataFrame:
    """A null key forms a group but is not counted."""
    return rows.agg(F.count_distinct(key).alias("total_groups"))


def min_avg(rows: DataFrame, ein: str, year: str, amount: Column, least: float) -> DataFrame:
    """Organisations whose mean of yearly sums reaches ``least``; years without any amount do not count."""
    years = rows.groupBy(F.col(ein).alias("ein"), F.col(year).alias("year")).agg(F.sum(amount).alias("total"))
    return years.groupBy("ein").agg(F.avg("total").alias("avg_amount")).where(F.col("avg_amount") >= least)


def grant_eligible(grants: DataFrame, role: str, min_taxyear: int, min_avg_grants: float | None = None, min_num_grants: int | None = None) -> DataFrame:
    """Organisations by mean of yearly grant sums (empty years count as 0) and by number of grants."""
    years = grants.where(F.col("taxyear") >= min_taxyear).where(F.col(ROLES[role]).isNotNull()).groupBy(F.col(ROLES[role]).alias("ein"), "taxyear").agg(F.coalesce(F.sum("grant_amount"), F.lit(0)).alias("total"), F.count("*").alias("n"))
    out = years.groupBy("ein").agg(F.avg("total").alias("avg_grants"), F.sum("n").alias("num_grants"))
    if min_avg_grants is not None:
        out = out.where(F.col("avg_grants") >= min_avg_grants)
    return out.where(F.col("num_grants") >= min_num_grants) if min_num_grants is not None else out
