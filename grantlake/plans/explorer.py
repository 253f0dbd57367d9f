"""Explorer: two-arm search, organisation profiles, foundation activities, missing-grantor diagnostics."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlake.functions.scalars import Clean, any_ilike, is_filled, leading_int, strip, to_int, to_long
from grantlake.functions.textsearch import cover_density, find, matches, websearch

EXACT, BY_NAME = 2e6, 1e6
TYPES, MODES = ("all", "nonprofit", "foundation"), ("both", "name", "narrative")

# The filings' columns of a year's revenue, and what a profile's funding details are called there. The
# private-foundation form has the first two only.
REVENUE = {"nonprofit": "totrevcuryea", "foundation": "areterexpnss"}
DETAILS = {
    "total_revenue": ("totrevcuryea", "anreextoreex"), "total_contributions": ("totacashcont", "arecrrexpnss"), "federated_campaigns": ("federacampai", None), "membership_dues": ("memberduesue", None),
    "fundraising_events": ("fundraevents", None), "related_organizations": ("relateorgani", None), "government_grants": ("governgrants", None), "all_other_contributions": ("alloothecont", None), "non_cash_contributions": ("noncascontri", None),
}
CHARITABLE = [("sudichacdees1", "sudichacexxp1"), ("sudichacdees2", "sudichacexxp2"), ("sudichacdees3", "sudichacexxp3"), ("sudichacdees4", "sudichacexxp4")]
INVESTMENTS = [("suprreindees1", "suprreinammo1"), ("suprreindees2", "suprreinammo2")]
OTHER_INVESTMENTS, ALL_INVESTMENTS = "spriaopritot", "suprreintoot"


def tiered(signals: list[DataFrame]) -> DataFrame:
    """Best rank of each EIN over ``(ein, rank)`` tables."""
    return reduce(lambda a, b: a.unionByName(b), signals).groupBy("ein").agg(F.max("rank").alias("rank"))


def search_arm(canonical: DataFrame, query: str, ein_digits: str | None, org_type: str, fetch: int, *, names: tuple[str, ...], text: DataFrame | None = None, index: DataFrame | None = None, mode: str = "both", only: DataFrame | None = None) -> DataFrame:
    """EIN before name before narrative, which ranks by cover density; ``mode`` is both, name or narrative; ``only``
    restricts to some EINs. With ``index`` narratives are found there, and ``text`` is read for queries of exclusions
    only. Hits without an identity are left out. At most ``fetch`` rows, with the number of all hits in ``total``."""
    signals = []
    if ein_digits and len(ein_digits) == 9:
        signals.append(canonical.where(F.col("ein") == ein_digits).select("ein", F.lit(EXACT).alias("rank")))
    if mode != "narrative":
        signals.append(canonical.where(any_ilike(query, *[F.col(n) for n in names])).select("ein", F.lit(BY_NAME).alias("rank")))
    if text is not None and mode != "name":
        node, docs = websearch(query), text.select("ein", F.col("tokens_english").alias("doc"))
        found = docs.where(matches(F.col("doc"), node)) if index is None else find(index, "ein", node, docs)
        signals.append(found.select("ein", cover_density(node)(F.col("doc")).alias("rank")))
    if not signals:
        signals = [canonical.where("false").select("ein", F.lit(0.0).alias("rank"))]
    hits = tiered(signals)
    if only is not None:
        hits = hits.join(only.select("ein").distinct(), "ein", "left_semi")
    rows = hits.join(canonical, "ein").select("ein", F.col("name").alias("name1"), F.col("name_secondary").alias("name2"), "city", "state", to_int(F.col("latest_taxyear")).alias("last_year"), F.lit(org_type).alias("org_type"), "rank")
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*_order()).limit(fetch).join(F.broadcast(total), how="cross")  # one row: a count


def _order() -> list[Column]:
    return [F.col("rank").desc(), F.coalesce("last_year", F.lit(0)).desc(), F.col("name1").asc_nulls_first(), F.col("ein").asc()]


def merge_arms(arms: list[DataFrame], page: int, limit: int) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), arms).orderBy(*_order()).offset((page - 1) * limit).limit(limit)


def run_search(table: Callable[[str], DataFrame], query: str, org_type: str = "all", page=1, limit=25, mode: str = "both", daf_only: bool = False) -> DataFrame:
    """A page of organisations of both kinds with their first years and the number of all hits. Arguments are cleaned as
    a caller's input: an unknown type, mode, page or limit becomes the default, a blank query finds nothing. Nine digits,
    however they are spaced, are an EIN. ``daf_only`` leaves public charities that ever had a donor fund."""
    query, page, limit = Clean.query(query), Clean.page(page), Clean.limit(limit, 50)
    org_type, mode = Clean.choice(org_type, TYPES), Clean.choice(mode, MODES)
    digits = re.sub("[^0-9]", "", query)
    ein, fetch, arms = digits if len(digits) == 9 else None, page * limit if query else 0, []
    if org_type != "foundation":
        only = table("basic_fields").where(F.col("donoadvifund").isin("1", "true")).select(F.col("filerein").alias("ein")) if daf_only else None
        arms.append(search_arm(table("nonprofit_canonical"), query, ein, "nonprofit", fetch, names=("name", "name_secondary", "dba_1", "dba_2"), text=table("nonprofit_text"), index=table("nonprofit_index_english"), mode=mode, only=only))
    if org_type != "nonprofit" and not daf_only:
        arms.append(search_arm(table("funder_canonical"), query, ein, "foundation", fetch, names=("name", "name_secondary"), mode=mode))
    if not arms:
        arms.append(search_arm(table("funder_canonical").where("false"), query, None, "foundation", 0, names=("name", "name_secondary"), mode=mode))
    # The window's rows are what the arms fetched, so no more than two pages' ends.
    all_rows = Window.partitionBy(F.lit(0))
    of = lambda kind: F.coalesce(F.max(F.when(F.col("org_type") == kind, F.col("total"))).over(all_rows), F.lit(0))
    fetched = reduce(lambda a, b: a.unionByName(b), arms).withColumn("total", of("nonprofit") + of("foundation"))
    hits = merge_arms([fetched], page, limit)
    eins = F.broadcast(hits.select(F.col("ein").alias("filerein")))  # one page at most
    firsts = [first_years(table(t).join(eins, "filerein", "left_semi")).withColumn("org_type", F.lit(k)) for t, k in (("basic_fields", "nonprofit"), ("basic_fields_pf", "foundation"))]
    with_first = hits.join(firsts[0].unionByName(firsts[1]), ["ein", "org_type"], "left").withColumn("first_year", F.coalesce("first_year", "last_year"))
    return with_first.orderBy(*_order())


def first_years(filings: DataFrame, ein: str = "filerein") -> DataFrame:
    return filings.groupBy(F.col(ein).alias("ein")).agg(F.min(to_int(F.col("taxyear"))).alias("first_year"))


def with_first_year(page: DataFrame, firsts: DataFrame) -> DataFrame:
    return page.join(firsts, "ein", "left").withColumn("first_year", F.coalesce("first_year", "last_year"))


def org_rollup(filings: DataFrame, revenue: str, texts: tuple[str, ...]) -> DataFrame:
    """Of each EIN the largest value of each text, its years, summed revenue, and whether it ever had a donor fund."""
    daf = F.bool_or(F.lower(F.col("donoadvifund")).isin("1", "true")) if "donoadvifund" in filings.columns else F.lit(None).cast("boolean")
    return filings.groupBy(F.col("filerein").alias("ein")).agg(*[F.max(c).alias(c) for c in texts], F.min(to_int(F.col("taxyear"))).alias("first_year"), F.max(to_int(F.col("taxyear"))).alias("last_year"), F.sum(to_long(F.col(revenue))).alias("revenue"), daf.alias("has_daf"))


def with_bars(history: DataFrame, most: float = 56.0, least: float = 4.0) -> DataFrame:
    """Adds the height of each year's bar, on the scale of the EIN's largest revenue."""
    top = F.max(F.coalesce("revenue", F.lit(0))).over(Window.partitionBy("ein"))
    return history.withColumn("height", F.when((top > 0) & F.col("revenue").isNotNull(), F.greatest(F.lit(least), F.col("revenue") / top * most)).otherwise(least))


def revenue_details(filings: DataFrame, org_type: str) -> DataFrame:
    """A row per filing with the parts of its revenue; what a form does not tell is null."""
    form = TYPES.index(org_type) - 1
    parts = [(leading_int(F.col(c[form])) if c[form] else F.lit(None).cast("bigint")).alias(n) for n, c in DETAILS.items()]
    return filings.select(F.col("filerein").alias("ein"), to_int(F.col("taxyear")).alias("taxyear"), "url", *parts)


def narratives(rows: DataFrame, *texts: str) -> DataFrame:
    """A row per filled text of each filing, in ``slot`` order."""
    each = rows.select(F.col("filerein").alias("ein"), to_int(F.col("taxyear")).alias("taxyear"), F.posexplode(F.array(*texts)).alias("slot", "text"))
    return each.where(is_filled(strip(F.col("text"))) if len(texts) > 1 else is_filled(F.col("text")))


def by_year(filings: DataFrame, ein: str, *values: Column, ascending: bool = True) -> DataFrame:
    year = to_int(F.col("taxyear"))
    rows = filings.where(F.col("filerein") == ein).select(year.alias("taxyear"), *values)
    return rows.orderBy(F.col("taxyear").asc_nulls_last() if ascending else F.col("taxyear").desc_nulls_first())


def revenue_history(filings: DataFrame, ein: str, revenue: str) -> DataFrame:
    return by_year(filings, ein, leading_int(F.col(revenue)).alias("revenue"))


def program_slots(programs: DataFrame, key: str, *slots: str) -> DataFrame:
    """A row per filled slot."""
    return programs.select(key, F.posexplode(F.array(*slots)).alias("slot", "description")).where(is_filled(F.col("description")))


def activity_slots(filings: DataFrame, keys: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Filled (description, amount) slots as an array; rows without any are left out."""
    return filings.select(*keys, slots_of(pairs).alias("activities")).where(F.size("activities") > 0)


def slots_of(pairs: list[tuple[str, str]]) -> Column:
    """Slots with a description or an amount other than 0; descriptions without the space around them."""
    slots = F.array(*[F.struct(strip(F.coalesce(d, F.lit(""))).alias("description"), leading_int(F.col(a)).alias("amount")) for d, a in pairs])
    return F.filter(slots, lambda s: is_filled(s["description"]) | (F.coalesce(s["amount"], F.lit(0)) != 0))


def foundation_activities(filings: DataFrame) -> DataFrame:
    """Charitable activities and program-related investments of each filing that has any, with what a listing sums up:
    ``direct`` over the activities, and the investments' stated total or else that of their parts (null without any)."""
    other, every = leading_int(F.col(OTHER_INVESTMENTS)), leading_int(F.col(ALL_INVESTMENTS))
    out = filings.select(F.col("filerein").alias("ein"), to_int(F.col("taxyear")).alias("taxyear"), "url", slots_of(CHARITABLE).alias("charitable"), slots_of(INVESTMENTS).alias("investments"), other.alias("other_total"), every.alias("total"))
    invested = (F.size("investments") > 0) | F.col("other_total").isNotNull() | F.col("total").isNotNull()
    direct = F.when(F.size("charitable") > 0, activity_total(F.col("charitable")))
    parts = F.when(invested, activity_total(F.col("investments")) + F.coalesce("other_total", F.lit(0)))
    return out.where((F.size("charitable") > 0) | invested).withColumns({"direct": direct, "invested": F.coalesce("total", parts)})


def activity_total(activities: Column) -> Column:
    return F.aggregate(activities, F.lit(0).cast("bigint"), lambda t, s: t + F.coalesce(s["amount"], F.lit(0)))


def _listed(rows: DataFrame, name: str, *, newest_first: bool = False) -> DataFrame:
    """Each EIN's rows as one array: by year, those without one last, or first where the newest come first."""
    year, value = F.col("taxyear"), F.struct(*[c for c in rows.columns if c != "ein"])
    keys = [year.isNotNull(), -year] if newest_first else [year.isNull(), year]
    each = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], value.alias("row"))
    return rows.groupBy("ein").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["row"]).alias(name))


def org_profile(table: Callable[[str], DataFrame], ein: str | None = None) -> DataFrame:
    """One row per EIN that filed (or that of ``ein``): identity, years and revenue, and arrays of the yearly parts. The
    public charity's form goes before the private foundation's; narratives and donor funds belong to the one, activities
    to the other, and are null for the rest. All parts are grouped by EIN, so one partitioning serves their joins."""
    of = lambda name, key="filerein": table(name) if ein is None else table(name).where(F.col(key) == ein)
    shown = {"name": "filername1", "name_secondary": "filername2", "addr_line_1": "filerus1", "addr_line_2": "filerus2", "city": "fileruscity", "state": "filerusstate", "zip": "fileruszip"}
    more = ["dba_1", "dba_2", "care_of", "addr_country", "website", "formation_year", "source_run_id", "source_version", "_built_at"]
    charities, funds = of("basic_fields"), of("basic_fields_pf")
    first = org_rollup(charities, REVENUE["nonprofit"], tuple(shown.values()))
    second = org_rollup(funds, REVENUE["foundation"], tuple(shown.values())).join(first.select("ein"), "ein", "left_anti")
    heads, parts = [], []
    for kind, rollup, filings, canonical in (("nonprofit", first, charities, of("nonprofit_canonical", "ein")), ("foundation", second, funds, of("funder_canonical", "ein"))):
        identity = canonical.select("ein", *[F.col(c).alias(f"i_{c}") for c in [*shown, *more] if c in canonical.columns])
        known = [F.coalesce(f"i_{n}", c).alias(n) for n, c in shown.items()] + [(F.col(f"i_{c}") if c in canonical.columns else F.lit(None).cast("string")).alias(c) for c in more]
        daf = F.coalesce("has_daf", F.lit(False)) if kind == "nonprofit" else F.lit(False)
        heads.append(rollup.join(identity, "ein", "left").select("ein", F.lit(kind).alias("org_type"), "first_year", "last_year", "revenue", daf.alias("has_daf"), *known))
        years = filings.select(F.col("filerein").alias("ein"), to_int(F.col("taxyear")).alias("taxyear"), leading_int(F.col(REVENUE[kind])).alias("revenue"))
        both = _listed(years, "revenue_by_year").join(_listed(revenue_details(filings, kind), "revenue_details"), "ein").withColumn("org_type", F.lit(kind))
        parts.append(both)
    flag = F.coalesce(F.col("donoadvifund").isin("1", "true"), F.lit(False))
    own = {
        "nonprofit": [
            _listed(flag_by_year(charities, flag), "daf_by_year"),
            _listed(narratives(of("mission_statements"), "mission"), "missions", newest_first=True),
            _listed(narratives(of("programs"), "actividescri1", "actividescri2", "actividescri3"), "programs", newest_first=True),
            _listed(narratives(of("schedule_o_part_iii"), "supinfdetexp"), "schedule_o", newest_first=True),
        ],
        "foundation": [_listed(foundation_activities(funds), "activities", newest_first=True)],
    }
    out = heads[0].unionByName(heads[1]).join(parts[0].unionByName(parts[1]), ["ein", "org_type"], "left")
    for kind, tables in own.items():
        for part in tables:
            out = out.join(part.withColumn("org_type", F.lit(kind)), ["ein", "org_type"], "left")
    return out


def profile(nonprofits: DataFrame, funders: DataFrame) -> DataFrame:
    """One row per EIN; where both forms are filed the public charity's comes first, value by value."""
    a = nonprofits.select("ein", *[F.col(c).alias(f"a_{c}") for c in ("name", "city", "state")])
    b = funders.select("ein", *[F.col(c).alias(f"b_{c}") for c in ("name", "city", "state")])
    kind = F.when(F.col("a_name").isNotNull(), "nonprofit").otherwise("foundation")
    return a.join(b, "ein", "full").select("ein", *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in ("name", "city", "state")], kind.alias("org_type"))


def classify(labelled: DataFrame, key: str, forms: dict[str, DataFrame]) -> DataFrame:
    """Tags each row with the last form (in the order given) whose keys hold it, else ``unknown``."""
    out, tag = labelled, F.lit("unknown")
    for i, (form, keys) in enumerate(forms.items()):
        marks = keys.select(F.col(keys.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn(f"__{i}", F.lit(True))
        out = out.join(marks, key, "left")
        tag = F.when(F.col(f"__{i}"), form).otherwise(tag)
    return out.withColumn("form", tag).drop(*[f"__{i}" for i in range(len(forms))])


def not_in(rows: DataFrame, key: str, other: DataFrame) -> DataFrame:
    """SQL's NOT IN: nothing where the other side has a null, and never a row whose own key is null (unless the other
    side is empty)."""
    nulls = other.where(F.col(other.columns[0]).isNull()).limit(1)
    if other.isEmpty():
        return rows
    if not nulls.isEmpty():
        return rows.where("false")
    return rows.where(F.col(key).isNotNull()).join(other.select(F.col(other.columns[0]).alias(key)).distinct(), key, "left_anti")


def flag_by_year(filings: DataFrame, flag: Column, ein: str = "filerein") -> DataFrame:
    """Whether any of an EIN's filings of a year has the flag (null where none of them tells)."""
    return filings.groupBy(F.col(ein).alias("ein"), to_int(F.col("taxyear")).alias("taxyear")).agg(F.bool_or(flag).alias("flag"))


def original_rows(missing: DataFrame, funder: str, originals: DataFrame, ein: str = "filerein") -> DataFrame:
    """Missing funders with all their original rows; funders without any keep one row of nulls."""
    right = originals.select(*[F.col(f"`{c}`").alias(f"original_{c}") for c in originals.columns])
    return missing.join(right, F.col(funder) == F.col(f"original_{ein}"), "left")


def singletons_and_multiples(counts: DataFrame, labelled: DataFrame, key: str, n: str, labelled_n: str) -> tuple[DataFrame, DataFrame]:
    """Counted rows with their labelled counts (inner join by key; null keys never match): those counted once, and the
    others without rows that repeat all of what they have, both from the largest count."""
    both = counts.join(labelled.select(key, labelled_n), key)
    single = both.where(F.col(n) == 1).orderBy(F.col(labelled_n).desc(), key)
    return single, both.where(F.col(n) > 1).dropDuplicates().orderBy(F.col(n).desc(), F.col(labelled_n).desc(), key)


def missing_by_funder(missing: DataFrame, funder: str) -> DataFrame:
    return missing.where(F.col(funder).isNotNull()).groupBy(funder).agg(F.count("*").alias("n_missing")).orderBy(F.col("n_missing").desc(), funder)
