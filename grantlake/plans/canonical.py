"""Canonical tables from all-text staging tables; each function is one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.scalars import is_filled, key_text, normalise_name, person_key, plus_filled, to_decimal, to_int
from grantlake.operators.grants import union_grants
from grantlake.operators.latest import filing_order, latest_group, latest_per_key

# What a Schedule O label must and must not contain to belong to Part III.
PART_III = (r"(?i)\b990\b", r"(?i)\bpart\s*(iii|3)\b")
OTHER_SCHEDULE = r"(?i)\bschedule\s+[a-z]\b"
KEYS = ["name1_key", "name2_key", "address1_key", "address2_key", "addresscity_key", "addressstate_key", "addresszip_key"]

_IDENTITY = {"ein": "filerein", "name": "filername1", "name_secondary": "filername2"}
_ADDRESS = {"addr_line_1": "filerus1", "addr_line_2": "filerus2", "city": "fileruscity", "state": "filerusstate", "zip": "fileruszip", "addr_country": "filerforctry"}
_STAMPS = {"latest_taxyear": "taxyear", "latest_taxperend": "taxperend", "source_run_id": "_ingest_run_id", "source_version": "_source_version"}
NONPROFIT = _IDENTITY | {"dba_1": "dbanbnline11", "dba_2": "dbanbnline22", "care_of": "incarenm"} | _ADDRESS | {"website": "websitsiteit", "formation_year": "formationorm"} | _STAMPS
FUNDER = _IDENTITY | _ADDRESS | {"phone": "filerphone"} | _STAMPS


def _built_at() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz").alias("_built_at")


def canonical(staging: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The newest filing of each EIN under canonical names; rows without an EIN have no entity."""
    rows = staging.where(F.col("filerein").isNotNull())
    order = [*filing_order(to_int(F.col("taxyear")), "taxperend", "_ingested_at"), F.xxhash64(*sorted(staging.columns))]
    return latest_per_key(rows, ["filerein"], order).select(*[F.col(c).alias(n) for n, c in columns.items()], _built_at())


def nonprofit_canonical(basic_fields: DataFrame) -> DataFrame:
    return canonical(basic_fields, NONPROFIT)


def funder_canonical(basic_fields_pf: DataFrame) -> DataFrame:
    return canonical(basic_fields_pf, FUNDER)


def part_iii_condition(label: Column) -> Column:
    return label.rlike(PART_III[0]) & label.rlike(PART_III[1]) & ~label.rlike(OTHER_SCHEDULE)


def schedule_o_part_iii(schedule_o: DataFrame) -> DataFrame:
    return schedule_o.where(part_iii_condition(F.col("sidfalrdesc")) & is_filled(F.col("supinfdetexp")))


def narrative_text(snippets: DataFrame, key: str = "ein", year: str = "taxyear", text: str = "txt") -> DataFrame:
    """Distinct snippets of each key's latest year, sorted and joined by a blank line, with their number."""
    latest = latest_group(snippets, [key], F.col(year)).select(key, text).distinct()
    return latest.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(text)), "\n\n").alias("unique_text_compact"), F.count("*").alias("n_snippets"))


def nonprofit_text(missions: DataFrame, programs: DataFrame, part_iii: DataFrame) -> DataFrame:
    """Narratives of all three sources; the program slots are unpivoted in one scan."""
    year = to_int(F.col("taxyear")).alias("taxyear")
    ein = F.col("filerein").alias("ein")
    slots = F.explode(F.array("actividescri1", "actividescri2", "actividescri3")).alias("txt")
    fan_in = missions.select(ein, year, F.col("mission").alias("txt")).unionByName(programs.select(ein, year, slots)).unionByName(part_iii.select(ein, year, F.col("supinfdetexp").alias("txt")))
    return narrative_text(fan_in.where(is_filled(F.col("txt")) & F.col("ein").isNotNull())).withColumn("_built_at", _built_at())


def person_canonical(officers: DataFrame, officers_pf: DataFrame) -> DataFrame:
    """One row per normalised name and EIN."""
    def side(df: DataFrame, name: str, pf: bool) -> DataFrame:
        return df.where(is_filled(F.col(name))).select(F.col("filerein").alias("ein"), F.col(name).alias("name"), to_int(F.col("taxyear")).alias("year"), F.lit(pf).alias("pf"))

    rows = side(officers, "namepeperson", False).unionByName(side(officers_pf, "odtkeiodtokepn", True)).withColumn("name_normalized", normalise_name(F.col("name")))
    out = rows.groupBy("name_normalized", "ein").agg(
        F.max("name").alias("name"), F.min("year").alias("first_taxyear"), F.max("year").alias("last_taxyear"), F.count("*").alias("n_filings"),
        F.bool_or(~F.col("pf")).alias("seen_on_990"), F.bool_or("pf").alias("seen_on_990pf"),
    )
    return out.select(person_key(F.col("name"), F.col("ein")).alias("person_id"), "name", "name_normalized", "ein", "first_taxyear", "last_taxyear", "n_filings", "seen_on_990", "seen_on_990pf", _built_at())


def org_person_role(officers: DataFrame, officers_pf: DataFrame) -> DataFrame:
    """One row per filing and person; what a form does not have is null."""
    flags = {"is_officer": "officerffice", "is_individual_trustee": "inditrusdire", "is_institutional_trustee": "instittruste", "is_key_employee": "keyempemploy", "is_highly_compensated": "highcompempl", "is_former": "formerormer"}
    amounts = {"avg_hours_per_week": "avehouperwee", "avg_hours_per_week_related": "avhopewereel", "comp_reportable_org": "repcomfroorg", "comp_reportable_related": "recofrrlorrg", "comp_other": "otherccompen"}
    of_pf = {"avg_hours_per_week": "odtkeiodtoke", "comp_reportable_org": "odtkeiodtokecom"}

    def side(df: DataFrame, name: str, title: str, numbers: list[Column], marks: list[Column], form: str) -> DataFrame:
        rows = df.where(is_filled(F.col(name)))
        return rows.select(person_key(F.col(name), F.col("filerein")).alias("person_id"), F.col("filerein").alias("ein"), "taxyear", "taxperend", F.col(title).alias("title"), *numbers, *marks, F.lit(form).alias("source_form"), F.col("_source_version").alias("source_version"), F.col("_ingest_run_id").alias("source_run_id"))

    full = side(officers, "namepeperson", "titleitle", [to_decimal(F.col(c)).alias(n) for n, c in amounts.items()], [is_filled(F.col(c)).alias(n) for n, c in flags.items()], "990")
    other = plus_filled(to_decimal(F.col("odtkeiodtokecoeb")), to_decimal(F.col("odtkeiodtokeeao"))).cast("decimal(38,10)")
    numbers = [(other if n == "comp_other" else to_decimal(F.col(of_pf[n])) if n in of_pf else F.lit(None).cast("decimal(38,10)")).alias(n) for n in amounts]
    short = side(officers_pf, "odtkeiodtokepn", "odtkeiodtoketi", numbers, [F.lit(None).cast("boolean").alias(n) for n in flags], "990-PF")
    return full.unionByName(short).withColumn("_built_at", _built_at())


def with_keys(df: DataFrame, name1: str, name2: str, address1: str, address2: str, city: str, state: str, zipcode: str) -> DataFrame:
    """Adds the seven match keys; a missing name or street is empty, a missing city, state or ZIP stays null."""
    filled = {"name1_key": name1, "name2_key": name2, "address1_key": address1, "address2_key": address2}
    kept = {"addresscity_key": F.col(city), "addressstate_key": F.col(state), "addresszip_key": F.left(F.col(zipcode), F.lit(5))}
    return df.withColumns({k: key_text(F.col(c), fill=True) for k, c in filled.items()} | {k: key_text(c, fill=False) for k, c in kept.items()})


def private_grants_keyed(privategrants: DataFrame) -> DataFrame:
    return with_keys(privategrants, "sigocpyrbnbn1", "sigocpyrbnbn2", "sigocpyrfaal1", "sigocpyrfaal2", "sigocpyrfaci", "sigocpyrfapo", "sigocpyrfapc")


def basic_fields_keyed(basic_fields: DataFrame) -> DataFrame:
    rows = with_keys(basic_fields, "filername1", "filername2", "filerus1", "filerus2", "fileruscity", "filerusstate", "fileruszip")
    return rows.withColumn("filerein_key", key_text(F.col("filerein"), fill=True))


def unique_names(keyed: DataFrame, *more: str, since: int = 2015) -> DataFrame:
    """Distinct key tuples of recent filings; a tax year that is no number fails the build."""
    return keyed.where(F.col("taxyear").cast("int") >= since).select(*more, *KEYS).distinct()


_GRANT = ["granter_ein", "granter_name", "granter_name2", "filesha256", "url", "taxyear", "taxperbegin", "taxperend", "grantee_ein", "grantee_person_name", "grantee_organization_name1", "grantee_organization_name2", "grantee_address1", "grantee_address2", "grantee_city", "grantee_state", "grantee_zip", "grant_amount", "grant_purpose", "grant_status", "grant_relationship"]
_MATCHED = ["filerein", "filername1", "filername2", "filesha256", "url", "taxyear", "taxperbegin", "taxperend", "recipeint_ein_key", "sigocpyrpnam", "sigocpyrbnbn1", "sigocpyrbnbn2", "sigocpyrfaal1", "sigocpyrfaal2", "sigocpyrfaci", "sigocpyrfapo", "sigocpyrfapc", "sigocpyamoun", "sigocpypogoc", "sigocpyrfsta", "sigocpyrrela"]
_SCHEDULE = ["filerein", "filername1", "filername2", None, "url", "taxyear", "taxperbegin", "taxperend", "rteinorecipi", None, "rtrnbbnline11", "rtrnbbnline22", "retaadadliin1", "retaadadliin2", "rectabaddcit", "rectabaddsta", "rtazipcode", "retaamofcagr", "retapuofgrra", None, None]
_KINDS = {"taxyear": "int", "taxperbegin": "timestamp_ntz", "taxperend": "timestamp_ntz", "grant_amount": "bigint"}


def unioned_grants(matched: DataFrame, schedule: DataFrame) -> DataFrame:
    """Matched private-foundation grants and Schedule I lines as one set."""
    shape = lambda names: [(F.lit(None) if c is None else F.col(c)).cast(_KINDS.get(n, "string")).alias(n) for n, c in zip(_GRANT, names)]
    return union_grants(matched.select(*shape(_MATCHED)), schedule.select(*shape(_SCHEDULE)))
