"""Known sources, the newest version of each, and the all-text reader."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = ("_source_version", "_source_url", "_ingested_at", "_ingest_run_id")


@dataclass(frozen=True)
class Source:
    logical_name: str
    staging_table: str
    form_type: str
    filename_regex: str
    required_columns: tuple[str, ...] = ("filerein",)
    skip_default_refresh: bool = False
    sort_by: str = "filerein"

    def key_for(self, folder: str, filename: str) -> str:
        return f"{folder.rstrip('/')}/{filename}"


@dataclass(frozen=True)
class Resolved:
    source: Source
    version: str
    filename: str
    url: str
    size: int


def _source(name: str, table: str, form: str, stem: str, *required: str, skip: bool = False) -> Source:
    return Source(name, table, form, rf"^(\d{{4}}_\d{{2}}_\d{{2}})_All_Years_{stem}\.csv$", required or ("filerein",), skip)


# Names of the public files and of the tables that they fill.
REGISTRY = (
    _source("irs_990_basic_fields", "basic_fields", "990", "990StandardFields", "filerein", "taxyear"),
    _source("irs_990pf_basic_fields", "basic_fields_pf", "990-PF", "990PFStandardFields", "filerein", "taxyear"),
    _source("irs_990_missions", "mission_statements", "990", "990Part1Missions"),
    _source("irs_990_programs", "programs", "990", "990Part3Programs"),
    _source("irs_schedule_o", "schedule_o", "990", "Schedule_?O"),
    _source("irs_schedule_i_grants", "grants_to_domestic_organizations", "990", "ScheduleIPart2Grants"),
    _source("irs_990pf_grants", "privategrants", "990-PF", "990PFPart14Grants3A"),
    _source("irs_990_officers", "officers", "990", "990Part7AOfficers", skip=True),
    _source("irs_990pf_officers", "officers_pf", "990-PF", "990PFPart7p1-?Officers", skip=True),
)


def get_source(name: str) -> Source:
    found = {s.logical_name: s for s in REGISTRY}
    if name not in found:
        raise KeyError(f"no source {name!r}; known: {', '.join(sorted(found))}")
    return found[name]


def list_folder(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Name, size and modification time of a folder's files, on any file system that Hadoop reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files if f.isFile()]


def resolve_latest(source: Source, folder: str, listing: list[tuple[str, int, int]]) -> Resolved | None:
    """The file whose name fits and has the largest version text, the first one listed on ties; None without any."""
    best = None
    for name, size, _ in listing:
        m = re.match(source.filename_regex, name)
        if m and (best is None or m[1] > best.version):
            best = Resolved(source, m[1], name, source.key_for(folder, name), size)
    return best


def sanitise(header: str) -> str:
    name = re.sub(r"[.\s-]", "_", header.lower()).replace("(", "").replace(")", "")
    return re.sub(r"_+", "_", name).strip("_")


def column_names(headers: list[str]) -> list[str]:
    """Sanitised names by position; a repeated one gets ``_1``, ``_2`` and so on."""
    out: list[str] = []
    for h in headers:
        base = name = sanitise(h) or "column"
        n = 0
        while name in out:
            n += 1
            name = f"{base}_{n}"
        out.append(name)
    return out


def read_csv(spark: SparkSession, path: str, *, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns as text: quotes may hold line ends and doubled quotes, short rows are padded with nulls, long ones
    cut, blanks are null, bytes that are no text become U+FFFD. A file without a header raises ``ValueError``."""
    options = {"sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"}
    head = spark.read.options(**options).option("header", False).csv(path).limit(1).collect()
    if not head:
        raise ValueError(f"{path} is empty")
    names = column_names([h or "" for h in head[0]])
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.options(**options).option("header", True).option("enforceSchema", True).schema(schema).csv(path)


def stamp(df: DataFrame, version: str, url: str, run_id: str, ingested_at: str) -> DataFrame:
    return df.select("*", *[F.lit(v).alias(n) for n, v in zip(LINEAGE, (version, url, ingested_at, run_id))])


def read_labelled_pairs(spark: SparkSession, *paths: str) -> DataFrame:
    """Pipe-separated UTF-16 files of funder and recipient; rows need both EINs, hyphens go, pairs are distinct."""
    from functools import reduce

    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_csv(spark, p, sep="|", encoding="UTF-16") for p in paths])
    rows = rows.where(F.col("funder_ein").isNotNull() & F.col("recip_ein").isNotNull())
    bare = {c: F.replace(F.col(c), F.lit("-"), F.lit("")) for c in ("funder_ein", "recip_ein")}
    return rows.withColumns(bare).dropDuplicates(["funder_ein", "recip_ein"])
