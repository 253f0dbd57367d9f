"""Tables under a folder: idempotent ingests, canonical builds published by one pointer, append-only logs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions.textsearch import english, inverted_index, tokens
from grantlake.operators.latest import assert_unique, latest_per_key
from grantlake.operators.quality import ValidationError, as_rows, validate
from grantlake.plans import canonical as C
from grantlake.plans.matching import grants_with_recipients
from grantlake.sources.registry import LINEAGE, REGISTRY, Resolved, read_csv, stamp

RUNS = "run_id string, logical_name string, source_version string, source_url string, started_at timestamp, finished_at timestamp, status string, row_count bigint, error string, column_list array<string>, validation string"
BUILDS = "build_id string, build_kind string, started_at timestamp, finished_at timestamp, status string, row_counts map<string,bigint>, source_runs map<string,string>, error string"

MATCHING, MATCHING_INPUTS = "grant_matching", ("irs_990pf_grants", "irs_990_basic_fields", "irs_schedule_i_grants")


class Catalog:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _log(self, name: str, schema: str) -> DataFrame:
        where = f"{self.folder}/meta/{name}"
        return self.spark.read.schema(schema).parquet(where) if self._fs.exists(self._path(where)) else self.spark.createDataFrame([], schema)

    def _add(self, name: str, schema: str, **row) -> None:
        names = [f.name for f in self.spark.createDataFrame([], schema).schema]
        self.spark.createDataFrame([tuple(row.get(n) for n in names)], schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/meta/{name}")

    def runs(self) -> DataFrame:
        """The last entry of each run: ``started`` until it ended."""
        return latest_per_key(self._log("ingest_runs", RUNS), ["run_id"], [F.col("finished_at").desc_nulls_last()])

    def builds(self) -> DataFrame:
        return latest_per_key(self._log("canonical_builds", BUILDS), ["build_id"], [F.col("finished_at").desc_nulls_last()])

    def successes(self) -> DataFrame:
        """The newest success of each source."""
        done = self.runs().where("status = 'success'")
        return latest_per_key(done, ["logical_name"], [F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()])

    def latest_run_ids(self) -> dict[str, str | None]:
        found = {r.logical_name: f"{r.run_id}@{r.source_version}" for r in self.successes().collect()}
        return {s.logical_name: found.get(s.logical_name) for s in REGISTRY}

    def loaded(self) -> DataFrame:
        """The last started run of each source whatever its status, with its warnings counted."""
        last = latest_per_key(self.runs(), ["logical_name"], [F.col("started_at").desc(), F.col("run_id").desc()])
        checks = F.from_json("validation", "array<struct<name:string,status:string,detail:string>>")
        return last.withColumn("n_warnings", F.coalesce(F.size(F.filter(checks, lambda c: c["status"] == "warn")), F.lit(0)))

    def ingest(self, resolved: Resolved, *, force: bool = False, now: datetime | None = None) -> str | None:
        """Loads a version once; None if it is there already and ``force`` is off. A failed run publishes nothing."""
        source, now = resolved.source, now or datetime.now(timezone.utc)
        past = self.runs().where((F.col("logical_name") == source.logical_name) & (F.col("status") == "success"))
        if not force and not past.where(F.col("source_version") == resolved.version).isEmpty():
            return None
        prior = past.where(F.col("source_version") != resolved.version).orderBy(F.col("finished_at").desc()).first()
        run = {"run_id": str(uuid.uuid4()), "logical_name": source.logical_name, "source_version": resolved.version, "source_url": resolved.url, "started_at": now}
        self._add("ingest_runs", RUNS, **run, status="started")
        target = f"{self.folder}/staging/{source.staging_table}/{run['run_id']}"
        try:
            rows = stamp(read_csv(self.spark, resolved.url), resolved.version, resolved.url, run["run_id"], now.isoformat())
            if source.sort_by in rows.columns:  # row groups then skip on the key of every point lookup
                rows = rows.repartitionByRange(source.sort_by).sortWithinPartitions(source.sort_by)
            rows.write.option("compression", "zstd").parquet(target)
            stored = self.spark.read.parquet(target)
            columns = [c for c in stored.columns if c not in LINEAGE]
            checks = validate(stored, source.required_columns, prior and list(prior.column_list), prior and prior.row_count)
            self._publish(f"staging/{source.staging_table}", target)
            self._add("ingest_runs", RUNS, **run, finished_at=datetime.now(timezone.utc), status="success", row_count=stored.count(), column_list=columns, validation=json.dumps(as_rows(checks)))
        except Exception as e:
            checks = as_rows(e.checks) if isinstance(e, ValidationError) else []
            self._add("ingest_runs", RUNS, **run, finished_at=datetime.now(timezone.utc), status="failed", error=str(e)[:4000], validation=json.dumps(checks))
            raise
        return run["run_id"]

    def _publish(self, name: str, target: str) -> None:
        """Points a name at a folder: written aside, then renamed to the pointer's next number. Older pointers stay, so
        that a reader finds the last one or the one before, and never none."""
        pointers = f"{self.folder}/{name}.pointers"
        self._fs.mkdirs(self._path(pointers))
        there, aside = self._path(f"{pointers}/{(self._pointers(name) or [0])[-1] + 1:010d}"), self._path(f"{pointers}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(target.encode()))
        out.close()
        if self._fs.exists(there) or not self._fs.rename(aside, there):
            raise OSError(f"cannot publish {name}: another build was first")

    def _pointers(self, name: str) -> list[int]:
        folder = self._path(f"{self.folder}/{name}.pointers")
        return sorted(int(n) for f in self._fs.listStatus(folder) if (n := f.getPath().getName()).isdigit()) if self._fs.exists(folder) else []

    def _current(self, name: str) -> str | None:
        known = self._pointers(name)
        if not known:
            return None
        there = self._path(f"{self.folder}/{name}.pointers/{known[-1]:010d}")
        stream = self._fs.open(there)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text

    def table(self, name: str, kind: str | None = None) -> DataFrame:
        """A staging table's last good load, or a table of the published builds; ``kind`` names one of them."""
        places = [self._current(f"staging/{name}")] if kind is None else []
        for k in (kind,) if kind else ("canonical", MATCHING):
            build = self._current(f"builds/{k}")
            places.append(build and f"{build}/{name}")
        for where in places:
            if where and self._fs.exists(self._path(where)):
                return self.spark.read.parquet(where)
        raise KeyError(f"{name} has not been built")

    def _build(self, kind: str, source_runs: dict[str, str], fill: Callable) -> str:
        """Writes all tables of a build aside and publishes them with one pointer; readers see all of it or none."""
        build = {"build_id": str(uuid.uuid4()), "build_kind": kind, "started_at": datetime.now(timezone.utc), "source_runs": source_runs}
        target, counts = f"{self.folder}/builds/{build['build_id']}", {}
        self._add("canonical_builds", BUILDS, **build, status="started")

        def put(name: str, df: DataFrame, key: list[str] | None = None) -> DataFrame:
            df.write.option("compression", "zstd").parquet(f"{target}/{name}")
            stored = self.spark.read.parquet(f"{target}/{name}")
            if key:
                assert_unique(stored, key)
            counts[name] = stored.count()
            return stored

        try:
            fill(put)
            self._publish(f"builds/{kind}", target)
            self._add("canonical_builds", BUILDS, **build, finished_at=datetime.now(timezone.utc), status="success", row_counts=counts)
        except Exception as e:
            self._add("canonical_builds", BUILDS, **build, finished_at=datetime.now(timezone.utc), status="failed", row_counts=counts, error=str(e)[:4000])
            raise
        return build["build_id"]

    def build(self, *, with_people: bool = False, with_matching: bool = False) -> str:
        """The canonical tables, and the text's inverted indexes sorted by lexeme, so that a search reads the row groups
        of its own lexemes only. ``with_matching`` also runs :meth:`match`, a build of its own."""
        t = self.table

        def fill(put: Callable) -> None:
            part_iii = put("schedule_o_part_iii", C.schedule_o_part_iii(t("schedule_o")))
            put("nonprofit_canonical", C.nonprofit_canonical(t("basic_fields")), ["ein"])
            text = C.nonprofit_text(t("mission_statements"), t("programs"), part_iii).withColumn("tokens_simple", tokens(F.col("unique_text_compact")))
            stored = put("nonprofit_text", english(text.withColumn("tokens_english", F.col("tokens_simple")), "ein", "tokens_english"), ["ein"])
            for config in ("simple", "english"):
                index = inverted_index(stored, "ein", f"tokens_{config}")
                put(f"nonprofit_index_{config}", index.repartitionByRange("lexeme", "ein").sortWithinPartitions("lexeme", "ein"))
            put("funder_canonical", C.funder_canonical(t("basic_fields_pf")), ["ein"])
            if with_people:
                put("person_canonical", C.person_canonical(t("officers"), t("officers_pf")), ["person_id", "ein"])
                put("org_person_role", C.org_person_role(t("officers"), t("officers_pf")))

        done = self._build("canonical", {k: v for k, v in self.latest_run_ids().items() if v}, fill)
        if with_matching:
            self.match()
        return done

    def match(self, *, limit: int | None = None, force: bool = False) -> str:
        """Matched grants and the union of all grants, as a build of its own kind. Inputs that were matched already are
        not matched again unless ``force`` is on. ``limit`` takes so many key tuples of either side, for trials, under a
        kind of its own that readers only get by name. ``RuntimeError`` where an input was never loaded."""
        latest = self.latest_run_ids()
        inputs = {s: latest[s] for s in MATCHING_INPUTS if latest[s]}
        if missing := sorted(set(MATCHING_INPUTS) - set(inputs)):
            raise RuntimeError(f"never loaded: {', '.join(missing)}")
        kind = MATCHING if limit is None else f"{MATCHING}_limit_{limit}"
        last = self.builds().where((F.col("build_kind") == kind) & (F.col("status") == "success")).orderBy(F.col("finished_at").desc()).first()
        if last and not force and dict(last.source_runs) == inputs:
            return last.build_id
        t = self.table

        def fill(put: Callable) -> None:
            matched = put("privategrants_w_recipients", grants_with_recipients(t("privategrants"), t("basic_fields"), limit=limit))
            grants = C.unioned_grants(matched, t("grants_to_domestic_organizations"))
            put("unioned_grants", grants.repartitionByRange("grantee_ein", "taxyear").sortWithinPartitions("grantee_ein", "taxyear"))

        return self._build(kind, inputs, fill)


def write_report(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)


def apply_lookup(rows: DataFrame, key: str, lookup: DataFrame) -> DataFrame:
    """Adds what an outside lookup (a table of ``key`` and values) knows; rows unknown to it stay."""
    return rows.join(lookup.dropDuplicates([key]), key, "left")


