"""Size-tiered compaction of immutable shards under a versioned manifest.

Arrivals are appended as small Parquet shards. Shards of similar size (the same power of ``fan_in``) that follow each
other in a manifest are merged once there are ``fan_in`` of them, up to files of about ``target_bytes``; larger ones
stay. A version is one JSON file with the columns and the live shards, by their places below the store's folder. It is
written aside and renamed to the next number, which fails if another writer was first, so that a reader sees a whole
version or the one before. Shards are never changed, and those that a merge replaces stay for readers of older versions
until :meth:`ShardStore.vacuum`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int
    tier: int
    generation: int


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, folder: str, *, target_bytes: int = 128 << 20, fan_in: int = 4, base_bytes: int = 1 << 20) -> None:
        if fan_in < 2 or target_bytes < 1 or base_bytes < 1:
            raise ValueError("fan_in must be 2 or more, sizes positive")
        if set(folder) & set("*?[]{}\\"):
            raise ValueError("the folder's name must not have characters of file patterns")
        self.spark, self.folder, self.target, self.fan_in, self.base = spark, folder.rstrip("/"), target_bytes, fan_in, base_bytes
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/manifest"))

    def tier(self, size: int) -> int:
        """0 below ``base_bytes``, then one for each further factor of ``fan_in``."""
        t, most = 0, self.base
        while size >= most:
            t, most = t + 1, most * self.fan_in
        return t

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.folder}/manifest"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _manifest(self, version: int | None) -> dict | None:
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if not version:
            return None
        stream = self._fs.open(self._path(f"{self.folder}/manifest/v{version:010d}.json"))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def live(self, version: int | None = None) -> list[Shard]:
        """Shards of a version, the latest if None; none before the first commit."""
        manifest = self._manifest(version)
        return [Shard(**s) for s in manifest["shards"]] if manifest else []

    def schema(self, version: int | None = None) -> StructType | None:
        """Columns of all that was ever appended up to a version."""
        manifest = self._manifest(version)
        return StructType.fromJson(manifest["schema"]) if manifest else None

    def commit(self, shards: list[Shard], after: int, schema: StructType | None = None) -> int:
        """Makes ``after + 1`` the latest version; :class:`Conflict` if it exists already."""
        schema = schema or self.schema(after or None) or StructType([])
        aside = self._path(f"{self.folder}/manifest/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps({"version": after + 1, "schema": schema.jsonValue(), "shards": [asdict(s) for s in shards]}).encode()))
        out.close()
        there = self._path(f"{self.folder}/manifest/v{after + 1:010d}.json")
        # On HDFS and object stores rename() refuses an existing file; a local file system would replace it.
        if self._fs.exists(there) or not self._fs.rename(aside, there):
            self._fs.delete(aside, False)
            raise Conflict(f"version {after + 1} is there already")
        return after + 1

    def _written(self, place: str, generation: int) -> list[Shard]:
        """Files below a folder of the store, in the order of their paths."""
        root = self._path(f"{self.folder}/{place}")
        if not self._fs.exists(root):
            return []
        skip, found, files = len(self._fs.makeQualified(root).toString()), [], self._fs.listFiles(root, True)
        while files.hasNext():
            f = files.next()
            if f.getPath().getName().startswith("part-"):
                found.append((place + self._fs.makeQualified(f.getPath()).toString()[skip:], f.getLen()))
        return [Shard(p, n, self.tier(n), generation) for p, n in sorted(found)]

    def _files(self, shards: list[Shard], schema: StructType) -> DataFrame:
        """Rows of some shards."""
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{s.path}" for s in shards])

    def _merged_schema(self, new: StructType) -> StructType:
        old = self.schema()
        if old is None:
            return new
        kinds = {f.name: f.dataType for f in old}
        for f in new:
            if kinds.get(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} is {kinds[f.name].simpleString()} in the store, not {f.dataType.simpleString()}")
        return StructType([*old.fields, *[f for f in new if f.name not in kinds]])

    def append(self, rows: DataFrame, batch: Column | None = None) -> int:
        """Adds the rows as new shards: those that the tasks write, or with ``batch`` (an integer column) at least one
        file per value. All of them are one commit, or with ``batch`` one commit per value, in order; no commit where
        there is no row with a batch. Nothing is shuffled. Columns that the store does not know yet are null in older
        rows; one of another type than before raises ``ValueError``. An empty table adds its columns and no rows."""
        schema, place, latest = self._merged_schema(rows.schema), f"data/{uuid.uuid4().hex}", 0
        if batch is None:
            rows.write.parquet(f"{self.folder}/{place}")
            known = self.versions()
            return self.commit(self.live() + self._written(place, 0), known[-1] if known else 0, schema)
        for _, shards in self.stage(rows, batch):
            known = self.versions()
            latest = self.commit(self.live() + shards, known[-1] if known else 0, schema)
        return latest

    def stage(self, rows: DataFrame, batch: Column) -> list[tuple[int, list[Shard]]]:
        """Writes the rows in one pass, at least one file for each value of ``batch``, and returns each value's shards
        in order; they become visible by :meth:`commit`. Rows with a null batch raise ``ValueError``."""
        place, name = f"data/{uuid.uuid4().hex}", _unused("batch", rows.columns)
        known = F.coalesce(batch.cast("int"), F.raise_error(F.lit("a row has no batch")).cast("int"))
        rows.withColumn(name, known).write.partitionBy(name).parquet(f"{self.folder}/{place}")
        found: dict[int, list[Shard]] = {}
        for s in self._written(place, 0):
            found.setdefault(int(s.path.split("/")[2].partition("=")[2]), []).append(s)
        return sorted(found.items())

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs to merge: neighbours in a tier's order, cut where the target is reached; runs of fewer than ``fan_in``
        shards wait, unless together they fill a target-sized file."""
        runs = []
        for tier in sorted({s.tier for s in shards}):
            run, size = [], 0
            for s in [s for s in shards if s.tier == tier and s.bytes < self.target * 2 // 3]:
                if run and size + s.bytes > self.target:
                    runs.append(run)
                    run, size = [], 0
                run.append(s)
                size += s.bytes
            if len(run) >= self.fan_in:
                runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self) -> bool:
        """Merges what :meth:`plan` names and commits the result; False if there was nothing to do.

        All runs merge in one job, a task each; a run holds at most ``target_bytes``, so none is larger. Rows are
        counted before and after, by the files' footers: if any is missing, nothing is committed.
        """
        known = self.versions()
        shards = self.live()
        runs = self.plan(shards)
        if not runs:
            return False
        schema, place = self.schema(), f"data/{uuid.uuid4().hex}"
        old = [s for run in runs for s in run]
        number = self.spark.createDataFrame([(s.path, i) for i, run in enumerate(runs) for s in run], "path string, run int")
        rows = self._files(old, schema).select(F.struct(*[F.col(f"`{f.name}`") for f in schema]).alias("row"), F.regexp_extract("_metadata.file_path", r"/(data/[0-9a-f]{32}/[^?]*)$", 1).alias("path"))
        rows = rows.join(F.broadcast(number), "path").select("row", "run")  # broadcast: a short line for each shard of the manifest
        name = _unused("run", schema.names)
        rows.repartitionById(len(runs), "run").select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema], F.col("run").alias(name)).write.partitionBy(name).parquet(f"{self.folder}/{place}")
        merged = self._written(place, 1 + max(s.generation for s in old))
        before, after = self._files(old, schema).count(), self._files(merged, schema).count() if merged else 0
        if before != after:
            self._fs.delete(self._path(f"{self.folder}/{place}"), True)
            raise RuntimeError(f"{before} rows became {after}; nothing was committed")
        gone = {s.path for s in old}
        self.commit([s for s in shards if s.path not in gone] + merged, known[-1])
        return True

    def vacuum(self, keep: int = 1) -> int:
        """Removes the manifests of all but the latest ``keep`` versions, and the shards that only those had; returns
        the number of files removed. Shards of a write that has not been committed yet go too: call it when no other
        writer is at work."""
        if keep < 1:
            raise ValueError("keep must be 1 or more")
        known = self.versions()
        wanted = {s.path for v in known[-keep:] for s in self.live(v)}
        gone = [s.path for s in self._written("data", 0) if s.path not in wanted]
        for path in [*gone, *(f"manifest/v{v:010d}.json" for v in known[:-keep])]:
            self._fs.delete(self._path(f"{self.folder}/{path}"), False)
        return len(gone)

    def read(self, version: int | None = None, *, shard_col: str | None = None) -> DataFrame | None:
        """Rows of a version, and the name of the file that each lies in if ``shard_col`` is given (it must not be a
        column of the rows); without rows an empty table, None before the first commit."""
        schema, shards = self.schema(version), self.live(version)
        if schema is None:
            return None
        if shard_col in schema.names:
            raise ValueError(f"{shard_col} is a column of the rows")
        rows = self._files(shards, schema) if shards else self.spark.createDataFrame([], schema)
        return rows.select("*", (F.col("_metadata.file_name") if shards else F.lit("")).alias(shard_col)) if shard_col else rows


def _unused(name: str, columns: list[str]) -> str:
    """A name that is no column, letter case aside."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def compacted(docs: DataFrame, folder: str, *, batches: int = 4, id_col: str = "doc_id", target_bytes: int = 32 << 20, base_bytes: int = 1 << 20, fan_in: int = 4) -> ShardStore:
    """Appends the documents as ``batches`` arrivals, each a commit of its own, merging after each until nothing is
    left to merge. An arrival has the documents of one value of ``pmod(xxhash64(id), batches)``; null ids hash like
    any other value, repeated rows all stay, null and empty texts are kept as they are, and columns may have any name.
    The documents are read once. An empty table makes one version without rows."""
    store = ShardStore(docs.sparkSession, folder, target_bytes=target_bytes, base_bytes=base_bytes, fan_in=fan_in)
    arrivals = store.stage(docs, F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(batches)))
    for _, shards in arrivals or [(0, [])]:
        known = store.versions()
        store.commit(store.live() + shards, known[-1] if known else 0, docs.schema)
        while store.compact():
            pass
    return store
