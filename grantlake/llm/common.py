"""Shared-folder scratch tables and small helpers used by the operators of this subpackage.

Every intermediate table goes below the folder that the session names in ``spark.checkpoint.dir``: executors and the
driver of a cluster share it, so a written table survives the loss of an executor and cuts the lineage. Only where the
setting is missing (unit tests, a laptop) a folder of this process is used and removed when it ends.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []
_made: dict[str, None] = {}


def shared_folder(spark: SparkSession) -> str:
    """URI of the folder that all machines share, without a slash at its end; ``RuntimeError`` on a cluster for which
    none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/") if "://" in named or named.startswith("file:") else f"{_default_scheme(spark)}{named.rstrip('/')}"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="llm-scratch-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def _default_scheme(spark: SparkSession) -> str:
    uri = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString()
    return "file://" if uri.startswith("file:") else uri.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder; nothing is there yet."""
    path = f"{shared_folder(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    _made[path] = None
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Removes all scratch of this process that is still there, and returns how many paths that was. Tables that
    operators have returned can no longer be read then; write them first."""
    paths = list(_made)
    discard(spark, *paths)
    return len(paths)


def materialise(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Writes the rows once and reads them back; returns the table and its path for :func:`discard`."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes scratch tables that no returned table still reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _made.pop(path, None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A worker's function that gives back at its end what it no longer holds: workers stay for the stages that follow,
    and what their allocators keep for themselves counts against the executor."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def pieces(batch: pa.RecordBatch, text: int | str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into slices of about ``most`` bytes of text, so that what a worker builds from one stays bounded
    (a single longer text is a slice of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    begin = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(begin, at - begin)
            begin, total = at, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def put_file(folder: str, name: str, data: bytes) -> None:
    """Writes a file whole or not at all: a retried task puts the same bytes under the same name."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(part := f"{root}/.{name}.{uuid.uuid4().hex}") as out:
        out.write(data)
    fs.move(part, f"{root}/{name}")


def base32_sha1(col):
    """Bare upper-case base32 of the SHA-1 of a binary or string column, from built-in functions."""
    digits = F.sha1(col)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def connected_components(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """Components of an undirected graph by alternating large-star and small-star rounds.

    ``edges``: two bigint columns, taken by position; loops and repeats are allowed. Returns ``(node, root)`` for each
    node that has a link to another one, ``root`` being the component's smallest node, and the paths of the tables
    that the result reads. Each round is written to the shared folder; only a count and a hash come to the driver.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links, path = materialise(links, "links")
    mark = None
    while True:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest)
        after, new = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
        now = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("u")).first())
        discard(spark, path)
        links, path = after, new
        if now == mark and now[0] == now[2]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")), [path]
        mark = now
