"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints have 64 bits, cut into three segments (22, 21 and 21 bits). The binary Golay code of length 23 is
perfect: each word decodes to one codeword at a distance of 3 or less. A segment's keys are the indices of the
codewords to which the segment itself and its single-bit changes decode (one or six of them). Two segments that differ
in two bits or fewer have such a neighbour in common, hence a key. If two fingerprints differ in four bits or fewer,
the two segments with the fewest errors have at most two between them, so that the pair of those segments' keys agrees
too: every link is found under one of three pairs of segments, and each candidate is then verified on all 64 bits.

Only distinct fingerprints are compared, and of a bucket only a spanning forest of its links is emitted, never its
pairs. A bucket over ``most`` fingerprints is cut into blocks, of which each pair is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha1
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from grantlake.llm.common import connected_components, discard, materialise, pieces, scratch, tidy

SEED = 42
SHINGLE = 4
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
MOST = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Majority fingerprint of a text's word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line, span = b" ".join(words), min(width, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - span]]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        hashes = [digest(line[a : b - 1], SEED) for a, b in zip(starts[at : at + (1 << 16)], ends[span - 1 + at :])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(id, fp)``, a row for each document; null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values = [fingerprint(t.as_py(), width) for t in piece.column("text")]
                yield pa.record_batch([piece.column("id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])

    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("fp", LongType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), schema)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the bytes of a 23-bit word, and the error pattern of each syndrome, both built from the generator."""
    single = []
    for i in range(23):
        x = 1 << i
        for j in range(22, 10, -1):
            if x >> j & 1:
                x ^= GENERATOR << (j - 11)
        single.append(x)
    by_byte = np.zeros((3, 256), np.int32)
    for part in range(3):
        for byte in range(256):
            for i in range(8):
                if byte >> i & 1 and 8 * part + i < 23:
                    by_byte[part, byte] ^= single[8 * part + i]
    errors = np.zeros(2048, np.int32)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            syndrome = 0
            for i in places:
                syndrome ^= single[i]
            errors[syndrome] = sum(1 << i for i in places)
    return by_byte, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    by_byte, errors = _tables()
    syndromes = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    return (words ^ errors[syndromes]) >> 11


def segment_keys(words: np.ndarray, width: int) -> np.ndarray:
    """``[n, 6]`` codeword indices of each segment and its single-bit changes, -1 where there are fewer."""
    flips = np.array([0, *(1 << i for i in range(width))], np.int32)
    found = np.sort(decode(words.astype(np.int32)[:, None] ^ flips), axis=1)
    first = np.concatenate([np.ones((len(found), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)
    out = np.full((len(found), 6), -1, np.int64)
    rows, cols = np.nonzero(first)
    out[rows, (np.cumsum(first, axis=1) - 1)[rows, cols]] = found[rows, cols]
    return out


def pair_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket key of each fingerprint with the fingerprint's position."""
    keys, owners = [], []
    each = [segment_keys(fps >> np.uint64(at) & np.uint64((1 << width) - 1), width) for at, width in SEGMENTS]
    for k, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = (k << 24) | (each[i][:, :, None] << 12) | each[j][:, None, :]
        good = (each[i] >= 0)[:, :, None] & (each[j] >= 0)[:, None, :]
        keys.append(both[good])
        owners.append(np.nonzero(good)[0])
    return np.concatenate(keys), np.concatenate(owners)


def _forest(fps: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among distinct fingerprints, breadth first over those not yet reached."""
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= limit
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue += list(found)
                yield np.full(len(found), x, np.uint64), found


def _links(keys: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys; runs of up to 8 are compared at once, longer ones by :func:`_forest`."""
    begin = np.concatenate([[True], keys[1:] != keys[:-1]])
    starts = np.nonzero(begin)[0]
    sizes = np.diff(np.append(starts, len(keys)))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    small = (size_of > 1) & (size_of <= 8)
    k, f = keys[small], fps[small]
    for step in range(1, 8):
        good = (k[step:] == k[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= limit)
        left.append(f[:-step][good])
        right.append(f[step:][good])
    for s, n in zip(starts[sizes > 8], sizes[sizes > 8]):
        for a, b in _forest(np.unique(fps[s : s + n]), limit):
            left.append(a)
            right.append(b)
    return np.concatenate(left), np.concatenate(right)


_EDGES = "a bigint, b bigint, block int"


def _bucket_links(limit: int, most: int):
    """Worker over rows ``(key, fp)`` sorted by key: links as ``(a, b, -1)``; of a bucket over ``most`` rows its rows
    as ``(key, fp, block)`` for :func:`links` to deal out anew. Holds one bucket of at most ``most`` rows at a time."""

    def out(a, b, block) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)), pa.array(block, pa.int32())], ["a", "b", "block"])

    def linked(keys, fps):
        a, b = _links(keys, fps, limit)
        if len(a):
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield out(pairs[0].copy(), pairs[1].copy(), np.full(pairs.shape[1], -1, np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        over, sent = None, 0  # the bucket that is being passed on, and how many of its rows were
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if over is not None:
                n = int(np.searchsorted(keys, over, "right"))
                if n:
                    yield out(keys[:n], fps[:n], (sent + np.arange(n)) // most)
                sent, keys, fps = sent + n, keys[n:], fps[n:]
            if not len(keys):
                continue
            over, cut = None, int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if cut:
                yield from linked(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
            if len(keys) > most:
                over, sent = keys[0], len(keys)
                yield out(keys, fps, np.arange(sent) // most)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from linked(keys, fps)

    return run


def links(fps: DataFrame, limit: int = MAX_BITS, most: int = MOST) -> tuple[DataFrame, list[str]]:
    """Links ``(a, b)`` whose components are those of all pairs of fingerprints at ``limit`` (0 to 4) bits or fewer.

    ``fps``: one bigint column of distinct fingerprints. Also returns the paths of the tables that the result reads.
    """
    if not 0 <= limit <= 4:
        raise ValueError("the keys find links of 0 to 4 bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 4096):
                keys, owners = pair_keys(part := values[at : at + 4096])
                yield pa.record_batch([pa.array(keys), pa.array(part[owners].view(np.int64))], ["key", "fp"])

    buckets = fps.mapInArrow(tidy(keyed), "key bigint, fp bigint")
    found, path = materialise(buckets.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_bucket_links(limit, most)), _EDGES), "buckets")
    edges, paths = found.where("block < 0").select("a", "b"), [path]
    over = found.where("block >= 0")
    if not over.isEmpty():
        blocks = over.groupBy("a").agg((F.max("block") + 1).alias("blocks"))
        dealt = over.join(blocks, "a").select("a", "b", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select(F.xxhash64("a", F.least("block", "other"), F.greatest("block", "other")).alias("key"), F.col("b").alias("fp"))
        more, path = materialise(dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_links(limit, 1 << 62), _EDGES), "blocks")
        edges, paths = edges.union(more.select("a", "b")), [*paths, path]
    return edges, paths


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = SHINGLE, limit: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """``(id_col, fp bigint, component_id)``, a row for each document; the smallest id reachable over links.

    Null, empty and blank texts share fingerprint 0, which links like any other. Repeated rows stay, each with its
    component. A null id never becomes a component's id unless no other is reachable. Other columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    prints, _ = materialise(fingerprints(docs, id_col, text_col, width), "prints")
    classes, kept = materialise(prints.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    edges, used = links(classes.select("fp"), limit, most)
    roots, path = connected_components(edges)
    discard(spark, *used)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    ids, _ = materialise(named.join(firsts, "root").select("fp", "component_id"), "components")
    discard(spark, kept, *path)
    return prints.join(ids, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _located(docs: DataFrame) -> DataFrame:
    """The rows with the file and the place within it that each is read from; rows that do not come straight from files
    are written to the shared folder first."""
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plan, straight = docs._jdf.queryExecution().analyzed(), "_metadata" not in docs.columns
    while straight and plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if straight and plan.nodeName() == "LogicalRelation":
        try:
            return docs.select(row, *place)
        except AnalysisException:  # files of a format without places
            pass
    return materialise(docs.select(row), "documents")[0].select("row", *place)


def _dropped(rows: DataFrame, id_col: str, text_col: str, width: int, limit: int, most: int) -> tuple[DataFrame, list[str]]:
    """``(file, at)`` of the rows that do not stay, and the paths of the tables that the result reads."""
    key = F.struct(F.col(f"row.`{id_col}`").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("at"))
    prints, path = materialise(fingerprints(rows.select(key.alias("key"), F.col(f"row.`{text_col}`").alias("text")), "key", "text", width), "prints")
    order = F.struct(F.col("id.id").isNull(), F.col("id.id"), F.col("id.file"), F.col("id.at"))
    classes, kept = materialise(prints.groupBy("fp").agg(F.min(order).alias("first")), "classes")
    edges, used = links(classes.select("fp"), limit, most)
    roots, root_paths = connected_components(edges)
    discard(prints.sparkSession, *used)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    stay = named.groupBy("root").agg(F.min("first").alias("stay"))
    stay, stay_path = materialise(named.join(stay, "root").select("fp", "stay"), "stay")
    discard(prints.sparkSession, kept, *root_paths)
    gone = F.col("id.id").isNotNull() & (order != F.col("stay"))
    return prints.join(stay, "fp").where(gone).select("id.file", "id.at"), [path, stay_path]


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = SHINGLE, limit: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """The documents that stay, all columns unchanged: of each component the one with the smallest id.

    Of rows that repeat an id within a component one stays; rows without an id always stay. Null, empty and blank texts
    are one component. An empty table gives an empty result.

    Texts are never shuffled. The places of the rows that go are dealt by file, a small table in the shared folder for
    each file that loses any, and whoever reads a file leaves those rows out.
    """
    spark, columns = docs.sparkSession, docs.columns
    rows = _located(docs)
    gone, used = _dropped(rows, id_col, text_col, width, limit, most)
    folder = scratch(spark, "dropped")
    gone.select(F.sha1("file").alias("of"), "at").repartition("of").write.partitionBy("of").parquet(folder)
    discard(spark, *used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        fs, root = pafs.FileSystem.from_uri(folder)
        known: dict[str, np.ndarray] = {}

        def places(file: str) -> np.ndarray:
            if file not in known:
                known.clear()  # a task reads one file after another
                where = f"{root}/of={sha1(file.encode()).hexdigest()}"
                parts = [f for f in fs.get_file_info(pafs.FileSelector(where, allow_not_found=True)) if f.path.endswith(".parquet")]
                known[file] = np.concatenate([np.zeros(0, np.int64), *[pq.read_table(fs.open_input_file(f.path), columns=["at"]).column("at").to_numpy() for f in parts]])
            return known[file]

        for batch in batches:
            at = batch.column("__row").to_numpy(zero_copy_only=False)
            files = batch.column("__file").dictionary_encode()
            stay = np.ones(len(at), bool)
            for code, file in enumerate(files.dictionary.to_pylist()):
                mine = files.indices.to_numpy(zero_copy_only=False) == code
                stay[mine] = ~np.isin(at[mine], places(file))
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(stay))], ["row"])

    kept = rows.mapInArrow(tidy(run), StructType([rows.schema["row"]]))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
