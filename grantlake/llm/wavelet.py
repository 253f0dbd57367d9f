"""Token ids as wavelet matrices: one compressed file per shard, read with rank and select.

File: ``MAGIC``, the header's length as 4 little-endian bytes, a JSON header, then zstd blocks. Blocks hold the ids and
token counts of the documents (one block each) and the bit-planes, from the most significant bit down, cut into blocks
of ``BLOCK_BITS`` bits. The header has of each plane how many zeros it has, where its blocks lie and how many ones come
before each, so that access, counting and lookup decompress the blocks they touch and no others.
"""

from __future__ import annotations

import binascii
import gc
import json
import os
import struct
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import chain, cycle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.common import pieces, put_file, scratch, tidy

MAGIC = b"WVM1"
BLOCK_BITS = 1 << 19
SHARD_TOKENS = 1 << 22
END_ID = 1


def build(ids: np.ndarray, doc_ids: list, counts: np.ndarray) -> bytes:
    """Bytes of a shard's file: the token ids, and the id and token count of each document in order."""
    wide = np.asarray(ids, np.uint32)
    levels = max(1, int(wide.max()).bit_length() if len(wide) else 1)
    now = wide.astype(np.uint16) if levels <= 16 else wide
    pack = zstandard.ZstdCompressor(level=1).compress
    blobs = [pack(json.dumps(doc_ids).encode()), pack(np.asarray(counts, "<i8").tobytes())]
    planes = []
    for level in range(levels - 1, -1, -1):
        bits = (now >> level & 1).astype(bool)
        ones, places = [], []
        before = 0
        for at in range(0, len(bits), BLOCK_BITS):
            part = bits[at : at + BLOCK_BITS]
            ones.append(before)
            places.append(len(blobs))
            blobs.append(pack(np.packbits(part, bitorder="little").tobytes()))
            before += int(np.count_nonzero(part))
        planes.append({"zeros": len(bits) - before, "ones": ones, "blocks": places})
        now = np.concatenate([np.compress(~bits, now), np.compress(bits, now)])
    ends = np.cumsum([0, *map(len, blobs)]).tolist()
    header = json.dumps({"n": len(wide), "docs": len(doc_ids), "planes": planes, "ends": ends}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *blobs])


class Shard:
    """A shard's file, read through ``data`` (bytes or a memory map)."""

    def __init__(self, data) -> None:
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", data[4:8])[0]
        self._data, self._body = data, 8 + size
        head = json.loads(bytes(data[8 : 8 + size]))
        self.n, self.docs, self._planes, self._ends = head["n"], head["docs"], head["planes"], head["ends"]
        self._unpack = zstandard.ZstdDecompressor().decompress
        self._kept: dict[int, np.ndarray] = {}

    def _blob(self, k: int) -> bytes:
        return self._unpack(bytes(self._data[self._body + self._ends[k] : self._body + self._ends[k + 1]]))

    def documents(self) -> tuple[list, np.ndarray]:
        """Ids and token counts of the documents, in order."""
        return json.loads(self._blob(0)), np.frombuffer(self._blob(1), "<i8")

    def _bytes(self, level: int, block: int) -> np.ndarray:
        k = self._planes[level]["blocks"][block]
        if k not in self._kept:
            if len(self._kept) >= 64:
                self._kept.clear()
            self._kept[k] = np.frombuffer(self._blob(k), np.uint8)
        return self._kept[k]

    def _bit(self, level: int, i: int) -> int:
        block, at = divmod(i, BLOCK_BITS)
        return int(self._bytes(level, block)[at >> 3] >> (at & 7) & 1)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among a plane's first ``i`` bits."""
        plane = self._planes[level]
        if i >= self.n:
            return self.n - plane["zeros"]
        block, at = divmod(i, BLOCK_BITS)
        part = self._bytes(level, block)
        last = int(part[at >> 3] & ((1 << (at & 7)) - 1)).bit_count() if at & 7 else 0
        return plane["ones"][block] + int(np.bitwise_count(part[: at >> 3]).sum(dtype=np.int64)) + last

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of a plane's ``k``-th bit (from 0) of the value ``bit``."""
        before = self._planes[level]["ones"]
        counts = before if bit else [b * BLOCK_BITS - o for b, o in enumerate(before)]
        block = bisect_right(counts, k) - 1
        n = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        bits = np.unpackbits(self._bytes(level, block), count=n, bitorder="little")
        return block * BLOCK_BITS + int(np.nonzero(bits == bit)[0][k - counts[block]])

    def access(self, i: int) -> int:
        """The token at place ``i``."""
        value = 0
        for level, plane in enumerate(self._planes):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            value, i = value << 1 | bit, plane["zeros"] + ones if bit else i - ones
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences of ``[begin, end)`` lie in the order below the last plane."""
        if token >> len(self._planes):
            return 0, 0
        for level, plane in enumerate(self._planes):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            one = token >> (len(self._planes) - 1 - level) & 1
            begin, end = (plane["zeros"] + a, plane["zeros"] + b) if one else (begin - a, end - b)
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        a, b = self._range(token, begin, self.n if end is None else end)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Place of the token's ``k``-th occurrence (from 0); ``IndexError`` beyond the last."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(len(self._planes) - 1, -1, -1):
            one = token >> (len(self._planes) - 1 - level) & 1
            at = self._select(level, one, at - self._planes[level]["zeros"] if one else at)
        return at

    def tokens(self) -> np.ndarray:
        """All tokens, from the planes taken in reverse."""
        levels = len(self._planes)
        now = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            plane = self._planes[level]
            bits = np.concatenate([np.zeros(0, bool), *[np.unpackbits(np.frombuffer(self._blob(k), np.uint8), count=min(BLOCK_BITS, self.n - b * BLOCK_BITS), bitorder="little").view(bool) for b, k in enumerate(plane["blocks"])]])
            up = np.empty_like(now)
            # Places as numbers: assigning through a mask of random bits takes about twice as long.
            up[np.flatnonzero(~bits)] = now[: plane["zeros"]]
            up[np.flatnonzero(bits)] = now[plane["zeros"] :] | now.dtype.type(1 << (levels - 1 - level))
            now = up
        return now.astype(np.uint32)


class Encoder:
    """Encodes texts as the tokenizer does, a unit at a time, each distinct unit once.

    A unit is a stretch between blanks or, where the tokenizer parts letters, digits and full stops and the like from
    each other and folds letter case (:meth:`_parts` checks both; letters are those of ASCII and À to ÿ), such a run
    within a stretch in lower case. Units are found, hashed to 128 bits and looked up as arrays of bytes, so that only units not met before become
    Python strings and go to the library. Tokenizers that join what blanks part are used text by text.
    """

    MOST = 600_000
    SLOTS = 1 << 20  # more than MOST
    LONG = 256  # longer units are encoded where they stand and not remembered

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_stretch = self.checked()
        self.parts = self.by_stretch and self._parts()
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = self._word_ends()
        # Lower-case letters up to ÿ need no normalising and no splitting: the library's model takes them as they are,
        # with the characters that stand for their bytes.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        known = sorted(t[:-4] for t in self.tokenizer.get_vocab() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t.islower())
        some = [a + c + b for a, b, c in zip(known[::40], known[7::37], cycle(["", *map(chr, [*range(223, 247), *range(248, 256)])]))]
        if not some or self._one(" ".join(some)) != self.plain.encode(" ".join(map(_as_bytes, some)), add_special_tokens=False).ids:
            self.plain = None
        self._clear()

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def checked(self) -> bool:
        one, probes = self._one, ["a", "Ab1", "don't", "é", "́x", "<|endoftext|>", "...", " ", "日本"]
        blank = any(t.lstrip or t.rstrip or len(t.content.split()) != 1 or t.content.strip() != t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        return not blank and all(one(f"{a}{s}{b}") == one(a) + one(b) for s in (" ", "\n", "\t", "\r", " \n ") for a in probes for b in probes)

    def _parts(self) -> bool:
        """Whether the tokenizer takes runs of letters, single digits and punctuation for themselves, in either case."""
        one, letters = self._one, ["a", "Ab", "don't", "é's", "xyz", "S", "é", "ß", "Ü", "aÿ"]
        marks, digits = [*_MARKS, "...", "?!"], ["0", "7", "5"]
        pairs = [(letters, digits), (letters, marks), (digits, letters), (digits, marks), (digits, digits), (marks, digits), (marks, letters)]
        fits = all(one(a + b) == one(a) + one(b) for x, y in pairs for a in x for b in y)
        return fits and all(one(c) == one(c.lower()) and one(f"x{c}y") == one(f"x{c.lower()}y") for c in map(chr, [*range(65, 91), *range(192, 215), *range(216, 223)]))

    def _word_ends(self) -> np.ndarray | None:
        """Of each id whether its token ends a word; None if this tokenizer has no such tokens."""
        ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        return ends if ends.any() else None

    def _clear(self) -> None:
        self._n = 0
        self._keys = np.zeros((2, self.SLOTS), np.uint64)
        self._slots = np.full(self.SLOTS, -1, np.int32)
        self._pool, self._starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units on end, and how many each has. Words of letters are encoded many in a text, as each ends
        with a token that ends a word."""
        order, found, sizes = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        single, simple, latin, other = [], [], [], []
        for i, u in enumerate(units):
            (single if self.ends is None or not u.isalpha() else other if not self.plain or not u.islower() else simple if u.isascii() else latin if max(u) <= "ÿ" else other).append(i)
        for tokenizer, places, spelt in ((self.plain, simple, str), (self.plain, latin, _as_bytes), (self.tokenizer, other, str)):
            groups = [places[k : k + 1000] for k in range(0, len(places), 1000)]
            for group, e in zip(groups, tokenizer.encode_batch_fast([spelt(" ".join([units[i] for i in g])) for g in groups], add_special_tokens=False) if groups else ()):
                ids = np.array(e.ids, np.uint32)
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) == len(group) and cuts[-1] == len(ids):
                    order += group
                    found.append(ids)
                    sizes.append(np.diff(cuts, prepend=0))
                else:
                    single += group
        each = [e.ids for e in self.tokenizer.encode_batch_fast([units[i] for i in single], add_special_tokens=False)]
        order += single
        found.append(np.fromiter(chain.from_iterable(each), np.uint32))
        sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        flat, size = np.concatenate(found), np.concatenate(sizes)
        back = np.argsort(np.array(order, np.int64), kind="stable")
        return _ranges(flat, (np.cumsum(size) - size)[back], size[back]), size[back]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each unit among those known, or -1."""
        out, at = np.empty(keys.shape[1], np.int32), (keys[0] >> np.uint64(44)).astype(np.int64)
        found = self._slots[at]
        out[:] = found
        left = np.flatnonzero((found >= 0) & ((self._keys[0][at] != keys[0]) | (self._keys[1][at] != keys[1])))
        at = at[left]
        while len(left):
            at = (at + 1) % self.SLOTS
            found = self._slots[at]
            out[left] = found
            more = (found >= 0) & ((self._keys[0][at] != keys[0][left]) | (self._keys[1][at] != keys[1][left]))
            left, at = left[more], at[more]
        return out

    def _insert(self, keys: np.ndarray) -> None:
        """Gives distinct new units the next places, in order."""
        places = np.arange(self._n, self._n + keys.shape[1], dtype=np.int32)
        self._n += len(places)
        at = (keys[0] >> np.uint64(44)).astype(np.int64)
        while len(places):
            free = self._slots[at] < 0
            self._slots[at[free]] = places[free]
            won = self._slots[at] == places
            self._keys[:, at[won]] = keys[:, won]
            places, keys, at = places[~won], keys[:, ~won], (at[~won] + 1) % self.SLOTS

    def _places(self, data: bytes, begins: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        places = self._find(keys)
        while len(new := np.flatnonzero(places < 0)):
            # One of each first half of the keys; another unit with the same half is found new again.
            first = new[np.unique(keys[0][new], return_index=True)[1]]
            if self._n and self._n + len(first) > self.MOST:
                self._clear()
                places = self._find(keys)
                continue
            ids, sizes = self._ids([data[a:b].decode() for a, b in zip(begins[first].tolist(), ends[first].tolist())])
            self._pool = np.concatenate([self._pool, ids])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
            self._insert(keys[:, first])
            places[new] = self._find(keys[:, new])
        return places

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, each with :data:`END_ID` behind it, and the number of ids of each."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not self.by_stretch:
            ids = [[*e.ids, END_ID] for e in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], np.int64)
        texts = pc.fill_null(texts, "")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = bytes(memoryview(texts.buffers()[2])[bounds[0] : bounds[-1]]) if bounds[-1] > bounds[0] else b""
        bounds = bounds - bounds[0]
        folded = _folded(data)
        parts = self.parts and not any(a in folded for a in self.added)
        data = folded if parts else data
        begins, ends = _units(data, bounds, parts)
        flat, sizes = self._encode_units(data, begins, ends)
        in_text = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(begins, bounds)]
        out = np.full(len(flat) + len(texts), END_ID, np.uint32)
        keep = np.ones(len(out), bool)
        keep[in_text[1:] + np.arange(len(texts))] = False
        out[keep] = flat
        return out, np.diff(in_text) + 1

    def _encode_units(self, data: bytes, begins: np.ndarray, ends: np.ndarray, step: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
        """Fewer units at a time than the table holds; ones over ``LONG`` bytes are encoded where they stand."""
        raw, flats, all_sizes = np.frombuffer(data + bytes(self.LONG + 8), np.uint8), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        long = np.flatnonzero(ends - begins > self.LONG).tolist()
        cuts = sorted({0, len(begins), *long, *(i + 1 for i in long), *range(0, len(begins), step)})
        for a, b in zip(cuts, cuts[1:]):
            if ends[a] - begins[a] > self.LONG:
                ids, sizes = self._ids([data[begins[a] : ends[a]].decode()])
            else:
                places = self._places(data, begins[a:b], ends[a:b], _hashes(raw, begins[a:b], ends[a:b]))
                first = self._starts[places]
                sizes = self._starts[places + 1] - first
                ids = _ranges(self._pool, first, sizes)
            flats.append(ids)
            all_sizes.append(sizes)
        return np.concatenate(flats), np.concatenate(all_sizes)


_MARKS = ".,;:!?"
_BLANK = np.isin(np.arange(256), list(b" \n\t\r"))
_KIND = np.array([1 if 97 <= c <= 122 or 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if chr(c) in _MARKS else 0 for c in range(256)], np.uint8)
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


#: The characters by which byte-level tokenizers spell bytes; a blank stays one.
_SPELT = {b: chr(256 + n) for n, b in enumerate([*range(33), *range(127, 161), 173])} | {32: " "}


def _as_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_SPELT)


def _latin(raw: np.ndarray) -> np.ndarray:
    """Where a two-byte letter À to ÿ begins, in UTF-8."""
    return (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)


def _folded(data: bytes) -> bytes:
    """A-Z and À-Þ in lower case."""
    out = bytearray(data.lower())  # of bytes: A-Z only
    raw = np.frombuffer(out, np.uint8)
    raw[1:][_latin(raw) & (raw[1:] < 0x9F)] += 0x20
    return bytes(out)


def _units(data: bytes, bounds: np.ndarray, parts: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin and end: at blanks, at the texts' bounds and, with ``parts``, where the kind of character
    changes between letters, digits and marks, and between digits."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[raw]
    cut = np.zeros(len(raw) + 1, bool)  # a unit may begin here
    cut[1:-1] = ~inside[:-1]
    if parts:
        kind, latin = _KIND[raw], _latin(raw)
        kind[:-1][latin] = kind[1:][latin] = 1
        cut[1:-1] |= (kind[:-1] * kind[1:] > 0) & ((kind[:-1] != kind[1:]) | (kind[1:] == 2))
    cut[bounds] = True
    after = cut[1:].copy()
    after[:-1] |= ~inside[1:]
    after[-1:] = True
    return np.flatnonzero(cut[:-1] & inside), np.flatnonzero(after & inside) + 1


def _hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each unit, from eight bytes at a time and the length."""
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    size = ends - begins
    out = np.stack([size.astype(np.uint64) * odd for odd in _ODD])
    rows = np.arange(len(begins))
    for at in range(0, int(size.max(initial=0)), 8):
        if at:
            rows = rows[size[rows] > at]
        word = eight[begins[rows] + at] & _LOW[np.minimum(size[rows] - at, 8)]
        for lane, odd in zip(out, _ODD):
            mixed = (lane[rows] ^ word) * odd
            mixed ^= mixed >> np.uint64(29)
            lane[rows] = mixed * _ODD[1]
    out ^= out >> np.uint64(32)
    return out * _ODD[0]


def _ranges(pool: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pool's stretches of ``sizes`` entries from ``first``, on end."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process: what it has learned serves the tasks that follow. Tasks are what runs in
    parallel here; the library's threads would wait on each other for most of their time."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def write_shards(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", *, shard_tokens: int = SHARD_TOKENS) -> list[dict]:
    """Writes the documents in ascending id order (null ids first; equal ids by a hash of their texts) as shards of
    about ``shard_tokens`` ids, a longer document being a shard of its own. Returns a row per shard in order: name,
    docs, tokens, bytes and ``start``, the number of ids in the shards before it. Null texts count as empty.

    Documents are dealt by ranges of their ids, so each task writes a run of them; the driver gets a row per file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        ids, names, counts, held, made = [], [], [], 0, 0

        def flush():
            nonlocal ids, names, counts, held, made
            size = np.concatenate(counts)
            data = build(np.concatenate(ids), names, size)
            put_file(folder, name := f"shard-{part:06d}-{made:06d}.wvm", data)
            row = [part, made, name, len(names), int(size.sum()), len(data)]
            ids, names, counts, held, made = [], [], [], 0, made + 1
            return pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("part", "seq", "name", "docs", "tokens", "bytes"), row)})

        gc.disable()  # millions of small strings and no cycles: scanning them is a quarter of the time
        for batch in batches:
            for piece in pieces(batch, "text", 2_000_000):
                found, sizes = encoder.encode(piece.column("text"))
                at = 0
                for begin, end in _runs(sizes, shard_tokens, held):
                    if begin and names:
                        yield flush()
                    n = int(sizes[begin:end].sum())
                    ids.append(found[at : at + n])
                    names += piece.column("id").slice(begin, end - begin).to_pylist()
                    counts.append(sizes[begin:end])
                    held, at = held + n, at + n
        gc.enable()
        if names:
            yield flush()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("h"))
    dealt = rows.repartitionByRange(F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h").select("id", "text")
    made = dealt.mapInArrow(tidy(run), "part bigint, seq bigint, name string, docs bigint, tokens bigint, bytes bigint")
    shards = sorted((r.asDict() for r in made.collect()), key=lambda s: (s["part"], s["seq"]))
    start = 0
    for s in shards:
        s["start"] = start
        start += s["tokens"]
    return shards


def _runs(sizes: np.ndarray, most: int, held: int) -> Iterator[tuple[int, int]]:
    """Runs of documents ``[begin, end)``; a shard ends before each run but the first."""
    begin = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most and i > begin:
            yield begin, i
            begin, held = i, 0
        held += n
    yield begin, len(sizes)


def read_shards(spark, folder: str, shards: list[dict], id_type: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32 bigint)`` of each document, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with fs.open_input_stream(f"{root}/{name}") as file:
                    shard = Shard(file.read())
                ids, counts = shard.documents()
                raw, ends = memoryview(shard.tokens().astype("<u4")).cast("B"), np.cumsum(counts)
                crcs = [binascii.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(start + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = pa.string() if id_type == "string" else pa.int64()
    rows = spark.createDataFrame([(s["name"], s["start"]) for s in shards], "name string, start bigint")
    return rows.repartition(max(1, len(shards))).mapInArrow(tidy(run), f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards to ``folder`` (a new one in the shared folder if None) and returns what their files say of
    each document, see :func:`write_shards` and :func:`read_shards`. Repeated rows are documents of their own; other
    columns are not read; an empty table gives no shard and an empty result."""
    folder = folder or scratch(docs.sparkSession, "wavelet")
    kind = "string" if docs.schema[id_col].dataType.simpleString() == "string" else "bigint"
    shards = write_shards(docs, tokenizer, folder, id_col, text_col, shard_tokens=shard_tokens)
    return read_shards(docs.sparkSession, folder, shards, kind).withColumnRenamed("doc_id", id_col)
