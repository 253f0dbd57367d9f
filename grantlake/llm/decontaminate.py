"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are streamed through the automaton, which keeps the longest suffix of the words read so far that occurs in some
item. Where that suffix has a window's length (an item shorter than a window: the item's length), the words it covers
are hit. The automaton only has to be walked where runs of words could reach a window's length at all: a run of which
each pair of neighbours is also a pair of neighbours in some item. This leaves out no match.

The items are a stated query set. They are cut into blocks of at most ``block_words`` words; tasks build an automaton of
each and write it to the shared folder, and a worker holds one of them at a time, for many texts.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from grantlake.llm.common import pieces, put_file, scratch, tidy

WINDOW = 10
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ASCII = {c: c + 32 for c in range(65, 91)}
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


class SuffixAutomaton:
    """All word runs of several items: ``step`` from state to state, ``link`` to the longest suffix in another state."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _append(self, last: int, word: int) -> int:
        q = self.step[last].get(word)
        if q is not None:  # known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._append(last, w)

    def advance(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while state and word not in self.step[state]:
            state = self.link[state]
            matched = self.length[state]
        found = self.step[state].get(word)
        return (0, 0) if found is None else (found, matched + 1)


class Matcher:
    """The automaton of a block of items with what a worker looks up while it streams."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window, self.vocab, self.auto = window, {}, SuffixAutomaton()
        coded = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for name, words in items if words]
        for _, ids in coded:
            self.auto.add(ids)
        auto = self.auto
        self.least = min((min(window, len(ids)) for _, ids in coded), default=window)
        owners: list[set[str]] = [set() for _ in auto.link]
        ends: list[set[tuple[int, str]]] = [set() for _ in auto.link]
        for name, ids in coded:
            state = matched = 0
            for w in ids:
                state, matched = auto.advance(state, matched, w)
                at = state
                while at > 0 and name not in owners[at]:
                    owners[at].add(name)
                    at = auto.link[at]
            if len(ids) < window:
                ends[state].add((len(ids), name))
        order = sorted(range(len(auto.link)), key=auto.length.__getitem__)
        # Of each state: the items that have its last `window` words, and the short items that it may end with.
        self.full: list[tuple[str, ...]] = [()] * len(order)
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(order)
        top = [0] * len(order)
        for v in order[1:]:
            up = auto.link[v]
            top[v] = (v if auto.length[up] < window else top[up]) if auto.length[v] >= window else 0
            self.full[v] = tuple(sorted(owners[top[v]])) if top[v] else ()
            self.short[v] = tuple(sorted(ends[v])) + self.short[up]
        pairs = {a * len(self.vocab) + b for _, ids in coded for a, b in zip(ids, ids[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches ``[a, b)`` of at least ``least`` words of which each pair of neighbours occurs in some item."""
        if not len(self.vocab) or not len(ids):
            return []
        known = ids >= 0
        joined = np.zeros(len(ids), bool)  # a word with the one before it
        if len(self.pairs) and len(ids) > 1:
            code = ids[:-1] * len(self.vocab) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[1:] = (self.pairs[at] == code) & known[1:] & known[:-1]
        starts = np.nonzero(known & ~joined)[0]
        stops = np.nonzero(known & ~np.append(joined[1:], False))[0] + 1
        long = stops - starts >= self.least
        return list(zip(starts[long].tolist(), stops[long].tolist()))

    def scan(self, ids: list[int], begin: int, spans: list[list[int]], items: set[str]) -> int:
        """Streams one stretch; adds hit word spans ``[a, b)`` and items, returns the longest match."""
        state = matched = longest = 0
        own: list[list[int]] = []  # of this stretch only: other blocks have spans further on
        for i, w in enumerate(ids, begin + 1):
            state, matched = self.auto.advance(state, matched, w)
            longest = max(longest, matched)
            hit = 0
            if matched >= self.window and self.full[state]:
                hit = self.window
                items.update(self.full[state])
            for n, name in self.short[state]:
                if n <= matched:
                    hit = max(hit, n)
                    items.add(name)
            if hit:
                if own and i - hit <= own[-1][1]:
                    own[-1] = [min(own[-1][0], i - hit), i]
                else:
                    own.append([i - hit, i])
        spans += own
        return longest


def _united(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _cut(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans, from each span's first word up to the next word that stays."""
    places = [m.span() for m in _WORD.finditer(text.translate(_ASCII))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b][0] if b < len(places) else places[b - 1][1]
    return "".join([*out, text[at:]])


@lru_cache(maxsize=1)
def _loaded(folder: str, name: str) -> Matcher:
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{root}/{name}") as file:
        return pickle.loads(file.read())


def _blocks(benchmark: DataFrame, item_id: str, text_col: str, window: int, block_words: int) -> tuple[str, list[str]]:
    """Folder and names of the automata's files. Items are dealt by a hash of their id; tasks build and write the
    automata, and the driver gets a name for each. An automaton has at most ``block_words`` words, or one item."""
    spark = benchmark.sparkSession
    folder = scratch(spark, "automata")
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # About six bytes a word; what a hash deals unevenly is cut by the tasks.
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, items, held = TaskContext.get().partitionId(), 0, [], 0

        def put() -> pa.RecordBatch:
            nonlocal made, items, held
            put_file(folder, name := f"block-{part:06d}-{made:06d}", pickle.dumps(Matcher(items, window)))
            made, items, held = made + 1, [], 0
            return pa.RecordBatch.from_pydict({"name": [name]})

        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                if items and held + len(words) > block_words:
                    yield put()
                items.append((item, words))
                held += len(words)
        if items:
            yield put()

    names = rows.repartition(max(1, -(-total // (6 * block_words))), "item").mapInArrow(build, "name string")
    return folder, sorted(r.name for r in names.collect())


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, as many at a time as have about ``most`` bytes of text together."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch, "text", 1_000_000):
            held.append(piece)
            size += pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def scan(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = 300_000, min_span: int | None = None, with_text: bool = False,
) -> DataFrame:
    """``(id_col, n_words, n_hit bigint, longest int, spans array<struct<begin,end>>, items array<string> [, cut string])``.

    A row for each document, repeated ids included. ``spans`` are half-open word ranges covered by matches, sorted and
    apart; ``items`` are sorted as strings. With ``with_text``, ``cut`` is the text without its spans of ``min_span``
    words or more (any length if None), null where nothing is cut. Null and empty texts have no words; an item without
    words matches nothing; a null item id counts as "null"; rows of one item id are one item for ``items``. An empty
    benchmark hits nothing.
    """
    folder, blocks = _blocks(benchmark, item_id, item_text, window, block_words)
    most = 1_000_000 if len(blocks) < 2 else 16_000_000  # more texts at a time where automata take turns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _gathered(batches, most):
            texts = [piece.column("text").to_pylist() for piece in group]
            split = [[words_of(t) for t in some] for some in texts]
            bounds = [np.cumsum([0, *(len(w) + 1 for w in some)]) for some in split]
            spans, items, longest = ([[make() for _ in some] for some in texts] for make in (list, set, int))
            for name in blocks:
                matcher = _loaded(folder, name)
                get = matcher.vocab.get
                for k, some in enumerate(split):
                    ids = np.array([i for words in some for i in [*[get(w, -1) for w in words], -1]], np.int64)
                    for a, b in matcher.runs(ids):
                        d = int(np.searchsorted(bounds[k], a, "right")) - 1
                        at = int(bounds[k][d])
                        longest[k][d] = max(longest[k][d], matcher.scan(ids[a:b].tolist(), a - at, spans[k][d], items[k][d]))
            for piece, *found in zip(group, texts, split, spans, items, longest):
                yield row_of(piece, *found)

    def row_of(piece, texts, split, spans, items, longest) -> pa.RecordBatch:
        spans = [_united(s) for s in spans]
        columns = {
            "id": piece.column("id"),
            "n_words": pa.array([len(w) for w in split], pa.int64()),
            "n_hit": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
            "longest": pa.array(longest, pa.int32()),
            "spans": pa.array([[{"begin": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            "items": pa.array([sorted(s) for s in items], pa.list_(pa.string())),
        }
        if with_text:
            cut = [[s for s in found if s[1] - s[0] >= (min_span or 0)] for found in spans]
            columns["cut"] = pa.array([_cut(t, s) if s else None for t, s in zip(texts, cut)], pa.string())
        return pa.RecordBatch.from_pydict(columns)

    found = "n_words bigint, n_hit bigint, longest int, spans array<struct<begin:int,end:int>>, items array<string>" + ", cut string" * with_text
    schema = StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(found).fields])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)


def digests(scanned: DataFrame) -> DataFrame:
    """Adds ``n_items``, ``items_sha256`` (comma-joined sorted ids) and ``contaminated`` to what :func:`scan` returns."""
    return scanned.withColumns({
        "n_items": F.size("items").cast("bigint"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
        "contaminated": F.col("n_hit") > 0,
    })


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, min_span: int = 1, max_coverage: float = 0.8, chars_col: str | None = "n_chars",
) -> DataFrame:
    """The documents with matched spans of ``min_span`` words or more cut out of their texts; those of which more than
    ``max_coverage`` of the words are hit are left out whole. Documents without a hit keep every column unchanged;
    ``chars_col``, where it exists, counts the new text's code points. Columns are those of ``docs``; a document
    carries its other columns through the scan, so that no join has to find them again.
    """
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = scan(packed, benchmark, "id", "text", item_id=item_id, item_text=item_text, window=window, min_span=min_span, with_text=True)
    kept = found.where((F.col("n_hit") == 0) | (F.col("n_hit") <= F.col("n_words") * max_coverage))
    text = F.coalesce("cut", f"id.`{text_col}`")

    def column(c: str):
        if c == text_col:
            return text.alias(c)
        if c == chars_col:
            return F.when(F.col("cut").isNull(), F.col(f"id.`{c}`")).otherwise(F.length("cut")).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"id.`{c}`").alias(c)

    return kept.select(*[column(c) for c in docs.columns])
