"""Full-text search: tokens with positions, queries as a small tree, matching and ranking as expressions.

A document is ``array<struct<lexeme,pos>>``. The ``simple`` configuration lower-cases words; ``english`` also drops
stop words, whose positions still count, and stems what is left. Words are runs of letters, digits and underscores;
other token kinds of a database's parser (hosts, paths, signed numbers, compounds as a whole) are not told apart.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from grantlake.functions.porter2 import STOP, stem

WORD = r"(?U)[\p{L}\p{N}_]+"
DOTTED = "\u0130"
MOST_POSITIONS, LAST_POSITION, WEIGHT = 256, 16383, 0.1


def tokens(text: Column) -> Column:
    """``simple`` tokens of a text, positions from 1. A dotted capital I is an i, as in the database: Java would put a mark
    after it, which parts a word."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(DOTTED), F.lit("i")))
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w, i: F.struct(w.alias("lexeme"), (i + 1).alias("pos")))


@F.arrow_udf(ArrayType(StringType()))
def _stems(words: pa.Array) -> pa.Array:
    """Of each array of words their stems, null for stop words; each distinct word of a batch is stemmed once."""
    coded = words.flatten().dictionary_encode()
    known = pa.array([None if w in STOP else stem(w) for w in coded.dictionary.to_pylist()], pa.string())
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(words), 0).cast(pa.int32()))
    return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), known.take(coded.indices))


#: Not moved below a condition on the stems, for which they would be worked out once more.
_once = _stems.asNondeterministic()


def english(df: DataFrame, key: str, column: str) -> DataFrame:
    """Replaces ``simple`` tokens by English ones, where the rows lie: nothing is shuffled. ``key`` is not needed."""
    stems = _once(F.transform(F.col(column), lambda t: t["lexeme"]))
    made = F.zip_with(stems, F.col(column), lambda s, t: F.struct(s.alias("lexeme"), t["pos"].alias("pos")))
    return df.withColumn(column, F.filter(made, lambda t: t["lexeme"].isNotNull()))


@dataclass(frozen=True)
class Node:
    """``kind`` is term, phrase, and, or, not; a term's or phrase's ``words`` are lexemes with their offsets."""

    kind: str
    words: tuple[tuple[str, int], ...] = ()
    parts: tuple[Node, ...] = ()

    def lexemes(self) -> list[str]:
        """Distinct lexemes that the query asks for (not those it excludes), in order."""
        if self.kind == "not":
            return []
        return list(dict.fromkeys([w for w, _ in self.words] + [x for p in self.parts for x in p.lexemes()]))


def _lexed(text: str, config: str) -> list[tuple[str, int]]:
    words = [w.replace(DOTTED, "i").lower() for w in re.findall(r"\w+", text)]
    if config == "simple":
        return [(w, i) for i, w in enumerate(words)]
    return [(stem(w), i) for i, w in enumerate(words) if w not in STOP]


def _join(kind: str, parts: list[Node | None]) -> Node | None:
    there = [p for p in parts if p is not None]
    return there[0] if len(there) == 1 else Node(kind, parts=tuple(there)) if there else None


def plain(text: str, config: str = "simple") -> Node | None:
    """All words, in any order; None where no word is left."""
    return _join("and", [Node("term", ((w, 0),)) for w, _ in dict.fromkeys((w, 0) for w, _ in _lexed(text, config))])


def phrase(text: str, config: str = "simple") -> Node | None:
    """The words next to each other, in order; a stop word between keeps its place."""
    words = _lexed(text, config)
    if not words:
        return None
    return Node("term", ((words[0][0], 0),)) if len(words) == 1 else Node("phrase", tuple((w, i - words[0][1]) for w, i in words))


def any_of(keywords: list[str], mode: str = "stemmed") -> Node | None:
    """Keywords OR-ed: ``stemmed`` and ``exact_words`` take each as words, ``exact_phrase`` as a phrase. Blank ones are
    left out; ``ValueError`` if none is left or the mode is unknown."""
    modes = {"stemmed": (plain, "english"), "exact_words": (plain, "simple"), "exact_phrase": (phrase, "simple")}
    if mode not in modes:
        raise ValueError(f"search_mode must be one of {sorted(modes)}")
    filled = [k for k in keywords if k and k.strip()]
    if not filled:
        raise ValueError("at least one keyword is needed")
    make, config = modes[mode]
    return _join("or", [make(k, config) for k in filled])


def websearch(text: str, config: str = "english") -> Node | None:
    """AND by default, ``OR``, ``-word`` and ``"a phrase"``; any text is a query."""
    parts: list[list[Node | None]] = [[]]
    for quoted, minus, bare in re.findall(r'(-?"[^"]*"?)|(?:(?<!\S)(-))?([^\s"]+)', text or ""):
        if quoted:
            node, negative = phrase(quoted.strip('-"'), config), quoted.startswith("-")
        elif bare.lower() == "or":
            parts.append([])
            continue
        else:
            bare = bare.lstrip("-") if bare.startswith("-") else bare
            node, negative = phrase(bare, config), bool(minus)
        if node is not None:
            parts[-1].append(Node("not", parts=(node,)) if negative else node)
    return _join("or", [_join("and", p) for p in parts])


def places(doc: Column, lexeme: str) -> Column:
    """All positions of a lexeme."""
    return F.transform(F.filter(doc, lambda t: t["lexeme"] == lexeme), lambda t: t["pos"])


def positions(doc: Column, lexeme: str) -> Column:
    """Positions of a lexeme that ranks count, at most 256."""
    return F.slice(places(doc, lexeme), 1, MOST_POSITIONS)


def matches(doc: Column, q: Node | None) -> Column:
    """Whether a document satisfies a query; the empty query fits nothing."""
    if q is None:
        return F.lit(False)
    if q.kind == "term":
        return F.exists(doc, lambda t: t["lexeme"] == q.words[0][0])
    if q.kind == "phrase":
        # Where the phrase would begin, by each of its words; hashed, so the work grows with the words' occurrences.
        begins = [F.transform(places(doc, w), _earlier(gap)) if gap else places(doc, w) for w, gap in q.words]
        return F.size(reduce(F.array_intersect, begins)) > 0
    found = [matches(doc, p) for p in q.parts]
    return ~found[0] if q.kind == "not" else reduce(lambda a, b: a & b if q.kind == "and" else a | b, found)


def _earlier(gap: int):
    return lambda p: p - gap


def rank(doc: Column, q: Node | None) -> Column:
    """Frequency rank. With one lexeme or an OR at the root: of each lexeme ``0.1 * sum(1 / j^2)`` over its
    occurrences, scaled by pi^2 / 6 and averaged over the query's lexemes. With an AND or a phrase at the root: over
    all pairs of positions of different lexemes the closeness of the pair, combined as chances."""
    words = q.lexemes() if q else []
    if not words:
        return F.lit(0.0)
    if q.kind in ("or", "not") or len(words) == 1:
        # No occurrence past the 256th counts, so the partial sums are constants.
        sums = [0.0]
        for j in range(1, MOST_POSITIONS + 1):
            sums.append(sums[-1] + 1.0 / (j * j))
        table = F.array(*[F.lit(WEIGHT * s / 1.64493406685) for s in sums])
        return sum((F.get(table, F.size(positions(doc, w))) for w in words), F.lit(0.0)) / len(words)
    out = F.lit(0.0)
    for a, b in combinations(words, 2):
        others = positions(doc, b)
        pairs = F.flatten(F.transform(positions(doc, a), _gaps(others)))
        near = lambda d: F.when(d > 100, 1e-30).otherwise(F.sqrt(F.lit(WEIGHT * WEIGHT) / (1.005 + 0.05 * F.exp(d / 1.5 - 2))))
        out = F.aggregate(F.filter(pairs, lambda d: d > 0), out, lambda r, d: 1 - (1 - r) * (1 - near(d)))
    return F.when(out > 0, out).otherwise(F.lit(1e-20))


def _gaps(others: Column):
    return lambda p: F.transform(others, lambda o: F.abs(p - o))


def _covers(places: list[tuple[int, str]], words: set[str]) -> list[tuple[int, int]]:
    """Shortest stretches that hold every word and contain no other such stretch."""
    out, last, left = [], {}, 0
    for i, (_, w) in enumerate(places):
        last[w] = i
        if len(last) == len(words):
            begin = min(last.values())
            if begin >= left:
                out.append((begin, i))
                left = begin + 1
    return out


def cover_density(q: Node | None):
    """Expression ``doc -> double``: the sum over covers of weight over how much more than the query's words they
    hold. A branch of an OR that a document satisfies gives covers of its own words. Places past the 16383rd count as
    that one."""
    branches = [p.lexemes() for p in q.parts] if q and q.kind == "or" else [q.lexemes()] if q else []

    def of(doc) -> float:
        total = 0.0
        for words in branches:
            wanted = set(words)
            found = sorted((min(t["pos"], LAST_POSITION), t["lexeme"]) for t in doc if t["lexeme"] in wanted)
            for a, b in _covers(found, wanted):
                inside = found[a : b + 1]
                noise = max(0, (inside[-1][0] - inside[0][0]) - (len(inside) - 1))
                total += len(inside) / sum(1 / WEIGHT for _ in inside) / (1 + noise)
        return total

    @F.pandas_udf(DoubleType())
    def density(docs: pd.Series) -> pd.Series:
        return docs.map(lambda d: of(d) if d is not None else math.nan)

    words = sorted({w for branch in branches for w in branch})
    return lambda doc: density(F.filter(doc, lambda t: t["lexeme"].isin(words) if words else F.lit(False)))  # Python gets the query's words only


def inverted_index(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(lexeme, key, positions)`` with all positions, to be stored sorted by lexeme: a query reads its own lexemes'
    rows only."""
    each = df.select(key, F.explode(column).alias("t")).groupBy(F.col("t.lexeme").alias("lexeme"), key)
    return each.agg(F.array_sort(F.collect_list("t.pos")).alias("positions"))


def fits_empty(q: Node) -> bool:
    """Whether a document without any word satisfies a query, as one of exclusions only."""
    if q.kind in ("term", "phrase"):
        return False
    found = [fits_empty(p) for p in q.parts]
    return not found[0] if q.kind == "not" else all(found) if q.kind == "and" else any(found)


def _named(q: Node) -> set[str]:
    """All lexemes of a query, excluded ones too."""
    return {w for w, _ in q.words}.union(*[_named(p) for p in q.parts])


def find(index: DataFrame, key: str, q: Node | None, scan: DataFrame | None = None) -> DataFrame:
    """``(key, doc)`` of the documents that satisfy a query; ``doc`` holds the query's own lexemes. Only their rows of
    the index are read. No index knows the documents that a query of exclusions only asks for: such a query reads
    ``scan``, of ``(key, doc)``, and is a ``ValueError`` without it."""
    if q is not None and fits_empty(q):
        if scan is None:
            raise ValueError("a query of exclusions only cannot be answered from the index")
        return scan.where(matches(F.col("doc"), q)).select(key, "doc")
    rows = index.where(F.col("lexeme").isin(sorted(_named(q))) if q else F.lit(False))
    docs = rows.groupBy(key).agg(F.flatten(F.collect_list(F.transform("positions", lambda p: F.struct(F.col("lexeme").alias("lexeme"), p.alias("pos"))))).alias("doc"))
    return docs.where(matches(F.col("doc"), q))


def search_index(index: DataFrame, key: str, q: Node | None) -> DataFrame:
    """Keys of the index's documents that satisfy a query."""
    return find(index, key, q).select(key)
