"""Similarity of texts: of a pair, of many pairs in columns, and of the pairs of a tile of two tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LONGEST = 64  # characters of a text that is compared in columns; longer ones go one by one
WIDEST = 256  # that the longer of two texts may have for its edit distance in columns
STEP, AT_ONCE, TABLE = 1 << 19, 1 << 14, 1 << 22  # pairs held and pairs scored at a time, entries of a table of letters


def jaro_winkler(a: str | None, b: str | None, scale: float = 0.1, boost_above: float = 0.7) -> float:
    """Jaro similarity, raised by a common prefix of up to four characters where it is above 0.7; 0 for an empty text."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    m = len(hits)
    moved = sum(x != y for x, y in zip(hits, [c for c, t in zip(b, taken) if t])) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= boost_above:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1 - jaro)


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts as rows of one matrix, 0 past the end, and lengths."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), max(1, lengths.max(initial=0))), dtype=np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out, lengths


def _in_order(codes: np.ndarray, taken: np.ndarray, width: int) -> np.ndarray:
    """The taken code points of each row, moved to its beginning."""
    out = np.zeros((len(codes), width), dtype=np.uint32)
    rows, columns = np.nonzero(taken)
    out[rows, (np.cumsum(taken, axis=1) - 1)[rows, columns]] = codes[rows, columns]
    return out


def jaro_winkler_of(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, scale: float = 0.1, boost_above: float = 0.7) -> np.ndarray:
    """:func:`jaro_winkler` of many pairs at once, given as code points and lengths; the same to the last bit."""
    n, reach, at = len(a), np.maximum(0, np.maximum(la, lb) // 2 - 1), np.arange(b.shape[1])
    free, hit, every = at < lb[:, None], np.zeros(a.shape, dtype=bool), np.arange(n)
    for i in range(a.shape[1]):
        fits = (b == a[:, i : i + 1]) & free & (np.abs(at - i) <= reach[:, None])
        first = fits.argmax(axis=1)
        hit[:, i] = fits[every, first] & (i < la)
        free[every, first] &= ~hit[:, i]
    width = min(a.shape[1], b.shape[1])
    moved = (_in_order(a, hit, width) != _in_order(b, (at < lb[:, None]) & ~free, width)).sum(axis=1) // 2
    m = hit.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - moved) / m) / 3, 0.0)
    most = min(4, width)
    same = (a[:, :most] == b[:, :most]) & (np.arange(most) < np.minimum(la, lb)[:, None])
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    equal = (la == lb) & (m == la) & (moved == 0) & (la > 0)
    return np.where(equal, 1.0, np.where(jaro > boost_above, jaro + prefix * scale * (1 - jaro), jaro))


def edits(a: str, b: str) -> int:
    """Levenshtein distance, in code points."""
    codes, at = _coded([b])[0][0, : len(b)], np.arange(len(b) + 1)
    row = at
    for i, c in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))
        row = np.minimum.accumulate(np.concatenate([[i], step]) - at) + at
    return int(row[-1])


def edits_of(places: np.ndarray, at: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """:func:`edits` of many pairs at once. ``b`` has letters as numbers; ``places[at]`` has, by letter, its places in the
    first text as the bits of a number. So is a column of the table of distances: its steps up and its steps down (Myers)."""
    one = np.uint64(1)
    last = np.where(la > 0, one << np.maximum(la - 1, 0).astype(np.uint64), np.uint64(0))
    up, down, out = np.full(len(la), ~np.uint64(0)), np.zeros(len(la), dtype=np.uint64), np.where(la > 0, la, lb)
    for j in range(b.shape[1]):
        same, there = places[at, b[:, j]], j < lb
        level = (((same & up) + up) ^ up) | same | down
        more, less = down | ~(level | up), level & up
        out = out + (there & ((more & last) != 0)) - (there & ((less & last) != 0))
        more = (more << one) | one
        up, down = (less << one) | ~(level | more), level & more
    return out


class Texts:
    """The distinct texts of two columns, by number, and what pairs of them score."""

    def __init__(self, left: pa.ChunkedArray, right: pa.ChunkedArray):
        coded = pa.chunked_array([*left.chunks, *right.chunks], left.type).combine_chunks().dictionary_encode()
        self.texts, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.left, self.right = at[: len(left)], at[len(left) :]
        self.codes = _coded([t if len(t) <= WIDEST else "" for t in self.texts])[0]
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        known = np.zeros(0x110000, dtype=bool)
        known[self.codes] = True
        self.letters, self.numbers = int(known.sum()), (np.cumsum(known, dtype=np.int32) - 1)[self.codes]

    def _cut(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[at]
        return codes[at, : max(1, lengths.max(initial=0))], lengths

    def _each(self, a: np.ndarray, b: np.ndarray, fit: np.ndarray, many, one, step: int = AT_ONCE) -> np.ndarray:
        """``many`` of the pairs that fit, in steps, and ``one`` of each other pair."""
        out, fits = np.zeros(len(a)), np.nonzero(fit)[0]
        for i in range(0, len(fits), step):
            out[fits[i : i + step]] = many(a[fits[i : i + step]], b[fits[i : i + step]])
        for i in np.nonzero(~fit)[0]:
            out[i] = one(self.texts[a[i]], self.texts[b[i]])
        return out

    def names(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Jaro-Winkler similarities."""
        fit = np.maximum(self.lengths[a], self.lengths[b]) <= LONGEST
        return self._each(a, b, fit, lambda a, b: jaro_winkler_of(*self._cut(self.codes, a), *self._cut(self.codes, b)), jaro_winkler)

    def name_bounds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No Jaro-Winkler similarity of two texts can exceed this: all characters of the shorter one agree, in order, and
        so do four at the beginning."""
        short, long = np.minimum(self.lengths[a], self.lengths[b]), np.maximum(self.lengths[a], self.lengths[b])
        jaro = (2 + short / np.maximum(long, 1)) / 3
        return np.where(short > 0, jaro + 0.4 * (1 - jaro), 0.0) + 1e-9

    def _distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        own, at = np.unique(a, return_inverse=True)
        numbers, lengths = self._cut(self.numbers, own)
        places, every = np.zeros((len(own), self.letters), dtype=np.uint64), np.arange(len(own))
        for i in range(numbers.shape[1]):
            places[every, numbers[:, i]] |= np.where(i < lengths, np.uint64(1 << i), np.uint64(0))
        return edits_of(places, at, lengths[at], *self._cut(self.numbers, b))

    def addresses(self, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
        """1 - Levenshtein distance over the longer length, 0 where both are empty; also 0 where the lengths alone keep it
        below ``least``."""
        a, b = np.where(self.lengths[a] <= self.lengths[b], a, b), np.where(self.lengths[a] <= self.lengths[b], b, a)
        short, long = self.lengths[a], self.lengths[b]
        out, may = np.zeros(len(a)), (long > 0) & (1 - (long - short) / np.maximum(long, 1) >= least)
        fit = (short <= LONGEST) & (long <= WIDEST)
        out[may] = 1 - self._each(a[may], b[may], fit[may], self._distances, edits, max(1, min(AT_ONCE, TABLE // self.letters))) / long[may]
        return out


def _distinct(score, texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of pairs of texts, each different pair being scored once."""
    pairs, at = np.unique(a * len(texts.texts) + b, return_inverse=True)
    return score(pairs // len(texts.texts), pairs % len(texts.texts))[at]


def similar(left: pa.Table, right: pa.Table, rules, tile: str, name: tuple[str, str], address: tuple[str, str]) -> tuple[np.ndarray, ...]:
    """Rows of ``left`` and of ``right`` with equal ``tile`` whose scores satisfy ``rules``, and the address and name
    scores. Cheapest test first: lengths of addresses, their edit distance, lengths of names, their similarity."""
    tiles = Texts(left[tile], right[tile])
    names, addresses = (Texts(left[l], right[r]) for l, r in (name, address))
    order, least = np.argsort(tiles.right, kind="stable"), min(a for _, a in rules.pairs())
    begins, until = (np.searchsorted(tiles.right[order], tiles.left, side) for side in ("left", "right"))
    ends, found, i = np.cumsum(until - begins), [], 0
    while i < len(ends):
        before = ends[i - 1] if i else 0
        k = max(i + 1, int(np.searchsorted(ends, before + STEP, "right")))
        each = (until - begins)[i:k]
        a = np.repeat(np.arange(i, k), each)
        b = order[np.arange(len(a)) + np.repeat(begins[i:k] - (ends[i:k] - each - before), each)]
        i, of_address = k, _distinct(lambda a, b: addresses.addresses(a, b, least), addresses, addresses.left[a], addresses.right[b])
        near = of_address >= least
        a, b, of_address = a[near], b[near], of_address[near]
        near = rules.fits(names.name_bounds(names.left[a], names.right[b]), of_address)
        a, b, of_address = a[near], b[near], of_address[near]
        of_name = _distinct(names.names, names, names.left[a], names.right[b])
        near = rules.fits(of_name, of_address)
        found.append((a[near], b[near], of_address[near], of_name[near]))
    return tuple(np.concatenate(x) for x in zip(*found))
