"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns each word into a class: insult (with a weight learned from labels, by whole word or by the
stem it begins with), threat, target, negation, reported speech, quotation mark, clause end, or other. Three small
transducers read the classes: one remembers a negation for the next few words, one reported speech or an open
quotation, one whether the clause names a target. Their product is one table of transitions; where an insult or threat
is read, its weight goes to the channel of the composed state (negated, reported, aimed). A document's score is a
logistic function of what its matched clauses put on the channels. How much a channel counts is learned from labels
too, so a negated or quoted insult weighs what such insults weigh in the labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grantlake.llm.common import pieces, tidy

# Closed classes of English, German, French and Spanish words.
TARGETS = "you your yours he him his she her they them their du dich dir dein deine ihr euch er ihm ihn sie tu toi te ton ta vous votre vos il elle lui eux usted ustedes tus vosotros ellos ellas"
NEGATIONS = "not no never none isn aren don doesn didn won without nicht kein keine keinen nie niemals ohne ne pas jamais sans aucun nunca jamás sin ningún tampoco"
REPORTS = "said says say told wrote writes claimed claims called quoted reported sagte sagt meinte schrieb behauptet nannte dit disait écrit affirme déclaré appelé dijo dice escribió afirma llamó"
THREATS = "kill killed hurt destroy beat stab shoot murder töten umbringen verletzen schlagen tuer frapper détruire blesser matar golpear destruir herir"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END, LINE = range(9)
_CLASS = {w: k for k, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words.split()}
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"«»“”„]")
REACH = 3  # words after a negation that it still covers
CHANNELS = 8
MAX_TOXIC, MAX_CLEAN, MAX_STEMS, MAX_BYTES = 2500, 5000, 20_000, 200_000
STEM = range(3, 11)


def _negation(state: int, kind: int) -> int:
    return REACH if kind == NEGATION else 0 if kind in (END, LINE) else max(0, state - 1)


def _report(state: int, kind: int) -> int:
    """0 plain, 1 after a reporting verb (to the clause's end), 2 within quotation marks (to the line's end, if they are
    not closed before)."""
    if kind == LINE:
        return 0
    if kind == QUOTE:
        return 0 if state == 2 else 2
    return 1 if kind == REPORT and state == 0 else 0 if kind == END and state == 1 else state


def _target(state: int, kind: int) -> int:
    return 0 if kind in (END, LINE) else 1 if kind == TARGET else state


def _compose() -> tuple[list[list[int]], list[int]]:
    """The product's transitions ``[state][class]`` and of each state the channel of a match that is read there."""
    states = list(product(range(REACH + 1), range(3), range(2)))
    number = {s: i for i, s in enumerate(states)}
    moves = [[number[_negation(n, k), _report(r, k), _target(t, k)] for k in range(9)] for n, r, t in states]
    return moves, [4 * (n > 0) + 2 * (r > 0) + t for n, r, t in states]


MOVES, CHANNEL = _compose()
FEATURES = 2 * CHANNELS + 4


class Lexicon(dict):
    """Word → (class, weight); words not met before are looked up by their stems and remembered."""

    MOST = 100_000
    _PLAIN = (OTHER, 0.0)

    def __init__(self, exact: dict[str, float], stems: dict[str, float]) -> None:
        super().__init__()
        self.exact, self.stems = exact, stems

    def __reduce__(self):
        return Lexicon, (self.exact, self.stems)

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) > self.MOST:
            self.clear()
        if not (word[0].isalpha()):
            found = (QUOTE if word in "\"«»“”„" else LINE if word == "\n" else END, 0.0)
        else:
            weight = max([self.exact.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEM if n < len(word))])
            kind = _CLASS.get(word, OTHER)
            found = (INSULT, weight) if weight else self._PLAIN if kind == OTHER else (kind, 1.0 if kind == THREAT else 0.0)
        self[word] = found
        return found


def clauses(text: str | None, lexicon: Lexicon) -> tuple[int, list[tuple[int, int, float, list[str]]]]:
    """Number of words, and of each matched clause: its number, channel of its strongest match, weight, matched words.
    A target later in the clause counts for its earlier matches too."""
    tokens = _TOKEN.findall((text or "").lower())
    read = [lexicon[t] for t in tokens]
    hits = [i for i, (kind, weight) in enumerate(read) if weight]
    if not hits:
        return len(tokens), []
    out, state, nth = [], 0, 0
    matched: list[tuple[int, float, str]] = []
    aimed = 0

    def close() -> None:
        channel, weight = max(((c | aimed, w) for c, w, _ in matched), key=lambda x: x[1])
        out.append((nth, channel, float(sum(w for _, w, _ in matched)), [w for _, _, w in matched]))

    for token, (kind, weight) in zip(tokens, read):
        if weight:
            matched.append((CHANNEL[state], weight, ("threat:" if kind == THREAT else "") + token))
        state = MOVES[state][kind]
        aimed |= kind == TARGET
        if kind in (END, LINE):
            if matched:
                close()
            matched, aimed, nth = [], 0, nth + 1
    if matched:
        close()
    return len(tokens), out


def features(n_words: int, found: list) -> np.ndarray:
    x = np.zeros(FEATURES)
    if found:
        weights = np.array([w for _, _, w, _ in found])
        np.add.at(x, [c for _, c, _, _ in found], np.minimum(weights, 20.0))
        np.add.at(x, [CHANNELS + c for _, c, _, _ in found], 1.0)
        x[: 2 * CHANNELS] = np.log1p(x[: 2 * CHANNELS])
        n = sum(len(w) for *_, w in found)
        x[-4:] = np.log1p(weights.max()), np.log1p(n), np.log1p(1000.0 * n / max(n_words, 20)), np.log1p(1000.0 * weights.sum() / max(n_words, 20))
    return x


def learn_lexicon(texts: list[str | None], toxic: np.ndarray, least: int = 4) -> Lexicon:
    """Whole words and word beginnings over-represented in toxic documents, weighted by smoothed log odds."""
    counts = (Counter(), Counter())
    for text, label in zip(texts, toxic):
        words = {w for w in _TOKEN.findall((text or "").lower()) if w[0].isalpha() and len(w) <= 40}
        counts[label].update(words | {w[:n] + "*" for w in words for n in STEM if n < len(w)})
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    odds = {f: float(np.log((c + 0.5) / (n1 + 1)) - np.log((counts[0][f] + 0.5) / (n0 + 1))) for f, c in counts[1].items() if c >= least}
    best = sorted((f for f, w in odds.items() if w >= 1.5), key=lambda f: (-odds[f] * counts[1][f] ** 0.5, f))[:MAX_STEMS]
    return Lexicon({f: odds[f] for f in best if f[-1] != "*"}, {f[:-1]: odds[f] for f in best if f[-1] == "*"})


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.3) -> np.ndarray:
    """Ridge logistic regression of weighted rows by Newton's method; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, lexicon: Lexicon, beta: np.ndarray) -> None:
        self.lexicon, self.beta = lexicon, beta

    def score(self, text: str | None) -> tuple[float, list]:
        n, found = clauses(text, self.lexicon)
        z = float(features(n, found) @ self.beta[:-1] + self.beta[-1])
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, z)))), found


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of 5 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES) -> Model:
    """Learns lexicon and channel weights from labelled rows that are not held out.

    Bounded sample: of each label the ``max_toxic`` or ``max_clean`` rows with the smallest hash of their ids come to
    the driver, one text of each id, and no text of more than ``max_bytes``. Both labels are counted over all rows, and a sampled row weighs as many as it stands for (1 on average),
    so that a score is a probability among all labelled rows, whatever the bounds. The channel weights are fitted on
    documents whose lexicon was learned from the other half. Rows with a null label or id are left out; without both
    labels every score is the share of toxic rows (0 without any).
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("y"))
    mark = F.xxhash64("id")
    chosen = known.where("y = 1").orderBy(mark, "id").limit(max_toxic).union(known.where("y = 0").orderBy(mark, "id").limit(max_clean)).collect()
    every, drawn = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}, Counter(r.y for r in chosen)
    ids = docs.sparkSession.createDataFrame([(r.id, r.y) for r in chosen], known.schema)  # bounded by the two limits
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids.groupBy("id").agg(F.max("y").alias("y"))), "id")
    found = found.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    rows = found.groupBy("id").agg(F.min_by(F.struct("text", "y"), F.xxhash64("text")).alias("r")).select("id", "r.*").collect()
    rows.sort(key=lambda r: (str(r.id), r.text or ""))
    texts, y = [r.text for r in rows], np.array([r.y for r in rows], int)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1e-3) / (len(y) + 1) if len(y) else 1e-9
        return Model(Lexicon({}, {}), np.append(np.zeros(FEATURES), np.log(share / (1 - share))))
    half = np.arange(len(y)) % 2
    x = np.zeros((len(y), FEATURES))
    for fold in (0, 1):
        lexicon = learn_lexicon([t for t, h in zip(texts, half) if h != fold], y[half != fold])
        for i in np.nonzero(half == fold)[0]:
            x[i] = features(*clauses(texts[i], lexicon))
    stands_for = {label: every[label] / n * len(chosen) / sum(every.values()) for label, n in drawn.items()}
    return Model(learn_lexicon(texts, y), _logistic(x, y, np.array([stands_for[label] for label in y.tolist()])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score double, predicted int, clauses array<struct<clause,negated,reported,aimed,weight,words>>)``.

    A row for each document. Null and empty texts have no clause and get the score of a document without matches.
    Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded: MAX_STEMS entries
    kind = pa.list_(pa.struct([("clause", pa.int32()), ("negated", pa.bool_()), ("reported", pa.bool_()), ("aimed", pa.bool_()), ("weight", pa.float64()), ("words", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = held.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                made = [one.score(t.as_py()) for t in piece.column("text")]
                found = [[{"clause": c, "negated": bool(k & 4), "reported": bool(k & 2), "aimed": bool(k & 1), "weight": w, "words": words} for c, k, w, words in f] for _, f in made]
                p = np.array([s for s, _ in made])
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(found, kind)], ["id", "score", "predicted", "clauses"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {id_type}, score double, predicted int, clauses array<struct<clause:int,negated:boolean,reported:boolean,aimed:boolean,weight:double,words:array<string>>>"
    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)


def reject_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose score is below 0.5, all columns unchanged; the row travels through the scorer, so that
    nothing has to be joined back."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = held.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                keep = pa.array([one.score(t.as_py())[0] < 0.5 for t in piece.column("text")], pa.bool_())
                yield pa.RecordBatch.from_arrays([piece.column("id").filter(keep)], ["id"])

    kept = packed.mapInArrow(tidy(run), StructType([packed.schema["id"]]))
    return kept.select(*[F.col(f"id.`{c}`").alias(c) for c in docs.columns])
