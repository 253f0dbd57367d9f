import hashlib
import random
import re
from collections import Counter

from grantlake.llm import weighted_sampling as C


def bag(text):
    return Counter(w for w in re.split(C.BREAKS, (text or "").lower()) if w)


def jaccard(a, b):
    a, b = bag(a), bag(b)
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def edited(docs):
    rows = sorted(docs)
    out = {}
    for i, (d, t) in enumerate(rows):
        t, following = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        out[d] = t[: len(t) - half] + following[:half]
    return out


def test_likeness_estimates_generalised_jaccard(spark):
    a = " ".join(f"w{i}" for i in range(40)) + " heavy" * 30
    b = " ".join(f"w{i}" for i in range(20, 60)) + " heavy" * 12
    docs = spark.createDataFrame([(1, a), (2, b), (3, None), (4, ""), (5, a.upper() + "!")], "doc_id long, text string")
    got = {r.doc_id: r.signature for r in C.fingerprints(docs, samples=1024).collect()}
    same = sum(x == y for x, y in zip(got[1], got[2])) / 1024
    assert abs(same - jaccard(a, b)) < 0.06
    assert got[1] == got[5] and got[3] == got[4] == [-1] * 1024


def test_edited_texts_over_every_run_boundary(spark):
    docs = [(3 * i - 20, None if i % 13 == 0 else f"É{i} word{i % 7}, " * (i % 11) + "x" * (i % 3)) for i in range(60)]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, run int, copy int").repartition(4)
    want = edited(docs)
    for each in (7, 1, 1000):
        got = C.edited_likeness(frame, rows_each=each).collect()
        assert len(got) == 60
        prints = {}
        for r in got:
            assert r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
            text = dict(docs)[r.doc_id] or ""
            assert r.n_chars == len(text) and 0 <= r.near_edited <= 1
            assert prints.setdefault(text, r.fingerprint) == r.fingerprint
            assert prints.setdefault(want[r.doc_id], r.edited_fingerprint) == r.edited_fingerprint
        by_id = {r.doc_id: r for r in got}
        ids = sorted(by_id)
        for a, b in zip(ids, [*ids[1:], ids[0]]):
            x, y = (re.findall("......", by_id[i].fingerprint) for i in (a, b))
            assert by_id[a].near_next == sum(p == q for p, q in zip(x, y)) / len(x)


def test_nulls_repeats_and_sizes(spark):
    docs = spark.createDataFrame([(None, "a b"), (7, "c"), (7, "d e"), (None, None)], "doc_id long, text string")
    assert C.edited_likeness(docs).count() == 4
    assert C.edited_likeness(docs.limit(0)).count() == 0
    (one,) = C.edited_likeness(docs.where("text = 'c'")).collect()
    assert one.near_edited == one.near_next == 1.0
    long = spark.createDataFrame([(1, "word " * 60_000)], "doc_id long, text string")
    assert C.edited_likeness(long).first().n_chars == 300_000


def test_likeness_of_production_fingerprints(spark):
    # 200 pairs of each likeness: 400 words, of which the first are shared; what the query runs has no more error than 64 samples.
    rng = random.Random(3)
    docs, want = [], {}
    for pair in range(600):
        kept = (380, 200, 60)[pair % 3]
        words = [f"p{pair}w{i}" for i in range(400)]
        for side, rest in enumerate("ab"):
            text = words[:kept] + [f"{w}{rest}" for w in words[kept:]]
            rng.shuffle(text)
            docs.append((2 * pair + side, " ".join(text)))
        want[2 * pair] = kept / (800 - kept)
    got = {r.doc_id: r.near_next for r in C.edited_likeness(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for likeness in sorted(set(want.values())):
        errors = [got[i] - w for i, w in want.items() if w == likeness]
        error, bias = (sum(e * e for e in errors) / len(errors)) ** 0.5, sum(errors) / len(errors)
        allowed = (likeness * (1 - likeness) / 64) ** 0.5
        assert error < allowed and abs(bias) < allowed / 4, (likeness, error, bias)
