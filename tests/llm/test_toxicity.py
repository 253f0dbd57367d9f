import random

import numpy as np

from grantlake.llm import toxicity as T


def test_composed_transducers_choose_the_channel():
    lex = T.Lexicon({"zog": 4.0}, {"bru": 2.0})
    read = lambda t: [(c, k, w) for c, k, w, _ in T.clauses(t, lex)[1]]
    assert read("a zog here. brumm") == [(0, 0, 4.0), (1, 0, 2.0)]
    assert read("you are a zog") == [(0, 1, 4.0)] and read("zog that you are") == [(0, 1, 4.0)]
    assert read("not a zog") == [(0, 4, 4.0)] and read("not one of the really big zog") == [(0, 0, 4.0)]
    assert read('it said zog. zog "zog; x"') == [(0, 2, 4.0), (1, 0, 8.0)] or read('it said zog. zog') == [(0, 2, 4.0), (1, 0, 4.0)]
    assert read("kill you") == [(0, 1, 1.0)]
    assert read("") == [] and read(None) == [] and read("plain words only") == []


def world(n=400, seed=0):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in "ba do ki lu me".split() for b in "ra no ti su".split()]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vogon", "grok"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learned_from_labels_and_right_on_held_out_rows(spark):
    rows, labels = world()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    model = T.train(docs, marks)
    assert {"vogon", "grok"} <= set(model.lexicon.exact)
    out = T.score(docs, model).withColumn("h", T.held_out("doc_id")).collect()
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in out if r.h) and sum(r.h for r in out) > 40
    kept = T.reject_toxic(docs.withColumnRenamed("doc_id", "id").selectExpr("id as doc_id", "text", "1 as id", "2 as score"), model)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, y in labels if not y] and kept.columns == ["doc_id", "text", "id", "score"]


def test_labels_never_leak_from_held_out_rows(spark):
    rows, labels = world()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    import zlib

    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (T.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a.lexicon.exact == b.lexicon.exact and np.allclose(a.beta, b.beta)


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "vogon " * 30000), (1, "x")], "doc_id long, text string")
    for marks in ([], [(1, 1)], [(1, 0)]):
        model = T.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        out = T.score(docs, model).collect()
        assert len(out) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert T.score(docs.limit(0), model).count() == 0


def test_bounds_of_the_sample_do_not_move_the_scores(spark):
    # A word that 3 of 10 texts with it are toxic for: a score of 0.3, also where the sample holds as many toxic rows as others.
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["bara", "dono", "kiti", "lusu"]) for _ in range(20)) + (" vogon." if i % 7 == 0 else ".")) for i in range(2100)]
    labels = [(i, int(i % 7 == 0 and i // 7 % 10 < 3)) for i in range(2100)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    for bounds in ({}, {"max_toxic": 60, "max_clean": 60}, {"max_clean": 60}):
        model = T.train(docs, marks, **bounds)
        assert 0.15 < model.score("bara dono vogon.")[0] < 0.45, bounds
        assert T.reject_toxic(docs, model).count() == len(rows), bounds
