"""Operators that SQL cannot express, held against slow and plain versions of their definitions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlake.llm import compaction as C
from grantlake.llm import mixing as M
from grantlake.llm import quality as Q
from grantlake.llm import simhash as S
from grantlake.llm import toxicity as T


def test_quality_posteriors_by_plain_sums(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "#%", "|"]) for _ in range(rng.randrange(1, 60))), rng.choice(["a", "b", None, f"lone{i}"]), rng.choice(["x", "y", None])) for i in range(300)]
    docs = spark.createDataFrame([*rows, rows[7]], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(t.count("alpha") > 3)) for i, t, *_ in rows[::2]] + [(0, None), (None, 1)], "doc_id long, quality int")
    out = Q.score(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(out) == 301
    of = {r.doc_id: r for r in out}
    each = [(of[i].doc_score, s or "", p or "") for i, _, s, p in [*rows, rows[7]]]
    prior = sum(e[0] for e in each) / len(each)
    groups = {"host": {}, "path": {}}
    for p, s, k in each:
        groups["host"].setdefault(s, []).append(p)
        groups["path"].setdefault((s, k), []).append(p)
    within = sum(sum(x * x for x in g) - sum(g) ** 2 / len(g) for g in groups["path"].values())
    spread = max(within / (len(each) - len(groups["path"])), 1e-9)

    def strength(found):
        many = [g for g in found.values() if len(g) > 1]
        n, s = sum(map(len, many)), sum(map(sum, many))
        about = sum(sum(g) ** 2 / len(g) for g in many) - s * s / n
        between = (about - (len(many) - 1) * spread) / (n - sum(len(g) ** 2 for g in many) / n)
        return min(1e6, spread / between) if between > 0 else 1e6

    h, p = strength(groups["host"]), strength(groups["path"])
    for (own, s, k), (i, *_) in zip(each, rows):
        host = (sum(groups["host"][s]) - own + h * prior) / (len(groups["host"][s]) - 1 + h)
        path = (sum(groups["path"][s, k]) - own + p * host) / (len(groups["path"][s, k]) - 1 + p)
        odds = math.log(own / (1 - own)) + math.log(path / (1 - path)) - math.log(prior / (1 - prior))
        assert of[i].host_posterior == pytest.approx(host) and of[i].path_posterior == pytest.approx(path)
        assert of[i].score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6)


def slow_clauses(text, lexicon):
    """The grammar by its wording, clause by clause and word by word."""
    words, out = re.findall(r"[^\W\d_]+|[.!?;\n]|[\"«»“”„]", text.lower()), []
    quoted = reported = False
    since_negation, clause, found, aimed = 99, 0, [], False
    for w in [*words, None]:
        if w is None or w in ".!?;\n":
            if found:
                channel, weight = max(found, key=lambda f: f[1])[:2]
                out.append((clause, channel | aimed, sum(f[1] for f in found), [f[2] for f in found]))
            quoted, reported, since_negation, clause, found, aimed = quoted and w != "\n", False, 99, clause + 1, [], False
            continue
        since_negation += 1
        kind = lexicon[w][0]
        if lexicon[w][1]:
            found.append((4 * (since_negation <= T.REACH) + 2 * (quoted or reported) + int(aimed), lexicon[w][1], ("threat:" if kind == T.THREAT else "") + w))
        aimed |= kind == T.TARGET
        if kind == T.NEGATION:
            since_negation = 0
        elif kind == T.QUOTE:
            quoted, reported = not quoted, False
        elif kind == T.REPORT and not quoted:
            reported = True
    return len(words), out


def test_grammar_by_a_slow_interpreter():
    rng = random.Random(6)
    lexicon = T.Lexicon({"fool": 2.0, "idiot": 3.5}, {"stup": 1.5})
    words = ["fool", "idiot", "stupid", "you", "not", "said", "kill", "a", "bee", '"', ".", "\n", "!", "7", "«"]
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))
        assert T.clauses(text, lexicon) == slow_clauses(text, lexicon), text


def test_training_takes_one_text_of_an_id(spark):
    docs = [(i, "you fool idiot moron" if i % 3 == 0 else "a calm day") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] * 2, "doc_id long, toxic int")
    once = spark.createDataFrame(docs, "doc_id long, text string")
    many = spark.createDataFrame([*docs, *[docs[1]] * 500, (2, "x" * 300_000)], "doc_id long, text string")
    a, b = (T.score(once, T.train(d, labels)).where("doc_id = 0").first().score for d in (once, many))
    assert a > 0.5 and b > 0.5


def test_rates_by_numpy(spark):
    """The nearest totals under the bound, by plain projected gradient over documents."""
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["alpha", "beta", "##%%"]) for _ in range(rng.randrange(5, 90)))) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 300, 3)] * 2, "doc_id long, quality int, toxic int")
    label = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    for targets, options in (({"good": 0.55, "poor": 0.45}, {}), ({"good": 0.5, "poor": 0.5}, {"min_rate": 1.0, "total": None, "most_total": 3.0}), ({"good": 0.52, "poor": 0.48}, {"min_rate": 0.9})):
        mixture, table, _ = M.fit(docs, labels, targets, label=label, **options)
        rows = table.withColumn("x", mixture.rate()).collect()
        n, p, x = np.array([r.n_tokens for r in rows], float), np.array([r.p for r in rows]), np.array([r.x for r in rows])
        goal, now = (np.array([mixture.reached[d][k] for d in targets]) for k in (0, 1))
        low = options.get("min_rate", 0.0)
        assert np.allclose((n * x) @ p, now) and x.min() >= low - 1e-12
        y = np.maximum(np.ones(len(n)), low)
        a = (n[:, None] * p).T
        rate = 1 / np.linalg.norm(a, 2) ** 2
        for _ in range(4000):
            y = np.maximum(low, y - rate * (a.T @ (a @ y - goal)))
        assert np.abs(now - goal).max() <= np.abs(a @ y - goal).max() + 2e-3 * n.sum()


def test_remix_repeats_rows_where_they_lie(spark):
    docs = spark.createDataFrame([(i, f"alpha beta {i}" if i % 5 else None, "u", 1, 2.0) for i in range(400)] + [(None, "", "v", 1, 2.0)] * 2, "doc_id long, text string, `p` string, n int, rate double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning):
        mixture, _, _ = M.fit(docs, labels, {"good": 0.0, "poor": 3.0}, min_rate=1.0)
    out = M.remix(docs, mixture)
    assert out.columns == docs.columns and out.where("n = 1 and rate = 2.0").count() == out.count() >= 402
    assert out.select("doc_id").distinct().count() == 401 and "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert M.remix(docs.limit(0), mixture).count() == 0


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_shards_keep_all_rows_below_any_folder(spark, tmp_path):
    docs = spark.createDataFrame([(i % 700 if i % 9 else None, f"t{i}" if i % 11 else None, i, "x", 5) for i in range(900)] * 2, "doc_id long, text string, run int, batch string, `a.b` int").repartition(5)
    for name in ("with space", "100%25 +é"):
        store = C.compacted(docs, f"file://{tmp_path}/{name}", batches=4, target_bytes=60_000, base_bytes=2_000, fan_in=2)
        assert rows_of(store.read()) == rows_of(docs) and store.read().columns == docs.columns
        assert max(s.generation for s in store.live()) >= 1
    with pytest.raises(ValueError):
        C.ShardStore(spark, f"file://{tmp_path}/a[b]")


def test_versions_stay_readable_until_vacuum(spark, tmp_path):
    store = C.ShardStore(spark, f"file://{tmp_path}/s", target_bytes=1 << 20, base_bytes=1 << 18, fan_in=2)
    parts = [spark.range(100 * i, 100 * i + 100).withColumnRenamed("id", "doc_id").coalesce(1) for i in range(3)]
    store.append(parts[0])
    early = store.read()
    store.append(parts[1].withColumn("extra", F.lit("e")))
    assert store.compact() and store.read().count() == 200 and early.count() == 100
    assert [store.read(v).count() for v in store.versions()] == [100, 200, 200] and store.read().where("extra is null").count() == 100
    store.append(parts[2])
    with pytest.raises(ValueError):
        store.append(parts[2].selectExpr("cast(doc_id as string) doc_id"))
    assert store.vacuum(1) == 2 and store.versions() == [4] and store.read().count() == 300


def test_merges_that_lose_rows_are_not_committed(spark, tmp_path, monkeypatch):
    store = C.ShardStore(spark, f"file://{tmp_path}/s", fan_in=2)
    for _ in range(2):
        store.append(spark.range(50).coalesce(1))
    written = store._written
    monkeypatch.setattr(store, "_written", lambda place, generation: written(place, generation)[:0])
    with pytest.raises(RuntimeError):
        store.compact()
    monkeypatch.undo()
    assert store.read().count() == 100 and store.versions() == [1, 2] and store.compact() and store.read().count() == 100


def test_empty_arrivals(spark, tmp_path):
    store = C.compacted(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/e")
    assert store.read(shard_col="shard").columns == ["doc_id", "text", "shard"] and store.read().count() == 0 and not store.compact()
    store.append(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert store.read().count() == 1
    with pytest.raises(ValueError):
        store.read(shard_col="text")


def test_near_dedup_whatever_the_rows_come_from(spark, tmp_path):
    rows = [(i, f"one two three four {i % 5} six seven", None, 1) for i in range(40)] + [(3, "one two three four 3 six seven", "z", 2), (None, "", "q", 3), (None, None, "q", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, __row int").repartition(3)
    docs.write.parquet(f"{tmp_path}/d x%20y")
    files = spark.read.parquet(f"{tmp_path}/d x%20y")
    fps = [S.fingerprint(t) for _, t, *_ in rows]
    groups = {}
    for (i, *_), f in zip(rows, fps):
        groups.setdefault(next((g for g in groups if (g ^ f).bit_count() <= 4), f), []).append(i)
    for source in (files, docs, files.where("__row > 0"), files.unionByName(files.limit(0))):
        kept = S.near_dedup(source)
        assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        assert ids.count(None) == 2 and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    clashing = files.withColumnRenamed("a.b", "_metadata")
    assert S.near_dedup(clashing).count() == S.near_dedup(files).count()
    repeated = files.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    assert S.near_dedup(repeated).where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def test_scratch_can_be_cleared_and_clusters_need_a_shared_folder(spark, monkeypatch):
    from grantlake.llm import common

    table, path = common.materialise(spark.range(5), "x")
    assert table.count() == 5 and path in common._made and common.clear_scratch(spark) >= 1 and not common._made

    class Remote:
        conf = type("c", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("s", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        common.shared_folder(Remote())
