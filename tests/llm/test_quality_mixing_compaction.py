import random

import pytest
from pyspark.sql import functions as F

from grantlake.llm import compaction as C
from grantlake.llm import mixing as M
from grantlake.llm import quality as Q


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) if good else "##%%!!" for _ in range(rng.randrange(20, 120)))
        docs.append((i, text, "hot" if i % 3 else f"h{i % 40}", "p" if i % 2 else None))
        if i % 2:
            labels.append((i, int(good), int(i % 11 == 0)))
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"), spark.createDataFrame([*labels, (None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int"), dict((d, q) for d, q, _ in labels)


def test_quality_is_right_on_held_out_rows(spark):
    docs, labels, truth = frames(spark)
    out = Q.score(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and sum(r.keep == bool(truth[r.doc_id]) for r in held) / len(held) > 0.97


def test_sparse_sites_are_shrunk_and_leave_themselves_out(spark):
    rows = [(i, "a b c" if i % 10 else "#", "big" if i < 200 else "lone", "x") for i in range(201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = {r.doc_id: r for r in Q.score(docs, spark.createDataFrame([(1, 1), (10, 0), (11, 1), (20, 0)], "doc_id long, quality int"), F.col("source"), F.col("lang")).collect()}
    prior = sum(r.doc_score for r in out.values()) / len(out)
    assert out[200].host_posterior == pytest.approx(prior) and out[200].path_posterior == pytest.approx(prior)
    assert out[200].score == pytest.approx(out[200].doc_score, abs=1e-6)


def test_mixing_reaches_targets(spark):
    docs, labels, _ = frames(spark)
    label = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    for targets, options in (({"good": 0.5, "poor": 0.5}, {"label": label}), ({"good": 1.3, "poor": 1.0}, {"label": label, "relative": True, "min_rate": 1.0})):
        relative = "relative" in options
        rows = M.mix(docs, labels, targets, **options).collect()
        n = sum(r.n_tokens for r in rows)
        for d, t in targets.items():
            own = sum(r.n_tokens * r.posteriors[d] for r in rows)
            got = sum(r.n_tokens * r.posteriors[d] * r.rate for r in rows)
            assert abs(got - (t * own if relative else t * n)) < 2e-4 * n
        assert len(rows) == docs.count() and min(r.rate for r in rows) >= options.get("min_rate", 0.0)
        assert all(abs(sum(r.posteriors.values()) - 1) < 1e-9 for r in rows)


def test_resample_repeats_by_rate(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "doc_id long, rate string")
    mixed = spark.createDataFrame([(1, 0.0), (2, 2.0), (3, 1.0), (None, 1.0)], "doc_id long, rate double")
    assert sorted(r[1] for r in M.resample(docs, mixed).collect()) == ["b", "b", "c", "d"]
    many = spark.range(4000).select(F.col("id").alias("doc_id"))
    assert abs(M.resample(many, many.withColumn("rate", F.lit(1.25))).count() - 5000) < 120


def test_empty_and_unlabelled(spark):
    docs, labels, _ = frames(spark)
    assert M.mix(docs.limit(0), labels).count() == 0 and Q.score(docs.limit(0), labels, F.col("source"), F.col("lang")).count() == 0
    assert M.mix(docs, labels.limit(0)).count() == docs.count() == Q.score(docs, labels.limit(0), F.col("source"), F.col("lang")).count()
    odd = spark.createDataFrame([(None, None, None, None), (1, "", "s", "l"), (1, "", "s", "l")], docs.schema)
    assert Q.score(odd, labels, F.col("source"), F.col("lang")).count() == 3 and M.mix(odd, labels).count() == 3


def test_compaction_keeps_rows_and_commits_versions(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(1).alias("__run"), F.lit("x").alias("path")).drop("__run")
    store = C.compacted(rows.repartition(6), f"file://{tmp_path}/s", batches=3, target_bytes=90_000, base_bytes=4_000, fan_in=3)
    live = store.live()
    assert store.read().count() == 2000 and store.read().select("doc_id").distinct().count() == 2000
    assert max(s.generation for s in live) >= 1 and len(live) < 18 and max(s.bytes for s in live) < 110_000
    assert store.versions() == list(range(1, len(store.versions()) + 1)) and not store.compact()
    with pytest.raises(C.Conflict):
        store.commit(live, store.versions()[-1] - 1)
    store.append(rows.limit(5), F.col("doc_id") % 2)
    assert store.read().count() == 2005
    assert C.ShardStore(spark, f"file://{tmp_path}/none").read() is None


def test_plan_merges_similar_sizes_only(spark, tmp_path):
    store = C.ShardStore(spark, f"file://{tmp_path}/p", target_bytes=1000, base_bytes=10, fan_in=3)
    sizes = [5, 6, 7, 40, 35, 700, 8, 500]
    shards = [C.Shard(f"f{i}", n, store.tier(n), 0) for i, n in enumerate(sizes)]
    assert [[s.bytes for s in r] for r in store.plan(shards)] == [[5, 6, 7, 8]]
