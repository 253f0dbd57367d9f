import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from grantlake.llm import decontaminate, simhash, toxicity  # noqa: E402
from grantlake.llm.common import table  # noqa: E402
from test_simhash import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect_and_keeps_the_columns(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns
        seen[name] = docs.toPandas()
    tox, near, clean, mixed = seen.values()
    model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert set(tox.doc_id) == {r.doc_id for r in toxicity.score(table(spark, SF, "documents"), model).where("predicted = 0").collect()}
    ids, prints = tox.doc_id.tolist(), [simhash.fingerprint(t) for t in tox.text]
    assert set(near.doc_id) == set(brute(ids, prints)) and len(near) == near.doc_id.nunique()
    left = spark.createDataFrame(clean)
    assert decontaminate.scan(left, table(spark, SF, "benchmark")).where("n_hit > 0").count() == 0
    assert set(mixed.doc_id) == set(clean.doc_id) and len(mixed) >= len(clean)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == len(mixed)
