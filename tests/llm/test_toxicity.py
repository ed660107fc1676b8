import random

import numpy as np
import pytest

from corvane.llm import toxicity
from corvane.llm.common import held_out, learnt


def random_model(rng, n, terms):
    idf = rng.uniform(1, 4, terms)
    rows = []
    for _ in range(n):
        counts = {int(p): int(rng.integers(1, 4)) for p in rng.choice(terms, rng.integers(1, 4))}
        rows.append(toxicity._vector(counts, idf))
    weights = np.array(rows)
    blocks = -(-n // toxicity.BLOCK)
    block_max = np.array([weights[b * toxicity.BLOCK:(b + 1) * toxicity.BLOCK].max(axis=0)
                          for b in range(blocks)]).T
    return toxicity.Model({}, idf, np.arange(n), rng.integers(0, 2, n).astype(float), weights,
                          block_max, 0.1, 0.05)


@pytest.mark.parametrize("n", [1, 10, 700])
def test_nearest_is_exact(n):
    rng = np.random.default_rng(n)
    model = random_model(rng, n, 12)
    for _ in range(40):
        query = toxicity._vector({int(p): 1 for p in rng.choice(12, 3)}, model.idf)
        places = np.flatnonzero(query)
        at, cosine = toxicity.nearest(model, places, query[places], 5)
        every = (model.weights @ query).round(9)
        want = np.lexsort((np.arange(n), -every))[:5]
        assert at.tolist() == want.tolist() and np.allclose(cosine, every[want], atol=1e-8)


def corpus(spark):
    rng = random.Random(4)
    plain = ["house", "river", "stone", "cloud", "green", "walk", "table"]
    docs, labels = [], []
    for i in range(240):
        words = [rng.choice(plain) for _ in range(12)]
        toxic = i % 4 == 0
        if toxic:
            words[3] = rng.choice(["Nastyword", "nastyword"])
        docs.append((i, " ".join(words), 7.0))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_rows_of_any_kind(spark):
    docs, labels = corpus(spark)
    odd = spark.createDataFrame([(900, None, None), (901, "", 1.0), (None, "nastyword", 1.0),
                                 (903, "house " * 200_000 + "nastyword", 1.0), (903, "house", 1.0)],
                                docs.schema)
    labels = labels.unionByName(spark.createDataFrame([(1, None), (None, 1), (5000, 1), (0, 0)], labels.schema))
    model = toxicity.learn(docs, labels)
    got = toxicity.classify(docs.unionByName(odd), model).collect()
    assert len(got) == 245 and all(0 <= r.score <= 1 for r in got)
    by_id = {(r.doc_id, i): r for i, r in enumerate(got)}
    for (doc_id, _), r in by_id.items():
        if doc_id is not None and doc_id < 240:
            assert r.predicted == int(doc_id % 4 == 0)
    assert sorted((r.doc_id or -1, r.predicted) for r in got[240:]) == [
        (-1, 1), (900, 0), (901, 0), (903, 0), (903, 1)]
    assert all(r.evidence for r in got if r.predicted)
    assert toxicity.classify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_without_both_classes(spark, labels):
    docs, _ = corpus(spark)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    want = 1.0 if labels == [(1, 1)] else 0.0
    assert {r.score for r in toxicity.classify(docs, model).collect()} == {want}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.learn(docs, labels.where(learnt()).select("doc_id", "toxic"))
    found = (toxicity.classify(docs.join(labels.where(held_out()), "doc_id"), model)
             .select("toxic", "predicted").toPandas())
    hit = ((found.toxic == 1) & (found.predicted == 1)).sum()
    assert hit / (found.predicted == 1).sum() > 0.8 and hit / (found.toxic == 1).sum() > 0.75
