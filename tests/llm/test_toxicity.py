import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asiento.llm import toxicity as T
from asiento.llm.queries import held_out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    syllables = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "nrls"]
    rows, labels = [], []
    for i in range(3000):
        text = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 120))]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["Vile", "grubby", "fiend" + rng.choice(syllables)]))
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: i % 10 == 0 for i in range(3000)}


def test_held_out_accuracy(spark, corpus):
    docs, labels, truth = corpus
    model = T.fit_toxicity(docs, labels, lambda doc_id: ~held_out(doc_id))
    rows = T.score_toxicity(docs, model).filter(held_out(F.col("doc_id"))).collect()
    found = [(r.score >= 0.7, truth[r.doc_id]) for r in rows]
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) > 900
    assert sum(a and b for a, b in found) >= 0.9 * sum(b for _, b in found)
    assert sum(a and not b for a, b in found) <= 0.01 * len(found)


def test_held_out_labels_are_not_used(corpus):
    docs, labels, _ = corpus
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (T.fit_toxicity(docs, x, lambda doc_id: ~held_out(doc_id)) for x in (labels, flipped))
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights) and np.isclose(a.intercept, b.intercept)


def test_rows_pass_through(spark, corpus):
    docs, labels, _ = corpus
    model = T.fit_toxicity(docs, labels, lambda doc_id: ~held_out(doc_id))
    long = "plain words " * 200_000 + "vile grubby"
    rows = [(1, None, 0.5), (None, "", None), (2, long, 0.1), (2, "vile grubby", 0.1), (2, "vile grubby", 0.1)]
    out = T.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string, score double"), model)
    assert out.columns == ["doc_id", "text", "score", "score_2"]
    got = sorted(((r.text or "")[:4], round(r.score_2, 6)) for r in out.collect())
    assert got[0][1] == got[1][1] < 0.5 and got[2][1] == got[3][1] == got[4][1] or got[2][0] == "plai"
    assert min(score for text, score in got if text) >= 0.7
    assert T.score_toxicity(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(None, 1, 1)], [(1, 1, None)]])
def test_without_toxic_labels(spark, labels):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit_toxicity(docs, table, lambda doc_id: doc_id.isNotNull())
    assert all(r.score < 1e-6 for r in T.score_toxicity(docs, model).collect())


def test_an_id_on_many_rows_counts_once(spark, corpus):
    docs, labels, _ = corpus
    again = docs.filter("doc_id = 0").crossJoin(spark.range(5000)).drop("id")
    a, b = (T.fit_toxicity(x, labels, lambda doc_id: doc_id.isNotNull()) for x in (docs, docs.unionByName(again)))
    assert (a.features == b.features).mean() > 0.9 if len(a.features) == len(b.features) else abs(len(a.features) - len(b.features)) < 5


def test_levels_count_occurrences():
    model = T.ToxicityModel(np.sort(T.hashed_words(np.frombuffer(b"bad", np.uint8), np.array([0, 3])).hash), np.array([1.0, 10.0, 100.0]), 0.0)
    texts = pa.array(["good", "bad", "bad Bad", "bad bad bad bad bad", None])
    assert model.logits(texts).tolist() == [0, 1, 11, 111, 0]
