"""Training of the language model: small partitions are read together, and class slopes summed by context are those of each feature."""

import numpy as np

from demandloom.llm import language_model as lm

from .conftest import docs_of


def test_small_partitions_train_in_few_tasks(spark, monkeypatch):
    docs = lm.texts_of(docs_of(spark, [(i, f"a few words of row {i}") for i in range(400)]).repartition(40))
    seen = []
    monkeypatch.setattr(lm, "train_round", lambda d, m: seen.append(d.rdd.getNumPartitions()) or m.weights)
    lm.fit(docs, lm.token_counts(docs))
    assert seen == [1] * lm.ROUNDS


def test_class_steps_against_single_features():
    rng = np.random.default_rng(1)
    n = 700
    ids, classes = rng.integers(2, 90, n), rng.integers(0, lm.CLASSES, n).astype(np.int32)
    outer, _ = lm.features_of(ids, classes, np.arange(n) % 50)
    prior = rng.normal(size=lm.CLASSES).astype(np.float32)
    weights = rng.normal(size=(lm.ROWS, lm.CLASSES)).astype(np.float32)
    squares = rng.random((lm.ROWS, lm.CLASSES)).astype(np.float32)
    x = sum(weights[r].astype(float) for r in outer) + prior
    slope = np.exp(x - x.max(1, keepdims=True))
    slope /= slope.sum(1, keepdims=True)
    assert np.allclose(lm.softmax(lm.class_sums(weights, outer, lm.context_table(weights, prior))), slope, atol=1e-5)
    slope[np.arange(n), classes] -= 1
    want, total = weights.astype(float), squares.astype(float)
    for r in outer:
        for k in np.unique(r):
            g = slope[r == k].sum(0) / np.sqrt((r == k).sum())
            total[k] += g * g
            want[k] -= lm.RATE * g / np.sqrt(total[k] + 1e-2)
    lm.descend_classes(weights, squares, outer, prior, classes)
    assert np.allclose(weights, want, atol=1e-4) and np.allclose(squares, total, atol=1e-3)
