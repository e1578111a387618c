"""Scores of the query against a machine whose kernel is enumerated."""

from functools import lru_cache
from itertools import combinations

import numpy as np

from conftest import SF
from demandloom.llm import toxicity as tox


@lru_cache(maxsize=None)
def subsequences(x):
    out = {}
    for c in combinations(range(len(x)), tox.ORDER):
        u = "".join(x[i] for i in c)
        out[u] = out.get(u, 0) + tox.DECAY ** (c[-1] - c[0] + 1)
    return out


def brute_kernel(s, t):
    b = subsequences(t)
    return sum(v * b.get(u, 0) for u, v in subsequences(s).items())


def brute_score(m, text):
    best = []
    for mark in m.landmarks:
        own = brute_kernel(mark, mark)
        near = [min(1.0, brute_kernel(tox.BEGIN + w, mark) / own) for w in tox.words_of(text)]
        best.append(max((x for x in near if x >= tox.DULL), default=0.0))
    margin = np.array(best) @ m.white @ m.weights + m.bias
    return 1 / (1 + np.exp(-(m.slope * margin + m.offset)))


def test_scores_against_enumerated_kernel(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    m = tox.fit(docs, labels)
    assert 1 < len(m.landmarks) <= tox.LANDMARKS
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    score = {r.doc_id: r.score for r in tox.scored(docs, m).collect()}
    # short texts of both kinds whose words fit one window, so that enumeration ends soon
    texts = {r.doc_id: r.text for r in docs.collect() if r.text and len(r.text) < 900 and max(map(len, r.text.split()), default=0) < 18}
    bad = [i for i in texts if i in toxic][:12]
    some = bad + [i for i in texts if i not in toxic][:12]
    assert bad
    for i in some:
        assert abs(score[i] - brute_score(m, texts[i])) < 1e-4, i


def test_no_labels_no_documents(spark):
    docs = spark.createDataFrame([(1, "some words"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = tox.toxicity(docs, labels).collect()
    assert sorted((str(r.doc_id), r.score, r.predicted) for r in rows) == [("1", 0.0, 0), ("None", 0.0, 0)]
    assert tox.toxicity(docs.limit(0), labels).count() == 0
