"""Large groups under one signature: few pairs are made, and components are as by brute force."""

import numpy as np
from pyspark.sql import functions as F

from demandloom.llm.common import components, may_link, merged, similarity_components
from demandloom.llm.jaccard_join import parity
from demandloom.llm.shingles import mix


def test_a_common_passage_is_not_compared_pair_by_pair(spark):
    """Sets of 400 common elements and some of their own link if those are at most 100 together."""
    n, rng = 600, np.random.default_rng(3)
    own = rng.integers(20, 160, n)
    common = mix(np.arange(400, dtype=np.uint64))
    rows, at = [], 1000
    for i, k in enumerate(own.tolist()):
        rows.append((i, 400 + k, parity(np.concatenate([common, mix(np.arange(at, at + k, dtype=np.uint64))])).tolist()))
        at += k
    sets = spark.createDataFrame(rows, "key long, n int, parity array<long>")
    sigs = spark.range(n).select(F.explode(F.expr("sequence(1L, 3L)")).alias("sig"), F.col("id").alias("key"))
    light = sets.select("key", F.struct("n", "parity").alias("f")).persist()
    made = []

    def may(x, y):
        return may_link(x, y, 80, 100)

    def link(pairs, _):
        x, y = (light.select(F.col("key").alias(k), F.col("f").alias(f)) for k, f in (("a", "fa"), ("b", "fb")))
        near = pairs.join(x, "a").join(y, "b").where(may(F.col("fa"), F.col("fb")))
        made.append(pairs.count())
        return near.where(F.col("fa.n") + F.col("fb.n") <= 900).select("a", "b")

    got = {r.id: r.component for r in similarity_components(sigs, lambda keys: sets, link, "groups", lambda s: light, may, 2, 2).collect()}
    first = min(i for i in range(n) if own[i] + own.min() <= 100)
    assert all(got.get(i, i) == (first if own[i] + own.min() <= 100 else i) for i in range(n))
    # made one by one after the leaders, they would be many times the members
    assert made[-1] <= 3 * n, made


def test_merged_is_components_of_all_links(spark):
    rng = np.random.default_rng(4)
    old = [(int(a), int(b)) for a, b in rng.integers(0, 400, (150, 2))]
    new = [(int(a), int(b)) for a, b in rng.integers(0, 400, (60, 2))]
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    got = merged(components(frame(old)), frame(new), "links")
    want = components(frame(old + new))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_signatures_with_the_same_keys_are_one(spark):
    rng = np.random.default_rng(5)
    rows = [(int(s), int(k)) for g in range(60) for keys in [rng.choice(500, rng.integers(1, 9), replace=False)] for s in range(20 * g, 20 * g + 20) for k in keys]
    sigs = spark.createDataFrame(rows + rows[:40], "sig long, key long")
    asked = []

    def link(pairs, _):
        asked.append({tuple(r) for r in pairs.collect()})
        return pairs.where("pmod(a * b, 3) = 1")

    want, got = (sorted(map(tuple, similarity_components(sigs, lambda keys: keys, link, "alike", alike=x).collect())) for x in (False, True))
    assert got == want and asked[0] == asked[2]
