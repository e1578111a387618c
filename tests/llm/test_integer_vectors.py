"""Centroid clusters and vector codes against plain Python on whole numbers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from demandloom.llm import centroid_clustering, vector_codes
from demandloom.llm.integer_vectors import LARGEST
from demandloom.llm.queries import QUERIES

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
)

#: Columns that clash with names used inside.
CLASH = ("q", "n", "ids", "cluster", "_k", "_n", "code", "error", "distance")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH})


def whole(v, scale):
    return [max(-LARGEST, min(LARGEST, math.floor(scale * x))) for x in v]


def complete(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def means(old, groups):
    """Componentwise floor of each group's mean; a group without members keeps the old one."""
    return [[sum(c) // len(g) for c in zip(*g)] if g else o for o, g in zip(old, groups)]


def brute_clusters(rows, dims, scale, k, rounds):
    kept = [(i, whole(v, scale)) for i, v, _ in rows if complete(v) and len(v) == dims]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = means(centroids, groups)
    out = [(i, *reversed(near(v))) for i, v in kept]
    total = Counter()
    for _, c, d in out:
        total[c] += d
    fits = lambda n: n if n < 1 << 63 else None
    mark = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((str(i), c, d, fits(total[c]), fits(sum(total.values())), mark[c]) for i, c, d in out), key=str)


def brute_codes(rows, dims, parts, entries, rounds, scale):
    kept = [(i, whole(v, scale), la) for i, v, la in rows if complete(v)]
    good = [r for r in kept if len(r[1]) == dims]
    w = dims // parts
    cut = lambda v: [v[s : s + w] for s in range(0, dims, w)]
    first = [cut(v) for _, v, _ in sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]]
    books = [[f[p] for f in first] for p in range(parts)]
    near = lambda x, p: min((far(x, e), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        groups = [[[] for _ in b] for b in books]
        for _, v, _ in good:
            for p, x in enumerate(cut(v)):
                groups[p][near(x, p)[1]].append(x)
        books = [means(b, g) for b, g in zip(books, groups)]
    out, total = [], Counter()
    for i, v, la in kept:
        found = [near(x, p) for p, x in enumerate(cut(v))] if len(v) == dims else None
        out.append((i, la, "".join(f"{n:02x}" for _, n in found) if found else None, sum(d for d, _ in found) if found else None))
        total[la] += out[-1][3] or 0
    mark = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    known = {la for _, la, _, e in out if e is not None}
    return sorted(((str(i), c, e, total[la] if la in known else None, mark) for i, la, c, e in out), key=str)


def some_rows(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    vectors = (centres[rng.integers(0, 5, n)] + rng.normal(size=(n, dims)) * 0.3) * spread
    return [(i * 3 - n, [float(np.float32(x)) for x in v], [0, 0, 0, 1, 7, None][i % 6]) for i, v in enumerate(vectors)]


def odd_rows(dims):
    """Null, wrong, repeated and huge vectors, null ids and ids that several rows share."""
    same = [0.25] * dims
    return [
        (10_001, None, 1), (10_002, [], 2), (10_003, [1.0], 1), (10_004, [None] * dims, 1), (10_005, [float("nan")] * dims, 1),
        (10_006, [float("inf")] * dims, None), (10_007, [float("-inf")] + same[1:], 1), (10_008, [0.0] * dims, None), (10_009, [-0.0] * dims, 1),
        (None, same, 3), (None, same, None), (10_010, same, 3), (10_010, same, 3), (10_010, [-x for x in same], 3),
        *[(10_020 + i, same, 9) for i in range(30)],
    ]


HUGE = [(20_000, [3e38] * 8, 5), (20_001, [-3e38] * 8, 5), (20_002, [3e38, -3e38] * 4, 5)]


@pytest.mark.parametrize("more", [[], HUGE])
def test_clusters_against_brute_force(spark, more, monkeypatch):
    monkeypatch.setattr(centroid_clustering, "BLOCK", 50)
    rows = some_rows(1, 300, 8) + odd_rows(8) + more
    got = centroid_clustering.centroid_clusters(table(spark, rows).repartition(5), k=6, rounds=3, dims=8).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute_clusters(rows, 8, 64, 6, 3)


def test_clusters_with_ties_and_unused_centroids(spark):
    rows = [(i, [float(i % 3 * 2), 0.0], None) for i in range(30)]
    for k in (1, 7, 40):
        got = centroid_clustering.centroid_clusters(table(spark, rows), k=k, dims=2).collect()
        assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute_clusters(rows, 2, 64, k, 3)


def test_tables_hold_occurring_values_only(spark):
    rows = table(spark, [(i, [float(i % 4), 5.0, -1.0], None) for i in range(100)])
    stored = centroid_clustering.blocks(centroid_clustering.whole_vectors(rows, 1, "vec_id").coalesce(1), 3).collect()
    assert [r["seen"] for r in stored] == [[0, 1, 2, 3, 5, -1]] and stored[0]["starts"] == [0, 4, 5, 6]


@pytest.mark.parametrize("spread", [0.01, 1.0, 3000.0])
def test_codes_against_brute_force(spark, spread):
    rows = some_rows(2, 250, 8, spread) + odd_rows(8) + (HUGE if spread == 1.0 else [])
    got = vector_codes.vector_codes(table(spark, rows).repartition(5), parts=4, entries=10).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute_codes(rows, 8, 4, 10, 2, 256)


def test_hot_label_goes_another_way(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HOT", 3)
    rows = some_rows(3, 60, 4)
    got = vector_codes.vector_codes(table(spark, rows), parts=2, entries=5).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute_codes(rows, 4, 2, 5, 2, 256)


def test_cells_give_the_nearest_entry():
    rng = np.random.default_rng(4)
    for width, scale in ((1, 40), (3, 5), (4, 30), (4, 1_000_000)):
        book = np.floor(rng.normal(size=(64, width)) * scale).astype(np.int64)
        book[9] = book[4]
        cells = vector_codes.Cells(book, memory=500)  # forgets several times
        for _ in range(5):
            x = np.floor(rng.normal(size=(400, width)) * scale).astype(np.int64)
            x[:64] = book
            d = ((x[:, None] - book) ** 2).sum(2)
            index, best = cells.nearest(x)
            assert (index == d.argmin(1)).all() and (best == d.min(1)).all()
            assert cells.allowed(x).sum() < x.shape[0] * 64 or width == 1


def test_cells_that_share_a_hash_are_exact(monkeypatch):
    rng = np.random.default_rng(5)
    book, x = rng.integers(-50, 50, (64, 4)), rng.integers(-60, 60, (300, 4))
    monkeypatch.setattr(vector_codes.Cells, "hashed", lambda self, cells: np.zeros(len(cells), np.uint64))
    index, best = vector_codes.Cells(book).nearest(x)
    d = ((x[:, None] - book) ** 2).sum(2)
    assert (index == d.argmin(1)).all() and (best == d.min(1)).all()


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 64, None)]):
        assert centroid_clustering.centroid_clusters(table(spark, rows)).collect() == []
        assert vector_codes.vector_codes(table(spark, rows)).collect() == []
    out = vector_codes.vector_codes(table(spark, [(1, [1.0] * 5, 1)]))
    assert [tuple(r) for r in out.collect()] == [(1, None, None, None, None)]


def test_queries_keep_all_rows(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    for name in ("op11_centroid_clustering", "op12_vector_codes"):
        assert QUERIES[name](spark, SF).count() == n
