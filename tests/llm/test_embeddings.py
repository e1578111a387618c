"""Embedding near-duplicates against all cosines."""

from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from demandloom.llm import embedding_dedup
from demandloom.llm.embedding_dedup import near_duplicates
from demandloom.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids = [i for i, _ in good]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links, label = {}, {i: i for i, _ in rows if i is not None}
    for k, i in enumerate(ids):
        links[i] = links.get(i, 0) + int(near[k].sum())
    while True:
        before = dict(label)
        for a, b in zip(*np.nonzero(near)):
            low = min(label[ids[a]], label[ids[b]])
            label[ids[a]] = label[ids[b]] = low
        if label == before:
            break
    return sorted(((str(i), links.get(i, 0), label.get(i), i is not None and label[i] == i) for i, _ in rows), key=str)


def got(df):
    return sorted(((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(40):
        c = rng.normal(size=8) * np.array([5, 4, 3, 2, 1, 1, 1, 1])
        rows += [(len(rows) + k, [float(x) for x in (c + rng.normal(size=8) * rng.choice([0.2, 0.8])).astype(np.float32)]) for k in range(rng.integers(1, 9))]
    n = len(rows)
    same = rows[0][1]
    rows += [(n, None), (n + 1, [0.0] * 8), (n + 2, [float("nan")] * 8), (n + 3, [None] * 8), (n + 4, [1.0, 2.0]), (None, same), (n + 5, same), (n + 6, []), (n + 7, [1e-30] * 8), (n + 8, [3e38] * 8), (n + 9, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("tile", "v", "cell", "label", "n")})
    assert got(near_duplicates(df, tile=16)) == brute(rows)


def test_every_length_is_compared(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0, 0.0]), (4, [0.0, 5.0, 0.5]), (5, [1.0, 1.0, 1.0]), (6, [1.0]), (7, [3.0]), (8, [-1.0]), (9, [1.0] * 5)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9)}


def test_empty_and_unusable(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(near_duplicates(spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA))) == [("1", 0, 1, True), ("2", 0, 2, True)]


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = (x @ x.T >= 0.95).sum(1) - 1
    assert {r.vec_id: r.n_links for r in QUERIES["op6_embedding_near_dedup"](spark, SF).collect()} == {i: int(k) for (i, _), k in zip(rows, n)}


def test_vectors_are_written_once_and_never_shuffled(spark, tmp_path, monkeypatch):
    """Vectors far from each other along no axis: all tiles meet, and what is written stays below twice the input."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64)).astype(np.float32)
    x[3000:3040] = x[0] + 0.02 * rng.normal(size=(40, 64))
    path, kept = str(tmp_path / "vectors"), []

    def settle(df, name):
        kept.append((name, str(tmp_path / f"{name}-{len(kept)}")))
        df.write.parquet(kept[-1][1])
        return spark.read.schema(df.schema).parquet(kept[-1][1])

    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).repartition(3).write.parquet(path)
    monkeypatch.setattr(embedding_dedup, "settle", settle)
    rows = near_duplicates(spark.read.parquet(path), tile=64).collect()
    assert sum(f.stat().st_size for _, k in kept for f in Path(k).glob("*.parquet")) < 2 * x.nbytes
    packed = spark.read.parquet(*[k for name, k in kept if name == "tiles"])
    assert packed.agg(F.sum(F.length("data"))).first()[0] == x.nbytes and packed.count() >= 6000 / 64
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = (x @ x.T >= 0.95).sum(1) - 1
    assert {r.vec_id: r.n_links for r in rows} == {i: int(k) for i, k in enumerate(n)}


def test_bounds_and_dense_tiles():
    from demandloom.llm.embedding_dedup import bounds_of, similar, units

    rng = np.random.default_rng(9)
    for spread in (0.05, 0.3, 2.0):
        x, y = (1 + spread * rng.normal(size=(n, 24)) for n in (300, 200))
        axes = np.linalg.qr(rng.normal(size=(24, 24)))[0]
        whole = units(x) @ units(y).T
        a, b = bounds_of(units(x), axes), bounds_of(units(y), axes)
        assert (a @ b.T >= whole - 1e-5).all()
        i, j = similar(a, b, x, y, 0.95)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(whole >= 0.95))))
