"""Jaccard join against brute force over all pairs."""

import random
import re

from conftest import SF
from demandloom.llm import jaccard_join as jj
from demandloom.llm.queries import QUERIES

from .conftest import docs_of


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, a) in enumerate(named):
        for j, b in named[n + 1 :]:
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(((str(i), len(s), None if i is None else find(i)) for i, s in sets), key=str)


def got(df):
    return sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        k = rng.randrange(3)
        at = rng.randrange(len(out)) if out else 0
        if k == 0:
            out[at:at] = [f"n{rng.randrange(99)}"]
        elif out and k == 1:
            del out[at]
        elif out:
            out[at] = f"r{rng.randrange(99)}"
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(None, "a b c d e f"), (7001, "a b c d e f"), (7002, "A B\tc\nd e F"), (7003, None), (7004, ""), (7005, " \n"), (7006, "a b"), (7007, "A  b "), (7006, "q r s t u v w"), (7008, "Q r s t u v w")]
    for i in range(120):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 9, 12, 20, 30, 45, 60, 90, 140, 300]))]
        text = base
        for j in range(rng.randrange(1, 6)):
            rows.append((rng.randrange(10**6) * 8 + j, " ".join(text)))
            text = edited(rng, text if rng.random() < 0.6 else base, max(1, len(base) // rng.choice([25, 40, 60, 100])))
    assert len({i for i, _ in rows}) == len(rows) - 1
    want = brute(rows)
    # the two texts under one id share a component
    assert got(jj.similarity_classes(docs_of(spark, rows))) == want


def test_empty(spark):
    assert jj.similarity_classes(docs_of(spark, [])).count() == 0


def test_signatures_cover_similar_sets():
    import numpy as np

    rng = np.random.default_rng(1)
    missed = tried = 0
    for n in [4, 5, 6, 8, 10, 13, 17, 22, 30, 41, 60, 100, 200, 500]:
        for _ in range(40):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            d = int(n * 0.11)
            b = np.concatenate([a[d:], rng.integers(0, 2**63, d if n >= 10 else 0).astype(np.uint64)])
            if d == 0:
                b = np.concatenate([a, rng.integers(0, 2**63, int(n * 0.25)).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                tried += 1
                missed += not len(np.intersect1d(jj.signatures(a), jj.signatures(b)))
    assert tried > 300 and missed == 0


def test_counted_bits_are_packed_and_filtered_without_a_miss():
    import numpy as np

    rng = np.random.default_rng(2)
    for ranges in (1, 7, 800):
        once, twice = rng.integers(-(2**63), 2**63 - 1, 40_000), rng.integers(-(2**63), 2**63 - 1, 3000)
        edges = np.array([-(2**63), -1, 0, 2**63 - 1])
        starts, blocks = jj.range_starts(ranges), {}
        for part in (np.concatenate([once, twice, edges]), np.concatenate([twice[:2000], edges]), np.repeat(twice[2000:], 2)):
            for r, low, high in jj.packed(jj.counted(part), starts):
                blocks.setdefault(r, []).append(jj.unpacked(low, high) + starts[r])
        assert sum(len(x) for b in blocks.values() for x in b) == 40_000 + 3000 + 4 + 2000 + 4 + 2000
        found = [(r, *jj.filter_of(np.concatenate(b), 1 << 20)) for r, b in blocks.items()]
        shared = jj.Shared(ranges, [x for x in found if x[1]])
        assert len(shared.holds(np.concatenate([twice, edges]))) == 3004
        # what comes once leaves its task in few cases; a full filter lets more through, but never misses
        assert len(shared.holds(once)) < 0.05 * len(once)
        full = jj.Shared(ranges, [(r, *jj.filter_of(np.concatenate(b), 64)) for r, b in blocks.items() if jj.filter_of(np.concatenate(b), 64)[0]])
        assert len(full.holds(np.concatenate([twice, edges]))) == 3004
    assert len(jj.Shared(4, []).holds(once)) == 0


def test_signatures_of_one_set_stay_in_their_task(spark):
    """Equal texts are one set, so only the edited copy and its original send signatures; before, every row sent all of its own."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    words = [f"v{i}" for i in range(100_000)]
    rows = [(i, " ".join(rng.sample(words, 150))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(200, rows[1][1] + " and some more")]
    docs = docs_of(spark, rows).repartition(3)
    one = jj.bit_array(docs.where("doc_id < 60 or doc_id = 200"), "doc_id")
    by_id = {i: jj.shingle_sets([t])[0] for i, t in rows}
    sent = jj.signed(docs, one, jj.shared_signatures(docs, one)).groupBy("sig").agg(F.collect_set("key").alias("keys")).collect()
    a, b = by_id[1], by_id[200]
    both = set(jj.signatures(a).tolist()) & set(jj.signatures(b).tolist())
    assert both and both <= {r.sig for r in sent if set(r["keys"]) >= {jj.set_key(a), jj.set_key(b)}}
    assert len(sent) <= len(both) + 0.05 * sum(len(jj.signatures(s)) for s in by_id.values())
    assert got(jj.similarity_classes(docs)) == brute(rows)


def test_texts_of_near_pairs_only_are_sent_and_decide(spark):
    import zlib

    rows = [(i, f"a b c d e {i}") for i in range(300)] + [(7, "x y z"), (400, "A  b c d e 9"), (401, "é \u4e2d \U0001f600 q r s")]
    docs = docs_of(spark, rows)
    key = {t: jj.set_key(jj.shingle_sets([t])[0]) for _, t in rows}
    wanted = spark.createDataFrame([(i, key[t]) for i, t in rows if i in (9, 12, 401) or t == "x y z"], "doc_id long, key long")
    texts = jj.texts_of(docs, wanted)
    assert sorted(zlib.decompress(r.text).decode() for r in texts.collect()) == sorted(t for i, t in rows if i in (9, 12, 401) or t == "x y z")
    pairs = [(key["a b c d e 9"], key["a b c d e 12"]), (key["x y z"], key["x y z"]), (key["x y z"], key[rows[-1][1]])]
    found = jj.jaccard_links(spark.createDataFrame(pairs, "a long, b long"), texts).collect()
    assert [tuple(r) for r in found] == [pairs[1]]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(QUERIES["op8_ngram_jaccard_join"](spark, SF)) == brute(rows)
