"""The pipeline stage by stage against plain Python, and toxicity by held-out accuracy."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF
from demandloom.llm import toxicity as tox
from demandloom.llm.queries import QUERIES
from demandloom.sources.io import settle

from .conftest import docs_of
from .test_first import places
from .test_jaccard import brute as classes
from .test_lines import brute as lines
from .test_pii import brute as spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = settle(cp.drop_toxic(spark, docs, SF), "t")
    assert one.columns == COLUMNS
    found = {r.doc_id: r.predicted for r in QUERIES["op3_toxicity"](spark, SF).collect()}
    assert {r.doc_id for r in one.collect()} == {i for i, p in found.items() if not p}
    before = rows_of(one)
    two = settle(cp.drop_repeated_lines(spark, one, SF), "t")
    want = dict((int(i), t) for i, t in lines(before))
    assert rows_of(two) == sorted(((i, want[i]) for i, t in before if want[i] == t or want[i].strip()), key=str)
    assert two.where("n_chars <> char_length(text)").count() == 0
    three = settle(cp.drop_near_copies(spark, two, SF), "t")
    keep = {i for i, _, c in classes(rows_of(two)) if str(c) == i}
    assert rows_of(three) == [x for x in rows_of(two) if str(x[0]) in keep]
    four = settle(cp.redact(spark, three, SF), "t")

    def redacted(text):
        out, at = "", 0
        for k, s, e in sorted(spans(text), key=lambda x: (x[1], x[2])):
            if s >= at:
                out, at = out + text[at:s] + f"<{k}>", e
            at = max(at, e)
        return out + text[at:]

    assert rows_of(four) == sorted(((i, redacted(t)) for i, t in rows_of(three)), key=str)
    assert four.columns == COLUMNS
    last = cp.pack(spark, four, SF).collect()
    assert {r.doc_id for r in last} == {i for i, _ in rows_of(four)}
    assert places(last) <= 1.05 * sum(r.length for r in last) / 2048 + 1


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words that are here for it all", None, "s", 5), (3, "some words that are here for it all", "x", None, None),
           (3, "some words that are here for it all", "x", None, None), (4, "me@x.org " * 3000, "x", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(odd, schema)
    for _, stage in cp.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF), "t")
        assert docs.columns == COLUMNS
    left = rows_of(docs)
    assert (1, None) in left and (2, "") in left and (None, None) in left
    assert dict(left)[4] == "<email> " * 3000
    assert cp.pack(spark, docs, SF).count() >= 5
    empty = spark.createDataFrame([], schema)
    for _, stage in cp.STAGES:
        empty = settle(stage(spark, empty, SF), "t")
    assert empty.count() == 0


def test_kernel_against_enumeration():
    from itertools import combinations

    def brute(s, t):
        def feats(x):
            out = {}
            for c in combinations(range(len(x)), tox.ORDER):
                u = "".join(x[i] for i in c)
                out[u] = out.get(u, 0) + tox.DECAY ** (c[-1] - c[0] + 1)
            return out

        a, b = feats(s), feats(t)
        return sum(v * b.get(u, 0) for u, v in a.items())

    for w, marks in [("idioot", ["idiot", "moron", "trashy"]), ("abcde", ["abcde", "xyz"])]:
        assert np.allclose(tox.kernel([w], marks)[0], [brute(w, m) for m in marks], rtol=1e-4)


def test_gaps_and_inserted_letters():
    p = tox.Pooler(["^idiot"])
    got = p.pool(["you idiot!", "an id-iot", "the i.d.i.o.t", "i d i o t", "idxiot here", "a plain idea of it", "", "x" * 500 + "idiot"])[:, 0]
    assert (got[:5] > 0.3).all() and got[0] == 1 and (got[5:7] == 0).all()


def test_toxicity_learns(spark):
    rng = np.random.default_rng(0)
    plain = ["stone", "river", "maple", "light", "under", "window", "carry", "seven", "garden", "letter"]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 20))
        bad = i % 4 == 0
        if bad:
            w[int(rng.integers(20))] = ["blorgum", "blor-gum", "blorgums", "zazfik"][i // 4 % 4]
        rows.append((i, " ".join(w)))
        labels.append((i, None, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "blorgum"), (1002, "stone b l o r g u m river"), (1002, "stone b l o r g u m river")]
    labels += [(1001, 0, None), (None, 0, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    out = tox.toxicity(docs_of(spark, rows), lab).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 1000 and r.held_out:
            assert r.predicted == (r.doc_id % 4 == 0), r
    assert [r.predicted for r in out if r.doc_id == 1002] == [1, 1]
    none = tox.toxicity(docs_of(spark, rows[:5]), lab.where("false")).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in none)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    out = QUERIES["op3_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted for r in out if r.toxic)
    assert hit >= 0.6 * sum(r.toxic for r in out)
    assert sum(r.predicted for r in out if not r.toxic) <= 0.08 * sum(1 - r.toxic for r in out)


def test_stage_names():
    assert [re.sub("_.*", "", n) for n, _ in cp.STAGES] == ["toxicity", "line", "ngram", "personal", "packing"]


def test_near_copies_with_ids_that_repeat_or_are_missing(spark):
    """Rows that share an id are told apart by their texts; missing ids come before all; every text is compared."""
    words = [f"w{i}" for i in range(60)]
    copy, other, third = " ".join(words), " ".join(reversed(words)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, copy), (1, other), (2, copy), (3, third), (3, third + " more"), (None, other), (None, "Alone here."), (None, None), (4, None), (5, "Alone here.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x"))
    got = cp.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert [t for _, t in left].count(None) == 2 and (1, copy) in left and (2, copy) not in left and (None, other) in left and (1, other) not in left
    assert sum(i == 3 for i, _ in left) == 1 and (None, "Alone here.") in left and (5, "Alone here.") not in left


def test_columns_of_any_name_come_through(spark):
    names = ["_blank", "_n", "_doc", "_base", "_added", "_drop", "drop", "row", "text2", "lang"]
    docs = spark.createDataFrame([(1, "mail me at a.b@example.com today", 32), (2, "another line", 12)], "doc_id long, text string, n_chars long")
    docs = docs.withColumns({c: F.lit(c) for c in names})
    for stage in (cp.drop_repeated_lines, cp.drop_near_copies, cp.redact):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r[c] == c for r in out.collect() for c in names) and out.count() == 2
