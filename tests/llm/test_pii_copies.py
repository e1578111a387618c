"""Copies of a document change nothing in what the trees are fitted and calibrated on."""

from pyspark.sql import functions as F

from demandloom.llm import pii

from .conftest import docs_of


def corpus():
    docs = []
    for i in range(400):
        d = str(10**9 + i * 7919)
        docs += [f"call +1 ({d[1:4]}) {d[3:6]}-{d[6:10]} or mail u{i}@h{i % 7}.example.com from 10.{i % 256}.3.{(i * 7) % 256}",
                 f"part number {d}{d[::-1]}99{d} in list 999.{900 + i}.888.777 and 1{d[2:9]}-{i}-7", f"version {i}.{i % 9}.300.{i + 400} of it"]
    return list(enumerate(docs))


def rows_of(df):
    return sorted((r.label, r.kind, tuple(r.f), r.held) for r in df.collect())


def test_one_candidate_in_a_third_of_all_rows(spark):
    rows = corpus()
    docs = docs_of(spark, rows)
    first = docs.select("doc_id", "text", F.explode(pii.candidates(F.col("text"))).alias("x"), pii.base_spans(F.col("text")).alias("b"))
    order = F.xxhash64("x.m", "x.left")
    good = first.where("exists(b, s -> s.start = x.start and s.end = x.end)").orderBy(order).first()
    bad = first.where("size(b) = 0").orderBy(order).first()
    copies = docs_of(spark, rows + [(5000 + i, t) for i in range(300) for t in (good.text, bad.text)])
    once, often = pii.training_rows(docs, 240), pii.training_rows(copies, 240)
    assert rows_of(once) == rows_of(often)
    labels = {(r.kind, r.label) for r in often.collect()}
    assert {(k, 1.0) for k in ("email", "ip", "phone")} <= labels
    bounds = pii.fit(copies, 240)[1]
    assert bounds and bounds == pii.fit(docs, 240)[1]
