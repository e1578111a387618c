"""Personal data: strict spans against Python's re, added spans, redaction."""

import hashlib
import re

from pyspark.sql import functions as F

from conftest import SF
from demandloom.llm import pii
from demandloom.llm.queries import QUERIES

from .conftest import docs_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(m):
    d = [int(c) for c in reversed(re.sub("[^0-9]", "", m))]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def count(m):
    return len(re.sub("[^0-9]", "", m))


VALID = {
    "email": lambda m: True,
    "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
    "card": lambda m: 16 <= count(m) <= 19 and luhn(m),
    "phone": lambda m: 8 <= count(m) <= 15,
}


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if VALID[k](m.group())]


ODD = [None, "", "a@b.c_d@e.f.g. x@y", "é😀 me@x.de 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3 1.2.3", "4111 1111-1111 1111 4111111111111112 5", "+1 (414) 555-3519 +49 30 1234567 ) +1 2 +999",
       "a" * 50000 + " x@y.z " + "1 " * 3000 + "+1" + " " * 5000, "x\n+1-202-555-0100\n10.0.0.1, me.too+x@mail.example.com.", "a@b" * 200, "9" * 70000, "@.@ a@.b a@b. %@-.-"]


def test_base_spans(spark):
    got = pii.span_digest(pii.personal_data(docs_of(spark, [(i, t) for i, t in enumerate(ODD)] + [(None, "q@r.st")] * 2))).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        want = brute(ODD[r.doc_id] if r.doc_id is not None else "q@r.st")
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (r, text[:200])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in want) for k in PATTERNS]
        assert r.spans == text and r.n_added == 0


def test_empty_table(spark):
    assert pii.span_digest(pii.personal_data(docs_of(spark, []))).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op5_personal_data"](spark, SF).collect():
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_added_spans_find_other_writings(spark):
    docs = []
    for i in range(400):
        d = str(10**9 + i * 7919)
        docs += [f"call +1 ({d[1:4]}) {d[3:6]}-{d[6:10]} or mail u{i}@h{i % 7}.example.com from 10.{i % 256}.3.{(i * 7) % 256}",
                 f"part number {d}{d[::-1]}99{d} in list 999.{900 + i}.888.777 and 1{d[2:9]}-{i}-7", f"version {i}.{i % 9}.300.{i + 400} of it"]
    docs += ["mail u7 [at] h1.example.com or call 1 (204) 555-1234", "nothing here 3.4 at all"]
    found = pii.personal_data(docs_of(spark, list(enumerate(docs))))
    last = {r.doc_id: r for r in found.where("doc_id >= 1200").collect()}
    assert [s.kind for s in last[1200].added if s.kind == "email"] == ["email"]
    assert not last[1201].added and not last[1201].base


def test_redaction(spark):
    spans = [("email", 2, 7), ("ip", 5, 9), ("phone", 9, 11)]
    row = spark.createDataFrame([("ab12345678cdef", spans), ("none", [])], "t string, s array<struct<kind:string,start:long,end:long>>")
    assert [r[0] for r in row.select(pii.redacted(F.col("t"), F.col("s"))).collect()] == ["ab<email><phone>def", "none"]


def test_many_candidates_in_one_text_take_seconds(spark):
    """Candidates are found and judged once for a text: time does not grow with their square of pattern runs."""
    import time

    from pyspark.sql import functions as F

    def took(n):
        text = " and ".join(f"write to user{i} (at) host{i}.example.com" for i in range(n))
        df = spark.createDataFrame([(text,)], "text string").withColumn("_base", F.array().cast("array<struct<kind:string,start:long,end:long>>"))
        start = time.time()
        out = df.select(F.size(pii.added_spans(F.col("text"), F.col("_base"), lambda f: F.lit(0.95), {k: 0.9 for k in pii.KINDS})).alias("n")).first()
        return out.n, time.time() - start

    took(10)
    (few, _), (many, seconds) = took(100), took(2000)
    assert few >= 100 and many >= 2000 and seconds < 20
