"""Fingerprints, URL filters and packing against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import check
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from demandloom.llm import fingerprint, packing, url_filter
from demandloom.llm.queries import ORACLE, QUERIES, tokenizer_path

from .conftest import docs_of

ODD = [(3, None), (1, ""), (None, "a b c d e f"), (2, "a b c d e f"), (9, "é " * 40), (2, "zz"), (5, "word " * 30000), (6, "\n\t "), (6, "\n\t ")]


def test_edited_texts(spark):
    got = fingerprint.edited_fingerprints(docs_of(spark, ODD)).collect()
    rows = sorted(((-1 if i is None else i, t or "") for i, t in ODD))
    ids = sorted({i for i, _ in rows})
    first = {i: min((t for j, t in rows if j == i)) for i in ids}
    want = []
    for i, t in rows:
        after = first[ids[(ids.index(i) + 1) % len(ids)]]
        if i == 1:  # the next id has two texts; the smaller cut counts
            after = min("a b c d e f"[: len(t) // 2], "zz"[: len(t) // 2])
        e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by = defaultdict(set)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by[r.n_chars, r.shingles_estimate].add(r.fingerprint)
    assert len({r.fingerprint for r in got if r.n_chars == 11}) == 1


def test_edited_one_row_and_empty(spark):
    assert fingerprint.edited_fingerprints(docs_of(spark, [(7, "abcd")])).first().near_next == 1.0
    assert fingerprint.edited_fingerprints(docs_of(spark, [])).count() == 0


def test_sketch_estimates(spark):
    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1000, 4000))
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint.sketch(F.col("a")).alias("a"), fingerprint.sketch(F.col("b")).alias("b")
    ).select(
        fingerprint.resemblance(F.col("a"), F.col("b")).alias("j"),
        fingerprint.containment(F.col("a"), F.col("b")).alias("c"),
        fingerprint.distinct_count(F.col("a")).alias("n"),
    ).first()
    assert abs(row.j - 0.5) < 0.15 and abs(row.c - 2 / 3) < 0.2 and abs(row.n - 2996) < 900


def test_merge_groups(spark):
    parts = spark.createDataFrame([(i % 2, f"a{i} b{i} c d e f g") for i in range(300)], "g int, t string")
    got = {r.g: r.s for r in fingerprint.merge_groups(parts.withColumn("s", fingerprint.sketch(F.col("t"))), ["g"], "s").collect()}
    every = {g: sorted({h for r in parts.where(f"g={g}").select(fingerprint.sketch(F.col("t"), 10**6).alias("s")).collect() for h in r.s}) for g in (0, 1)}
    assert got == {g: every[g][:128] for g in (0, 1)}


def test_url_rules(spark):
    urls = [None, "", "x", "http://", "http://a b.com/x", "http://a b.net/es/1", "http://a\nb.net/fr/\n", "http://example.com /en/", "http://x.com\n/en/", "http://.com/", "http://com/", "HTTP://Example.COM/en/a?b#c", "http://www.example.com/en/x", "http://a.www.example.com/en/",
            "http://notexample.com/en/", "http://example.com", "http://a.net/es/1", "http://a.net/ES/1", "http://com/", "http://x.com#/en/",
            "http://h.example.com/en", "http://a.net/fr/" + "y" * 100000, "http://com:80/"]
    rows = [(i, u) for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit("x") for n in ("token", "n", "pattern", "host", "rule")})
    got = url_filter.url_filter(pages, url_filter.rule_table(spark, url_filter.RULES)).collect()
    assert len(got) == len(rows)
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(k), k, v) for k, v in url_filter.RULES if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/"):])]
        want = max(fit)[1:] if fit else (None, "allow")
        assert (r.host, r.path, (r.rule, r.verdict)) == (host, path, want), r.url[:50]


def test_rule_index_uses_rarest_token(spark):
    rules = url_filter.rule_table(spark, url_filter.RULES)
    seen = spark.createDataFrame([("", 100), ("com", 90), ("example", 50), ("en", 60), ("www", 7), ("net", 20), ("es", 3)], "token string, n long")
    got = {r.rule: r.token for r in url_filter.index_rules(rules, seen).collect()}
    assert got == {"com/": "com", "example.com/en/": "example", "www.example.com/en/": "www", "net/es/": "es", "net/fr/": "fr"}


def test_url_query_matches_sql(spark):
    duck = check.connect(SF)
    rel = duck.execute(ORACLE["op2_url_filters"])
    names = [d[0] for d in rel.description]
    got = QUERIES["op2_url_filters"](spark, SF).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rel.fetchall()))


@pytest.mark.parametrize("texts", [ODD, [(1, "it's 12 ab\n\n  cd <|endoftext|> ÿ\U0001f600" * 700), (2, None)], []])
def test_packing(spark, texts):
    got = packing.best_fit(docs_of(spark, texts), tokenizer_path()).collect()
    t = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        spans = [(0, first)] + [(s, 2048) for s in range(first, len(ids), 2048)]
        want += [(i, k, s, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s : s + n]))) for k, (s, n) in enumerate(spans)]
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got))) == sorted(map(str, want))
    places(got)


def places(rows):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    return len(seqs)


def test_plan_is_tight_and_small():
    import random

    rng = random.Random(0)
    counts = {n: rng.randrange(1, 5000) for n in range(1, 2049) if rng.random() < 0.7}
    slots = packing.plan(counts)
    assert len(slots) < 20 * len(counts)
    bins = max(first + -(-n // per) for _, _, n, per, first, _ in slots)
    assert bins <= 1.02 * sum(n * c for n, c in counts.items()) / 2048 + 1
    ranks = defaultdict(list)
    for length, rank, n, *_ in slots:
        ranks[length].append((rank, n))
    for length, c in counts.items():
        at = 0
        for rank, n in sorted(ranks[length]):
            assert rank == at
            at += n
        assert at == c


def test_packing_query(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    n = places(rows)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_packing_ids_are_the_tokenizers(spark):
    """Every piece of every document of a table, special tokens and odd spaces included, against the tokenizer itself."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from demandloom.llm.queries import tokenizer_path

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
