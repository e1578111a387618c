"""Likeness of lines is asked of twelve-character shingles: brute force over lines with few changes."""

import hashlib
import random

from conftest import SF
from demandloom.llm import line_dedup as ld
from demandloom.llm.queries import QUERIES

from . import test_lines
from .conftest import docs_of


def shingles(line):
    return {line[i : i + 12] for i in range(len(line) - 11)}


def like(x, y):
    a, b = shingles(x), shingles(y)
    return 100 * len(a & b) >= 80 * len(a | b)


def test_a_changed_letter_in_mid_line(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for i in range(120):
        n = 100 + i
        line = "".join(rng.choice("abcdefghij") if k % 7 else " " for k in range(n))
        at = n // 2 + (n // 2 % 7 == 0)
        other = line[:at] + "z" + line[at + 1 :]
        rows += [(2 * i, line), (2 * i + 1, other)]
        want[2 * i], want[2 * i + 1] = 1, int(not like(line, other))
    assert 0 < sum(want.values()) - 120 < 40
    got = {r.doc_id: r.n_kept for r in ld.without_repeated_lines(docs_of(spark, rows)).collect()}
    assert got == want


def test_query(spark, monkeypatch):
    monkeypatch.setattr(test_lines, "shingles", shingles)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in test_lines.brute(rows)}
    assert {str(r.doc_id): r.kept_sha256 for r in QUERIES["op7_line_dedup"](spark, SF).collect()} == want
