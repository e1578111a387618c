"""Line deduplication against brute force over all pairs of lines."""

import random

from conftest import SF
from demandloom.llm import line_dedup as ld
from demandloom.llm.queries import QUERIES

from .conftest import docs_of


def shingles(line):
    return {line[i : i + 12] for i in range(len(line) - 11)}


def brute(rows):
    """(doc_id, text) after dropping all but the first line of each component; blank lines stay."""
    places = sorted((-1 if i is None else i, k, x) for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip())
    distinct = sorted({x for _, _, x in places})
    sets = [shingles(x) for x in distinct]
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(distinct)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= 80 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    comp = {x: find(k) for k, x in enumerate(distinct)}
    first = {}
    for i, k, x in places:
        first.setdefault(comp[x], (i, k))
    out = []
    for i, t in rows:
        if t is None:
            out.append((str(i), None))
            continue
        keep = [x for k, x in enumerate(t.split("\n")) if not x.strip() or first[comp[x]] == (-1 if i is None else i, k)]
        out.append((str(i), "\n".join(keep)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(None, "the first line is long enough for it\nshort"), (9001, "the first line is long enough for it\nshort\n\nshort"), (9002, None), (9003, ""), (9004, "x" * 30000 + "\n" + "x" * 29999), (9005, "é" * 40 + "\n" + "é" * 40),
            (9006, "the first line is long enough for it\nother"), (9006, "the first line is long enough for it\nother")]
    bases = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(rng.choice([6, 12, 20, 25, 30, 60, 150]))) for _ in range(60)]
    for i in range(80):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(bases).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    got = sorted(((str(r.doc_id), r.text) for r in ld.without_repeated_lines(docs_of(spark, rows)).collect()), key=str)
    want = brute(rows)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert len(got) == len(want) and not wrong, wrong[:2]


def test_equal_sets_of_any_length_and_short_lines(spark):
    """Lines of the same repeated characters are like each other at any length; short lines are repeated by equal ones."""
    rows = [(1, "- " * 20 + "\n" + "ab " * 15 + "\nyes\n\n  \nyes"), (2, "- " * 60), (3, "ab " * 40 + "\nyes\nno"), (4, "yes\n" + "- " * 45), (5, "x" * 11), (6, "x" * 11), (7, "x" * 12), (8, "x" * 5000)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in ld.without_repeated_lines(docs_of(spark, rows)).collect()}
    assert got[1] == ("- " * 20 + "\n" + "ab " * 15 + "\nyes\n\n  ", 6, 5)
    assert got[2] == ("", 1, 0) and got[3] == ("no", 3, 1) and got[4] == ("", 2, 0)
    assert got[5] == ("x" * 11, 1, 1) and got[6] == ("", 1, 0) and got[7] == ("x" * 12, 1, 1) and got[8] == ("", 1, 0)


def test_columns_of_any_name_stay(spark):
    from pyspark.sql import functions as F

    names = ["_drop", "drop", "doc", "_doc", "key", "row", "line", "n_lines", "a.b"]
    df = spark.createDataFrame([(1, "one line here for all\nother"), (2, "one line here for all")], "doc_id long, text string").withColumns({c: F.lit("x") for c in names if c != "a.b"})
    df = df.withColumn("a.b", F.lit("y"))
    out = ld.without_repeated_lines(df)
    assert out.columns == [*[c for c in df.columns if c != "n_lines"], "n_lines", "n_kept"]
    assert all(r["_drop"] == r["doc"] == r["row"] == "x" and r["a.b"] == "y" for r in out.collect())
    assert {r.doc_id: r.text for r in out.collect()} == {1: "one line here for all\nother", 2: ""}


def test_recall_of_bands():
    """Pairs at the least likeness share a band nearly always."""
    rng, missed, tried = random.Random(9), 0, 0
    for _ in range(3000):
        n = rng.randrange(90, 400)
        line = "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
        at = sorted(rng.sample(range(n), max(1, n // 120)))
        other = "".join("#" if i in at else c for i, c in enumerate(line))
        p, q = shingles(line), shingles(other)
        if 0.8 <= len(p & q) / len(p | q) <= 0.9:
            x, y = ld.bands([line, other])
            tried += 1
            missed += not set(x.tolist()) & set(y.tolist())
    assert tried > 500 and missed <= tried / 300


def test_empty(spark):
    assert ld.without_repeated_lines(docs_of(spark, [])).count() == 0


def test_query(spark):
    import hashlib

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute(rows)}
    got = {str(r.doc_id): r.kept_sha256 for r in QUERIES["op7_line_dedup"](spark, SF).collect()}
    assert got == want
