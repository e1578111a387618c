"""License notices against plain searches over whole texts."""

import random
import re

import regex

from conftest import SF
from demandloom.llm.license_scan import BASE, NOTICES, Notice, Scanner, license_notices, license_scan, words_of
from demandloom.llm.queries import QUERIES

from .conftest import docs_of

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    """(n_words, n_base, first_word, last_word, base_labels) by comparing word lists."""
    words = WORDS.findall((text or "").translate(LOWER))
    at = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


ODD = [
    None, "", " \n\t", "...", "Under the MIT License", "under the mit license under the mit license", "UNDER-THE_MIT/license!", "under the mit licenses",
    "xunder the mit license", "under the mit license", "éunder the mit license", "under the mit licenseİ", "cc by nc cc by nc by nc", "CC BY-NC 4.0",
    "ccbync", "apache license version 2", "Apache License, Version 2.0 and under the MIT license; cc-by-nc", "apache license version 20", "\U0001f600 cc by nc \U0001f600",
    "under the mit under the mit license license", "apache license apache license version 2",
]


def test_base_against_word_lists(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "cc by nc"), (3, "cc by nc"), (3, "cc by nc")]
    got = license_scan(docs_of(spark, rows)).collect()
    want = [(i, *base(t)) for i, t in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert all(r.score == 1.0 for r in got if r.n_base) and all(0 <= r.score <= 1 for r in got)


def edited(rng, words, edits, kept):
    """``words`` with at most so many characters inserted, deleted or changed outside the kept words, never at an end."""
    marks = [False] * len(words)
    for m in re.finditer(r"\S+", words):
        if m[0] in kept.split():
            marks[max(0, m.start() - 1) : m.end() + 1] = [True] * (m.end() + 1 - max(0, m.start() - 1))
    free = [i for i in range(1, len(words) - 1) if not marks[i]]
    s = list(words)
    for i in sorted(rng.sample(free, rng.randint(0, edits)), reverse=True):
        kind = rng.choice("idc")
        s[i : i + 1] = {"i": [s[i], rng.choice("xyz")], "d": [], "c": [rng.choice("xyz")]}[kind]
    return "".join(s)


def test_edited_notices_are_found():
    """Whatever the regex library finds in the whole text, the seeded search finds, and every planted notice."""
    rng = random.Random(5)
    scan = Scanner()
    filler = "the of under license version public general and le la zorp by cc nc free in 2 3".split()
    for n, notice in enumerate(NOTICES * 12):
        planted = edited(rng, notice.words, notice.edits, notice.kept)
        around = [" ".join(rng.choices(filler, k=rng.randint(0, 60))) for _ in range(2)]
        words = words_of(f"{around[0]} {planted} {around[1]}")
        at = words.index(f" {planted} ") + 1
        mine = [f for f in scan.find(words) if f.phrase == notice.words]
        assert any(f.start < at + len(planted) and f.end > at for f in mine), (planted, mine)
        for f in mine:
            assert f.edits <= notice.edits and set(notice.kept.split()) <= set(words[f.start : f.end].split())
            assert words[f.start - 1] == words[f.end] == " "
        # the library alone, over the whole text
        pattern = regex.compile(rf"(?<= )(?:{regex.escape(notice.words, literal_spaces=True)}){{e<={notice.edits}}}(?= )")
        for m in pattern.finditer(words):
            inside = m[0].strip(" ") == m[0] and set(notice.kept.split()) <= set(m[0].split())
            assert not inside or any(f.start < m.end() and f.end > m.start() for f in mine), (m, mine)


def test_names_and_versions_must_stand():
    scan = Scanner()
    found = lambda t: sorted({f.label for f in scan.find(words_of(t))})
    assert found("under the bsd license, the mpl license, apache license version 1.1") == []
    assert found("GNU General Public License, version 2") == ["gpl-2"]
    assert found("the GNU Lesser General Public License version 3") == ["lgpl"]
    assert found("Released under teh MIT licence.") == ["mit"]
    assert found("Licensed under the Apachee Licence, Version 2.0") == ["apache-2"]
    assert found("permission is hereby  granted, free of charge, to anyone obtaining a copy") == ["mit"]


def test_spans_are_in_the_text_as_it_stands(spark):
    text = "Über \U0001f600: Relased UNDER-the 'MIT' Licence!\nand CC BY-NC 4.0"
    row = license_notices(docs_of(spark, [(1, text)]), NOTICES, "doc_id", "token").collect()[0]
    assert [(text[n.start : n.end], n.label, n.edits, n.word) for n in row.notices] == [
        ("UNDER-the 'MIT' Licence", "mit", 1, 3), ("CC BY-NC", "cc-by-nc", 0, 8),
    ]
    assert row.token == "x" and row.n_words == 13


def test_own_notices(spark):
    mine = (Notice("zorp", "zorp public terms", "zorp", 2),)
    rows = license_scan(docs_of(spark, [(1, "the zorp publik term"), (2, "zurp public terms"), (3, "under the mit license")]), mine).collect()
    assert [(r.doc_id, r.labels, r.n_base) for r in rows] == [(1, "zorp", 0), (2, "", 0), (3, "", 0)]
    assert abs(rows[0].score - (1 - 2 / 17)) < 1e-12


def test_very_long_and_empty(spark):
    text = "filler the license of version " * 100_000 + "cc by nc" + " under the" * 50_000
    row = license_scan(docs_of(spark, [(1, text)])).collect()[0]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (600_003, 1, 500_000, 500_000)
    assert license_scan(docs_of(spark, [])).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op13_license_scan"](spark, SF).collect()}
    assert got == {i: base(t) for i, t in texts.items()}
