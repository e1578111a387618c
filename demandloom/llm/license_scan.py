"""Short license notices in texts, exact or with a few edits.

A notice that may differ by k edits is cut into k + 1 pieces, one of which any
such place must hold unchanged.  One automaton over the pieces of all notices
finds where they stand; each hit says where the notice would begin.  Only the
text around it is matched, by the regex library with bounded errors, which
verifies the edits and says where the notice begins and ends.

Texts are compared as words with single spaces between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import only


class Notice(NamedTuple):
    """Words that may differ by ``edits`` characters; those in ``kept`` (names, versions) must stand unchanged."""

    label: str
    words: str
    kept: str = ""
    edits: int = 0


# The phrases that always count.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

NOTICES = (
    Notice("mit", "under the mit license", "mit", 3),
    Notice("apache-2", "apache license version 2", "2", 3),
    Notice("cc-by-nc", "cc by nc"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", edits=4),
    Notice("cc-by-sa", "cc by sa"),
    Notice("cc-by-sa", "creative commons attribution sharealike", edits=4),
    Notice("gpl-3", "gnu general public license version 3", "gnu 3", 4),
    Notice("gpl-2", "gnu general public license version 2", "gnu 2", 4),
    Notice("lgpl", "gnu lesser general public license", "lesser", 3),
    Notice("agpl-3", "gnu affero general public license version 3", "affero 3", 4),
    Notice("mpl-2", "mozilla public license version 2", "2", 3),
    Notice("bsd", "redistribution and use in source and binary forms", edits=5),
    Notice("bsd-3", "bsd 3 clause license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", edits=7),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", edits=7),
)

#: All ASCII but digits and small letters becomes a space; every other byte is part of a word.
SPACED = bytes(b if b > 127 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))

#: The same words in a text as it stands.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> str:
    """The words of a text, A-Z in lower case, with a space before, between and after them."""
    # bytes.lower changes A-Z only, and bytes.split cuts at ASCII white space only
    return f" {b' '.join(text.encode('utf-8', 'surrogatepass').lower().translate(SPACED).split()).decode('utf-8', 'surrogatepass')} "


def pieces(words: str, n: int) -> list[tuple[int, str]]:
    """A string cut into n pieces of like length, with their places."""
    cuts = [round(i * len(words) / n) for i in range(n + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Found(NamedTuple):
    """A notice in the words of a text: characters from ``start`` to ``end``, differing by ``edits``."""

    start: int
    end: int
    label: str
    edits: int
    phrase: str


class Scanner:
    def __init__(self, notices: Sequence[Notice] = NOTICES):
        self.notices = list(notices)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(self.notices):
            if n.words != " ".join(n.words.split()) or len(n.words) <= n.edits:
                raise ValueError(f"a notice is words with single spaces, of more characters than edits: {n}")
            for at, piece in pieces(n.words, n.edits + 1):
                seeds.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.patterns = [
            # whole words only; of the ways to match here the one with the fewest edits
            regex.compile(rf"(?e)(?<= )(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}(?= )")
            for n in self.notices
        ]

    def candidates(self, words: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the ranges of ``words`` that can hold it, overlapping ones joined, in order."""
        near: dict[int, list[tuple[int, int]]] = {}
        for last, (size, uses) in self.automaton.iter(words):
            for k, at in uses:
                n = self.notices[k]
                # a piece is displaced by at most the edits before it; the neighbours' spaces belong to the match
                begin = last + 1 - size - at - n.edits - 1
                near.setdefault(k, []).append((max(0, begin), min(len(words), begin + len(n.words) + 3 * n.edits + 2)))
        for k, ranges in near.items():
            ranges.sort()
            joined = [ranges[0]]
            for a, b in ranges[1:]:
                if a <= joined[-1][1]:
                    joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
                else:
                    joined.append((a, b))
            near[k] = joined
        return near

    def find(self, words: str) -> list[Found]:
        """All notices in text prepared by ``words_of``, by start; unlike places of one notice don't overlap.

        Exact places win over edited ones that overlap them.
        """
        out: list[Found] = []
        for k, ranges in self.candidates(words).items():
            n, exact = self.notices[k], []
            for a, b in ranges:
                at = words.find(f" {n.words} ", a, b)
                while at >= 0:
                    exact.append(Found(at + 1, at + 1 + len(n.words), n.label, 0, n.words))
                    at = words.find(f" {n.words} ", at + 1, b)
            out += exact
            if n.edits:
                taken = iter([*exact, None])
                nxt = next(taken)
                for a, b in ranges:
                    # what is left between the exact places
                    while nxt is not None and nxt.start < b:
                        out += self._edited(k, words, a, nxt.start)
                        a, nxt = nxt.end, next(taken)
                    out += self._edited(k, words, a, b)
        return sorted(out)

    def _edited(self, k: int, words: str, a: int, b: int) -> list[Found]:
        n, out = self.notices[k], []
        kept = set(n.kept.split())
        while b - a >= len(n.words) - n.edits and (m := self.patterns[k].search(words, a, b)):
            if m[0].strip(" ") == m[0] and kept <= set(m[0].split(" ")):
                out.append(Found(m.start(), m.end(), n.label, sum(m.fuzzy_counts), n.words))
                a = m.end()
            else:
                a = m.start() + 1
        return out


@lru_cache(maxsize=4)
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


FOUND = "array<struct<start:int,end:int,label:string,edits:int,phrase:string,word:bigint>>"


def license_notices(docs: DataFrame, notices: Sequence[Notice] = NOTICES, *carry: str) -> DataFrame:
    """(carry..., n_words, notices) for column ``text``: every notice found, by start, in every whole text.

    ``notices`` holds start and end in code points of the text as it stands
    (end exclusive), label, edits, the phrase that was looked for, and the
    number of the first word.  A null text is empty and has no words.  Rows are
    scanned one by one, so repeated ids and texts each keep their row; ties in
    start are ordered by end and label.  Very long texts are scanned whole, in
    time proportional to their length.  An empty table gives no rows.  Nothing
    is shuffled.
    """
    looked_for = tuple(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(looked_for)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("edits", pa.int32()), ("phrase", pa.string()), ("word", pa.int64())]))
        for batch in batches:
            counts, found = [], []
            for value in batch.column("_text"):
                text = value.as_py() or ""
                words = words_of(text)
                counts.append(words.count(" ") - 1 if len(words) > 2 else 0)
                found.append(located(text, words, scan.find(words)))
            made = [pa.array(counts, pa.int64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "n_words", "notices"])

    rows = only(docs, *carry, "text").select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
    kept = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join([*kept, "n_words bigint", f"notices {FOUND}"]))


def located(text: str, words: str, found: list[Found]) -> list[dict]:
    """The finds with their places in the text as it stands."""
    if not found:
        return []
    spans = [m.span() for m in WORD.finditer(text)]
    out, at, word = [], 0, -1
    for f in found:  # by start, so spaces are counted once
        word, at = word + words.count(" ", at, f.start), f.start
        last = word + words.count(" ", f.start, f.end)
        out.append({"start": spans[word][0], "end": spans[last][1], "label": f.label, "edits": f.edits, "phrase": f.phrase, "word": word})
    return out


def license_scan(docs: DataFrame, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    Base columns count the places where a phrase of BASE stands unchanged.
    ``score`` is the best notice's share of unchanged characters, 0 without
    any.  See ``license_notices`` for odd rows.
    """
    rows = license_notices(docs, notices, "doc_id")
    base = F.filter("notices", lambda n: (n["edits"] == 0) & n["phrase"].isin(*BASE))
    words = F.transform("_base", lambda n: n["word"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda n: n["label"]))), ",")
    shares = F.transform("notices", lambda n: 1 - n["edits"] / F.char_length(n["phrase"]))
    return rows.withColumn("_base", base).select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined("_base").alias("base_labels"), joined("notices").alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).cast("double").alias("score"),
    )
