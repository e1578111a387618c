"""Language-model scores: the base against brute force, the model against the base."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from conftest import SF
from demandloom.llm import language_model as lm
from demandloom.llm.queries import QUERIES

from .conftest import docs_of


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def brute(rows):
    fold = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i, _ in rows]
    c = Counter(w for (_, t), f in zip(rows, fold) if f != 2 for w in words(t))
    n, v = sum(c.values()), len(c)
    return sorted(
        (str(i), f == 2, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
        for (i, t), f in zip(rows, fold) for w in [words(t)]
    )


def got(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.mark.parametrize("kept", [1 << 19, 3])
def test_base_against_brute_force(spark, monkeypatch, kept):
    monkeypatch.setattr(lm, "KEPT", kept)
    rows = [(i, f"The cat {i % 3} SAT on é{i % 5} mat\n\n of {i}") for i in range(60)] + [(100, None), (101, ""), (None, "the cat"), (None, "the cat"), (102, " \t"), (103, "w" * 9000 + " a" * 50000)]
    out = lm.language_model_scores(docs_of(spark, rows)).collect()
    for a, b in zip(got(out), brute(rows), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])), (a, b)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)


def fitted(spark, rows, times):
    """A model after so many passes over the rows in one task."""
    m = lm.statistics(lm.token_counts(lm.texts_of(docs_of(spark, rows))))
    lexicon, squares = lm.Lexicon(m.describe), np.zeros_like(m.weights)
    for _ in range(times):
        lm.learn(m, lexicon, [t for _, t in rows], m.weights, squares)
    return m


def chances(m, texts):
    """Chance of the last word of each text, by the model."""
    lexicon = lm.Lexicon(m.describe)
    out = []
    for text in texts:
        t = lexicon.tokens([text])
        ids, classes, slots, n = (lexicon.of(c, t) for c in ("id", "class", "slot", "n"))
        size = m.slot_size[classes, np.where(classes < lm.SINGLES, 0, slots)]
        out.append((10 ** lm.log_chances(m, ids, classes, slots, t.place) * (n + 1) / size)[-2])
    return out


def test_words_depend_on_context_and_chances_add_up(spark):
    # the first twelve words take the classes of one word; the words in -xq share one, and contexts tell them apart
    filler = " ".join(f"{c} {c}" for c in "efghijklmnop")
    rows = [(i, f"{filler} red axq blue bxq green so cxq white so dxq w{i % 90}") for i in range(300)]
    m = fitted(spark, rows, 30)
    a, b, c, d = chances(m, ["red axq", "red bxq", "green so cxq", "green so dxq"])
    assert a > 3 * b and c > 3 * d, (a, b, c, d)
    vocabulary = {w.decode() for ws in lm.split([t for _, t in rows]) for w in ws}
    for context in ("", "red", "green so", "e e"):
        known = sum(chances(m, [f"{context} {w}" for w in sorted(vocabulary)]))
        # the rest belongs to the end and to words never seen
        assert 0.3 < known <= 1 + 1e-4, (context, known)


def test_lexicon_starts_anew(monkeypatch):
    describe = lambda ids, endings: pd.DataFrame({"id": ids})
    texts = [f"a b{i} C{i}\n\x0bä{i}" for i in range(30)] + ["", " \t"]
    whole = lm.Lexicon(describe)
    want = [whole.of("id", whole.tokens([t])).tolist() for t in texts]
    monkeypatch.setattr(lm, "LEXICON", 10)
    small = lm.Lexicon(describe)
    assert [small.of("id", small.tokens([t])).tolist() for t in texts] == want
    assert [len(w) for w in want] == [5] * 30 + [1, 1]


def test_empty(spark):
    assert lm.language_model_scores(docs_of(spark, [])).count() == 0


def test_query_beats_base_on_held_out(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = QUERIES["op10_language_model_scores"](spark, SF).collect()
    for a, b in zip(got(out), brute(rows), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])), (a, b)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
