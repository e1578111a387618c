"""Kernel values of mixed words in small arrays, and the words of a text against a plain loop."""

import random
import tracemalloc

import numpy as np

from demandloom.llm import toxicity as tox

from .test_toxicity import brute_kernel

MARKS = ["^abcd", "bcadbc", "^cabd", "dacbadcab"]


def test_words_of_all_lengths_at_once():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("^abcd") for _ in range(n)) for n in (4, 11, 5, 4, 9, 7, 11)]
    got = tox.kernel(words, MARKS)
    want = np.array([[brute_kernel(w, m) for m in MARKS] for w in words])
    assert np.allclose(got, want, rtol=1e-5) and want.any()


def test_arrays_stay_small():
    rnd = random.Random(2)
    marks = ["".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(tox.LANDMARKS)]
    words = ["".join(rnd.choice("abcdefgh") for _ in range(20)) for _ in range(3000)]
    own = tox.Pooler(marks).own
    tracemalloc.start()
    try:
        tox.closeness(words, marks, own)
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()


def plain_words(text):
    out, run = set(), []
    for w in [*text.lower().split(), "--", ""]:
        w = w.strip(tox.PUNCTUATION)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            out.add("".join(run))
        run = []
        if w:
            out.add(w)
    return out


def test_remembered_tokens_give_the_same_values():
    rnd = random.Random(3)
    tokens = ["a", "b,", "C", "...", "d", "the", "Abcd!", "xabcdx", "(bcadbc)", "c-a-b-d", "zzzz"]
    texts = [" ".join(rnd.choice(tokens) for _ in range(rnd.randrange(12))) for _ in range(400)]
    together = tox.Pooler(MARKS)
    for s in range(0, 400, 50):
        got = together.pool(texts[s : s + 50])
        for text, x in zip(texts[s : s + 50], got):
            assert tox.words_of(text) == plain_words(text)
            words = sorted(plain_words(text))
            values = tox.closeness(words, MARKS, together.own) if words else np.zeros((1, len(MARKS)))
            assert np.array_equal(x, values.max(0))
    assert together.skipped
