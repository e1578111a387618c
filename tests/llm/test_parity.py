"""Parity with the sentencepiece library: a cut that changes ids is noticed in whole texts."""

import zlib

from demandloom.llm import sentencepiece_codec as sp
from demandloom.llm.queries import tokenizer_path


def test_wrong_cut_is_seen(monkeypatch):
    own = sp.Codec(tokenizer_path("piece_bpe_32k.model"), 2)
    texts = [f"some words of text number {i}" for i in range(200)]
    assert all(same for _, same in own.checked(texts))
    cut = own._cut

    def swapped(parts):
        # every word alone is right, their order is not
        return [words[::-1] for words in cut(parts)]

    monkeypatch.setattr(own, "_cut", swapped)
    odd = [not same for _, same in own.checked(texts)]
    assert odd == [zlib.crc32(t.encode()) % sp.WHOLE == 0 for t in texts] and any(odd)


def test_every_text_is_compared_whole():
    own = sp.Codec(tokenizer_path("piece_bpe_32k.model"), 2)
    asked = []

    class Library:
        def encode(self, texts, num_threads=1):
            asked.extend(texts)
            return real.encode(texts, num_threads=num_threads)

    real, own.library = own.library, Library()
    texts = [f"text {i} with  spaces {sp.MARK} and marks " for i in range(40)] + ["", " ", sp.MARK, "a"]
    got = own.checked(texts)
    assert set(texts) <= set(asked) and all(same for _, same in got)
    assert [x.tolist() for x, _ in got] == [real.encode(t) for t in texts]
    assert [t for _, _, t in own.coded(texts)] == own.decode([x for x, _ in got])
