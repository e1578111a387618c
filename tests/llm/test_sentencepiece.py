"""The rebuilt tokenizer against the sentencepiece library."""

import zlib

import numpy as np

from conftest import SF
from demandloom.llm import sentencepiece_codec as sp
from demandloom.llm.queries import QUERIES, tokenizer_path

from .conftest import docs_of

PATH = tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "x\n\ny\t z", "é😀 ▁q", "<s> </s> <unk>", "a" * 3000, "\x00 　", "<0x0A>", "▁▁", "ok ▁", "word " * 20000, None]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "again")] * 2
    lib = sp.library(PATH)
    got = sp.coded(docs_of(spark, rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "again" if r.doc_id is None else ODD[r.doc_id] or ""
        ids = lib.encode(text)
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.parity and r.round_trip == (lib.decode(ids) == text)
    assert sp.coded(docs_of(spark, []), PATH).count() == 0


def test_parity_on_documents(spark):
    lib = sp.library(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_sentencepiece_codec"](spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(lib.encode(texts[r.doc_id]), "<u4").tobytes()) and r.parity and r.round_trip


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def test_unigram_model(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁ab", -1.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("▁a", -2.5, 1), ("bb", -3.0, 1)]
    data = b""
    for p, s, t in pieces:
        body = b"\x0a" + varint(len(p.encode())) + p.encode() + b"\x15" + np.array(s, "<f4").tobytes() + b"\x18" + varint(t)
        data += b"\x0a" + varint(len(body)) + body
    data += b"\x12\x02\x18\x01" + b"\x1a\x04\x18\x01\x20\x00"
    path = tmp_path / "u.model"
    path.write_bytes(data)
    own, lib = sp.Codec(str(path)), sp.library(str(path))
    for text in ["ab", "abb ab", "aabb", "b a", "ab  ab"]:
        assert own.encode([text])[0].tolist() == lib.encode(text), text
    assert own.decode(own.encode(["abb ab"])) == ["abb ab"]
