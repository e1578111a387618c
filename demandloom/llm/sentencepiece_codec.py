"""SentencePiece models through the tokenizers library.

The model protobuf is parsed here; normaliser, metaspace marker, scores and
byte fallback are rebuilt as a tokenizer, and texts are encoded in batches.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from demandloom.llm.common import only
from demandloom.llm.toxicity import chunks

MARK = "▁"

# Piece types and model types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Words whose ids and text a worker keeps, and their characters; a full table starts anew.
KEPT_WORDS, KEPT_CHARS = 600_000, 12_000_000
#: One in so many texts is also encoded whole by the sentencepiece library: all of them.
WHOLE = 1


@dataclass
class Model:
    """What of a model file decides its ids."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message: whole numbers, 4-byte floats and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            if b < 128:
                return n
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 1:
            yield key >> 3, np.frombuffer(data[at : at + 8], "<f8")[0]
            at += 8
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        elif kind == 5:
            yield key >> 3, float(np.frombuffer(data[at : at + 4], "<f4")[0])
            at += 4
        else:
            raise ValueError(f"wire type {kind}")


def parse(data: bytes) -> Model:
    """The model in the bytes of a .model file."""
    m = Model()
    for number, value in fields(data):
        if number == 1:
            piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(fields(value))
            m.pieces.append((piece[1].decode(), piece[2], piece[3]))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    m.kind = v
                elif n == 35:
                    m.byte_fallback = bool(v)
                elif n == 40:
                    m.unk = v
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.remove_spaces = bool(v)
                elif n == 5:
                    m.escape_spaces = bool(v)
    return m


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs that join to a piece, better-scored pieces first; ties by the order of ids."""
    ids = {p: i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER)}
    ranked = sorted(((-score, i, p) for i, (p, score, t) in enumerate(pieces) if t == NORMAL and len(p) > 1))
    return [
        (p[:k], p[k:])
        for _, _, p in ranked
        for k in sorted((k for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids), key=lambda k: (ids[p[:k]], ids[p[k:]]))
    ]


def rebuild(m: Model) -> Tokenizer:
    """A tokenizer that gives the model's ids and texts.

    Texts are cut before each run of markers if no piece holds a marker after
    another character; then no merge or path crosses a cut, and words can be
    cached.
    """
    unk = m.pieces[m.unk][0]
    if m.kind == UNIGRAM:
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unk, byte_fallback=m.byte_fallback))
    elif m.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        tokenizer = Tokenizer(models.BPE(vocab, merges_of(m.pieces), unk_token=unk, fuse_unk=True, byte_fallback=m.byte_fallback))
    else:
        raise ValueError(f"model type {m.kind}")
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.remove_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if m.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if cuttable(m):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tokenizer.decoder = decoder(*([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    return tokenizer


def decoder(*more) -> decoders.Sequence:
    return decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *more])


def cuttable(m: Model) -> bool:
    return m.escape_spaces and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, t in m.pieces if t in (NORMAL, USER))


def words_of(text: str) -> list[str]:
    """Words of a text with a marker before it and for each space; one marker that begins a word is left out."""
    if not text:
        return []
    if MARK not in text and "  " not in f" {text} ":
        return text.split(" ")
    words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", f"{MARK}{text}".replace(" ", MARK))
    return [w if w.startswith(MARK, 1) else w[1:] for w in words]


@lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Codec:
    """Encodes and decodes batches with the rebuilt tokenizer, each distinct word once while it is kept."""

    def __init__(self, path: str, threads: int = 1):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        with open(path, "rb") as f:
            self.model = parse(f.read())
        self.tokenizer = rebuild(self.model)
        self.words = cuttable(self.model) and self.model.dummy_prefix and not self.model.charsmap and not self.model.remove_spaces
        #: Ids of words; a word that begins with one marker stands without it.
        self.known: dict[str, bytes] = {}
        #: The text that the ids of each such word give.
        self.read: dict[str, str] = {}
        self.chars = 0
        self.library = library(path)
        self.threads = threads
        # for single words: nothing to normalise or cut; the space of a text's first word is stripped later
        self.inner = Tokenizer(self.tokenizer.model)
        self.inner.decoder = decoder()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the empty text has none."""
        if not self.words:
            return [np.array(e.ids if t else [], "<i4") for t, e in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False))]
        return self._joined(self._cut(texts))

    def checked(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether the sentencepiece library gives the same for the whole text."""
        return [(ids, same) for ids, same, _ in self.coded(texts)]

    def coded(self, texts: list[str]) -> list[tuple[np.ndarray, bool, str]]:
        """Ids of each text, whether the sentencepiece library gives the same for the whole text, and the text that the ids give.

        Words are decoded one by one: each is whole characters, so no bytes of one belong to the next.
        """
        theirs = self.library.encode(texts, num_threads=self.threads)
        if self.words:
            cut = self._cut(texts)
            ids = self._joined(cut)
            back = ["".join(map(self.read.__getitem__, words)).removeprefix(" ") for words in cut]
        else:
            ids = self.encode(texts)
            back = self.decode(ids)
        return [(x, x.tolist() == y, t) for x, y, t in zip(ids, theirs, back)]

    def _joined(self, cut: list[list[str]]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4") for words in cut]

    def _cut(self, texts: list[str]) -> list[list[str]]:
        """The words of each text as they stand in ``known`` and ``read``, which hold them all."""
        if len(self.known) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.known.clear()
            self.read.clear()
            self.chars = 0
        cut = [words_of(t) for t in texts]
        new = [w for w in set().union(*cut) if w not in self.known]
        marked = [w if w.startswith(MARK) else MARK + w for w in new]
        ids = [e.ids for e in self.inner.encode_batch_fast(marked, add_special_tokens=False)]
        self.known.update(zip(new, (np.array(x, "<i4").tobytes() for x in ids)))
        self.read.update(zip(new, self.inner.decode_batch(ids, skip_special_tokens=False)))
        self.chars += sum(map(len, new))
        return cut

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str, threads: int = 1) -> Codec:
    return Codec(path, threads)


def coded(docs: DataFrame, model: str, threads: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256, round_trip, parity) of every whole text.

    Batches are encoded by ``threads`` threads, at first the cores of a task
    and two at least.  ``round_trip``: decoding the ids gives the text back.
    ``parity``: the sentencepiece library gives the same ids for the whole text.
    ``ids_crc32`` is over little-endian unsigned 32-bit ids.  Null text is
    empty: no tokens.  Repeated rows each get a row, a null doc_id stays null,
    and further columns are not read.
    """

    threads = threads or max(2, int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model, threads)
        for b in (part for batch in batches for part in chunks(batch, 1_000_000)):
            texts = b["text"].tolist()
            ids, parity, back = map(list, zip(*own.coded(texts))) if texts else ([], [], [])
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].array,
                    "n_tokens": [len(x) for x in ids],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    "decoded_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back],
                    "round_trip": [t == u for t, u in zip(texts, back)],
                    "parity": parity,
                }
            )

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = rows.mapInPandas(run, "doc_id string, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean, parity boolean")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))
