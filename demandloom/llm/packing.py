"""Best-fit packing planned over a histogram of lengths.

Documents become pieces of at most ``size`` tokens; the plan is made from how
many pieces there are of each length, never from the pieces; pieces take the
planned slots by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm.common import only
from demandloom.sources.io import settle

SIZE, END = 2048, 0

# Fixed value: how byte-level tokenizers of this family cut text before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts as the tokenizer file gives them.

    A byte-level file's vocabulary, read through its tokenizer, drives a faster
    merge loop with the same result; parity is checked when a worker starts.
    Texts that hold a special token, and files of another kind, go through the
    tokenizer itself.
    """

    PROBE = "It's 12,345 of\n\n  the\t ünder \U0001f600 x" * 3

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special)))) if special else None
        self.fast = None
        kind = str(self.tokenizer.pre_tokenizer)
        if "ByteLevel" in kind and "add_prefix_space=False" in kind and self.tokenizer.normalizer is None:
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in w): i for w, i in self.tokenizer.get_vocab().items() if w not in special}
            fast = tiktoken.Encoding("file", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
            if fast.encode_ordinary(self.PROBE) == self.tokenizer.encode(self.PROBE, add_special_tokens=False).ids:
                self.fast = fast

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or (self.special and self.special.search(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of ``size`` but the first, which may be shorter."""
    first = (n - 1) % size + 1
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row; null text is empty and has the end id alone."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer).ids
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].array, b["text"]):
                ids = np.append(ids_of(text), np.array([end], "<u4")).astype("<u4")
                rows += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), size))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    # doc_id travels as text: pandas would turn longs beside nulls into doubles
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            b["doc_id"] = pd.array([None if x is None else int(x) for x in b["doc_id"]], dtype="Int64")
            yield from encode(iter([b]))

    return texts.mapInPandas(run, PIECES)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest first: (length, first rank, ranks, per bin, first bin, offset) of blocks of like bins.

    Bins with the same content are one block (first bin, how many, filled).
    A length goes into the open blocks with the least room that still holds
    it, several to a bin if they fit; at most one block is split for a length,
    so blocks grow with the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {size: []}
    slots, bins = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for free in [r for r in sorted(room) if r >= length]:
            each, kept = free // length, []
            for first, n in room.pop(free):
                take = min(n, left // each)
                if take:
                    slots.append((length, rank, take * each, each, first, size - free))
                    rank, left = rank + take * each, left - take * each
                    room.setdefault(free - each * length, []).append((first, take))
                    first, n = first + take, n - take
                if n and 0 < left < each:
                    slots.append((length, rank, left, left, first, size - free))
                    room.setdefault(free - left * length, []).append((first, 1))
                    rank, left, first, n = rank + left, 0, first + 1, n - 1
                if n:
                    kept.append((first, n))
            if kept:
                room.setdefault(free, []).extend(kept)
            if not left:
                break
        if left:
            each = size // length
            for n, per in ((left // each, each), (1, left % each)):
                if n and per:
                    slots.append((length, rank, n * per, per, bins, 0))
                    room.setdefault(size - per * length, []).append((bins, n))
                    rank, bins = rank + n * per, bins + n
    return slots


def pack(rows: DataFrame, size: int = SIZE, salts: int = 64) -> DataFrame:
    """Add (sequence_id, offset) to pieces (doc_id, piece, start, length, ids_crc32).

    Each sequence's pieces lie gapless from offset 0.  Ranks within a length
    are counted within (length, salt) and shifted by the salts before, so a
    length that a third of all pieces share is ordered in many tasks.  Read by
    the driver: one number for each length and salt, at most size x salts.
    Ties (repeated rows) are ordered arbitrarily; every row gets its own slot.
    """
    spark = rows.sparkSession
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = np.zeros((size + 1, salts), np.int64)
    for r in salted.groupBy("length", "_salt").count().collect():
        counts[r["length"], r["_salt"]] = r["count"]
    starts = np.cumsum(counts, axis=1) - counts
    totals = counts.sum(axis=1)
    slots = plan({n: int(c) for n, c in enumerate(totals) if c}, size)
    shift = [(int(n), int(s), int(starts[n, s])) for n, s in zip(*np.nonzero(counts))]
    # slots of one length are consecutive ranks: an array ordered by first rank for each length
    by_length: dict[int, list] = {}
    for length, rank, n, per, first, offset in sorted(slots):
        by_length.setdefault(length, []).append((rank, per, first, offset))
    table = spark.createDataFrame(
        [(n, s, at, by_length[n]) for n, s, at in shift],
        "length long, _salt int, _shift long, _slots array<struct<rank:long,per:long,first:long,offset:long>>",
    )
    ranked = salted.withColumn("_r", F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")) - 1)
    slot = F.expr("element_at(filter(_slots, x -> x.rank <= _rank), -1)")
    return (
        ranked.join(table, ["length", "_salt"])
        .withColumn("_rank", F.col("_r") + F.col("_shift"))
        .withColumn("_s", slot)
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.expr("_s.first + (_rank - _s.rank) div _s.per").alias("sequence_id"),
            F.expr("_s.offset + (_rank - _s.rank) % _s.per * length").alias("offset"),
        )
    )


def best_fit(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    Null or empty text is the end id alone; rows that share a doc_id are
    packed each for itself; a null doc_id stays null; further columns are not
    read.  An empty table gives no rows.
    """
    return pack(settle(pieces(docs, tokenizer, size, end), "pieces"), size)
