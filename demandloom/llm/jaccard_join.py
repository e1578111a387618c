"""N-gram Jaccard join by PartEnum signatures.

Sets of like size share a band.  Within a band the feature domain is cut into
n1 parts of n2 pieces each; if two sets differ in at most k elements, some
part differs in at most k2, and then the two agree on one of the enumerated
choices of n2 - k2 of its pieces.  A signature is the hash of the elements in
such a choice, so two similar sets share at least one.

Most signatures belong to one set.  They are signed twice: first a few bytes
of each are counted, then only those that come more than once leave their
task whole, with the set's key.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import bit_array, may_link, near_pairs, only, similarity_components, slot_of
from demandloom.llm.shingles import WORDS, mix, set_key, shingle_sets
from demandloom.sources.io import settle

#: Similarity as a fraction of whole numbers: 100 * both >= 80 * either.
NUMERATOR, DENOMINATOR = 80, 100

#: Sizes of a band: the largest is less than this times the smallest.
BAND = 1.5625


@lru_cache(maxsize=4096)
def scheme(k: int) -> tuple[int, int, tuple[tuple[int, ...], ...]]:
    """(n1, n2, choices of pieces) for sets that differ in at most k elements.

    Small k use many pieces, so that a choice is hardly ever without elements;
    large k use the choice of two of three pieces, which needs the fewest
    signatures for what it selects.
    """
    if k == 0:
        return 1, 1, ((0,),)
    if k <= 4:
        n1, n2, k2 = 1, {1: 16, 2: 10, 3: 8, 4: 8}[k], k
    elif k <= 20:
        k2, n2 = 2, 6 if k <= 8 else 5
        n1 = -(-(k + 1) // (k2 + 1))
    else:
        k2, n2 = 1, 3
        n1 = -(-(k + 1) // 2)
    return n1, n2, tuple(combinations(range(n2), n2 - k2))


def band_of(n: int) -> int:
    return int(math.log(n) / math.log(BAND) + 1e-9)


def band_top(b: int) -> int:
    """The largest size in band b."""
    n = int(BAND ** (b + 1)) + 2
    while band_of(n) > b:
        n -= 1
    return n


@lru_cache(maxsize=256)
def band_scheme(b: int, numerator: int = NUMERATOR, denominator: int = DENOMINATOR):
    """(n1, n2, choices, hashed names of (choice, part), factor) of band b.

    Two similar sets r and s differ in |r| + |s| - 2 both elements, and both is
    at least t / (1 + t) of |r| + |s|.
    """
    top = band_top(b)
    n1, n2, choices = scheme(2 * top * (denominator - numerator) // (denominator + numerator))
    names = mix(np.arange(len(choices) * n1, dtype=np.uint64) + np.uint64(b << 40)).reshape(len(choices), n1)
    return n1, n2, choices, names, mix(np.array([b + 1], np.uint64))[0] | np.uint64(1)


def signatures(s: np.ndarray, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> np.ndarray:
    """Signatures of one sorted set, as signed 64-bit numbers.

    A set signs its own band, and the next if a similar set can lie there.
    Choices without elements give no signature: for sets that differ only so,
    all agreeing choices would have to be empty, which the piece counts above
    keep below one in 100,000.
    """
    n = len(s)
    if not n:
        return np.zeros(0, np.int64)
    own = band_of(n)
    bands = [own] + ([own + 1] if n * denominator >= (band_top(own) + 1) * numerator else [])
    value, out = mix(s), []
    for b in bands:
        n1, n2, choices, names, factor = band_scheme(b, numerator, denominator)
        piece = ((value * factor) >> np.uint64(34)) % np.uint64(n1 * n2)
        # short numbers are sorted by radix
        piece = piece.astype(np.int16 if n1 * n2 < 1 << 15 else np.int64)
        order = np.argsort(piece, kind="stable")
        at = piece[order]
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        sums = np.zeros(n1 * n2, np.uint64)
        sums[at[starts]] = np.add.reduceat(value[order], starts)
        sums = sums.reshape(n1, n2).T
        total = np.stack([sum((sums[p] for p in choice[1:]), sums[choice[0]]) for choice in choices])
        out.append(mix(total ^ names)[total != 0])
    return np.concatenate(out).view(np.int64)


PARITY_BITS = 1024


def parity(s: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits as signed 64-bit numbers; each element flips one of them."""
    odd = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pd.DataFrame], words: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Sets of texts, about 4 MB of text at a time."""
    for b in batches:
        ends = b["text"].str.len().cumsum() // 4_000_000
        for _, part in b.groupby(ends):
            yield part, shingle_sets(part["text"].tolist(), words)


def keyed(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, key, parity): the size, a 64-bit key and the parity bits of each row's set."""

    def run(batches):
        for b, sets in _sets(batches, words):
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "n_shingles": [len(s) for s in sets], "key": [set_key(s) for s in sets], "parity": [parity(s) for s in sets]})

    # ids travel as text: pandas turns longs beside nulls into doubles
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id string, n_shingles long, key long, parity array<long>").withColumn("doc_id", F.col("doc_id").cast("long"))


def _placed(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    rows = only(docs, "doc_id", "text").where("doc_id is not null")
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), slot_of(F.col("doc_id"), 64 * len(bits)).alias("place"))


def _held(batches: Iterator[pd.DataFrame], bits: np.ndarray) -> Iterator[pd.DataFrame]:
    """The rows whose doc_id is in the bitmap, and a few others."""
    for b in batches:
        p = b["place"].to_numpy(np.int64)
        yield b[((bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)) == 1]


#: Bits of a signature that are counted, signatures that are sorted and sent at a time, and ranges of them for each task that counts.
COUNTED, SENT, RANGES = 40, 1 << 20, 4

#: Slots of a filter for each shared signature, of which it sets SET, and all slots at most.
SLOTS, SET, MOST_SLOTS = 12, 2, 1 << 28


def range_starts(ranges: int) -> np.ndarray:
    """The least counted bits of each range, and of one past the last."""
    return np.array([-(-(r << COUNTED) // ranges) for r in range(ranges + 1)], np.uint64)


def counted(sigs: np.ndarray) -> np.ndarray:
    return sigs.view(np.uint64) >> np.uint64(64 - COUNTED)


def slots_in(short: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """SET slots of filters of that size for each of the counted bits."""
    return [(mix(short + np.uint64((k + 1) << 48)) % size).astype(np.int64) for k in range(SET)]


def packed(short: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, low, high) of counted bits: sorted within a range, their last three bytes each, and what is before, which has long runs."""
    short = np.sort(short)
    cut = np.searchsorted(short, starts)
    for r in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        v = short[cut[r] : cut[r + 1]] - starts[r]
        yield r, v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes(), (v >> np.uint64(24)).astype("<u2").tobytes()


def unpacked(low: bytes, high: bytes) -> np.ndarray:
    v = np.zeros((len(high) // 2, 4), np.uint8)
    v[:, :3] = np.frombuffer(low, np.uint8).reshape(-1, 3)
    return v.view("<u4").ravel() | (np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(24))


def filter_of(short: np.ndarray, most: int) -> tuple[int, bytes]:
    """(slots, bits) of a filter of the counted bits that come more than once; it fills up but never misses one."""
    short = np.sort(short)
    twice = np.unique(short[1:][short[1:] == short[:-1]])
    size = min(most, -(-SLOTS * len(twice) // 64) * 64)
    bits = np.zeros(size, np.uint8)
    if size:
        for p in slots_in(twice, np.uint64(size)):
            bits[p] = 1
    return size, np.packbits(bits, bitorder="little").tobytes()


class Shared:
    """Which signatures come more than once, all of them and a few others: a filter for each range of them."""

    def __init__(self, ranges: int, found: list[tuple[int, int, bytes]]):
        self.starts = range_starts(ranges)
        self.sizes, self.at = np.zeros(ranges, np.uint64), np.zeros(ranges, np.int64)
        at, parts = 0, [b""]
        for r, size, bits in found:
            self.sizes[r], self.at[r] = size, at
            at += size
            parts.append(bytes(bits))
        self.bits = np.frombuffer(b"".join(parts), np.uint8)

    def holds(self, sigs: np.ndarray) -> np.ndarray:
        short = counted(sigs)
        r = np.searchsorted(self.starts, short, "right") - 1
        hit = np.flatnonzero(self.sizes[r])
        for k in range(SET):
            p = self.at[r[hit]] + slots_in(short[hit], self.sizes[r[hit]])[k]
            hit = hit[(self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
        return hit


def shared_signatures(docs: DataFrame, one: np.ndarray, words: int = WORDS) -> Shared:
    """Which signatures come more than once among the rows in the bitmap ``one``: only COUNTED bits of each are sent, in sorted blocks."""
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts, most = range_starts(ranges), MOST_SLOTS // ranges // 64 * 64

    def send(batches):
        waiting, n = [], 0
        for _, sets in _sets(_held(batches, one), words):
            for s in sets:
                waiting.append(counted(signatures(s)))
                n += len(waiting[-1])
                if n >= SENT:
                    yield pd.DataFrame(packed(np.concatenate(waiting), starts), columns=["range", "low", "high"])
                    waiting, n = [], 0
        if n:
            yield pd.DataFrame(packed(np.concatenate(waiting), starts), columns=["range", "low", "high"])

    def count(key, batch: pd.DataFrame) -> pd.DataFrame:
        size, bits = filter_of(np.concatenate([unpacked(*x) for x in zip(batch["low"], batch["high"])]) + starts[key[0]], most)
        return pd.DataFrame({"range": [key[0]], "slots": [size], "bits": [bits]})

    sent = _placed(docs, one).mapInPandas(send, "range int, low binary, high binary")
    found = sent.groupBy("range").applyInPandas(count, "range int, slots long, bits binary").where("slots > 0")
    return Shared(ranges, [tuple(r) for r in found.collect()])


def signed(docs: DataFrame, one: np.ndarray, shared: Shared, words: int = WORDS) -> DataFrame:
    """(sig, key) of the sets of the rows in the bitmap ``one``: the signatures that are shared, and a few others."""

    def run(batches):
        for _, sets in _sets(_held(batches, one), words):
            sigs = [signatures(s) for s in sets]
            keys = np.repeat(np.array([set_key(s) for s in sets], np.int64), [len(x) for x in sigs])
            sigs = np.concatenate([np.zeros(0, np.int64), *sigs])
            hit = shared.holds(sigs)
            yield pd.DataFrame({"sig": sigs[hit], "key": keys[hit]})

    return _placed(docs, one).mapInPandas(run, "sig long, key long")


def texts_of(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(key, text) of the rows whose doc_id and key are in ``wanted``, deflated: texts take a third of the bytes of their sets."""
    bits = bit_array(wanted, "doc_id")

    def run(batches):
        for b, sets in _sets(_held(batches, bits), words):
            yield pd.DataFrame({"key": [set_key(s) for s in sets], "text": [zlib.compress(t.encode("utf-8", "surrogatepass")) for t in b["text"]]})

    made = _placed(docs, bits).mapInPandas(run, "key long, text binary")
    return made.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


#: Pairs whose sets are made and held at once.
COMPARED = 256


def jaccard_links(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """The pairs (a, b) of keys whose texts' sets have DENOMINATOR * both >= NUMERATOR * either, by exact counts."""

    def run(batches):
        for batch in batches:
            for s in range(0, len(batch), COMPARED):
                rows = batch.iloc[s : s + COMPARED]
                text = dict(zip([*rows["a"], *rows["b"]], [*rows["x"], *rows["y"]]))
                sets = dict(zip(text, shingle_sets([zlib.decompress(t).decode("utf-8", "surrogatepass") for t in text.values()], words)))
                found = []
                for a, b in zip(rows["a"], rows["b"]):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if both * DENOMINATOR >= (len(sets[a]) + len(sets[b]) - both) * NUMERATOR:
                        found.append((a, b))
                yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    x = texts.select(F.col("key").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("key").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def similarity_classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Rows with equal sets are one node.

    Null, empty or blank text has no shingles and links with nothing; a null
    doc_id gets a null component and links with nothing; rows that share a
    doc_id share its component.  Columns other than doc_id and text are not
    read.  An empty table gives no rows.
    """
    named = only(docs, "doc_id", "text").where("doc_id is not null")
    every = settle(keyed(docs, words), "jaccard-keys")
    nodes = settle(every.where("n_shingles > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")), "jaccard-nodes")

    def prepare(keys: DataFrame) -> DataFrame:
        known = every.where("n_shingles > 0 and doc_id is not null").join(keys, "key", "left_semi").dropDuplicates(["key"])
        return settle(known.select("key", F.struct(F.col("n_shingles").alias("n"), "parity").alias("f")), "jaccard-light")

    def link(pairs: DataFrame, light: DataFrame) -> DataFrame:
        near = settle(near_pairs(pairs, light, NUMERATOR, DENOMINATOR), "jaccard-near")
        if near.isEmpty():
            return near
        keys = near.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        return jaccard_links(near, texts_of(named, settle(nodes.join(keys, "key"), "jaccard-wanted"), words), words)

    def light_of(light: DataFrame) -> DataFrame:
        return light

    def may(x: Column, y: Column) -> Column:
        return may_link(x, y, NUMERATOR, DENOMINATOR)

    # equal sets are signed once, but for a few; signatures that no other set has stay in their task
    one = bit_array(nodes, "doc_id")
    sigs = signed(named, one, shared_signatures(named, one, words), words)
    final = similarity_components(sigs, prepare, link, "jaccard", light_of, may, alike=True)
    # every row's node, every node's component, every component's smallest doc_id; rows that share an id share it
    noded = every.join(final.withColumnRenamed("id", "key"), "key", "left").withColumn(
        "c", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "key"))
    )
    low = noded.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return noded.join(low, "c", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
