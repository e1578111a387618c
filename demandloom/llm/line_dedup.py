"""Fuzzy line deduplication by MinHash.

A line's signature is its smallest character-shingle hashes in order; its
bands are all pairs of consecutive ones.  Lines that share a band are
candidates, exact Jaccard over all shingles decides, and one line of each
component stays: the first by document and place.

Shingles of whole batches are hashed and sorted in numpy inside tasks; joins,
components and the choice of lines are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import NO_ID, may_link, only, similarity_components
from demandloom.llm.jaccard_join import parity
from demandloom.llm.shingles import mix
from demandloom.sources.io import settle

#: Characters of a shingle; shorter lines are repeated only by equal ones.
LENGTH = 12
NUMERATOR, DENOMINATOR = 80, 100
#: Consecutive minima of a band, and bands of a line: at likeness 0.8 all but about 1 in 2,000 pairs share two
#: consecutive ones of their 11 minima, above it nearly all.
RUN, BANDS = 2, 10

#: Leaders that the lines of a band are compared with at once, and rounds of new leaders at most, before pairs are made.
LEADERS, ROUNDS = 2, 2

#: Characters that a task hashes at a time.
CHUNK = 1 << 21

#: Bits of a bitmap that stands for the wanted keys; it may let others through, but never misses one.
BITS = 1 << 24

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> list[np.uint64]:
    out = [np.uint64(1)]
    with np.errstate(over="ignore"):
        for _ in range(n):
            out.append(out[-1] * _BASE)
    return out


_POWER = _powers(LENGTH)


def window_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every window of LENGTH characters, by doubling."""
    h1 = codes.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _POWER[1] + h1[1:]
    h4 = h2[:-2] * _POWER[2] + h2[2:]
    h8 = h4[:-4] * _POWER[4] + h4[4:]
    return mix(h8[:-4] * _POWER[4] + h4[8:])


def line_key(line: str) -> int:
    """A signed 64-bit key of a line; equal lines have equal keys."""
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of all shingles of all lines, in order."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # a window is none if it holds the end of a line
    ends = np.cumsum(sizes + 1) - 1
    change = np.zeros(len(codes) + 1, np.int32)
    np.add.at(change, np.maximum(ends - (LENGTH - 1), 0), 1)
    np.add.at(change, ends + 1, -1)
    inside = np.cumsum(change[: len(codes) - LENGTH + 1], dtype=np.int32) == 0
    line = np.repeat(np.arange(len(lines), dtype=np.uint64), np.maximum(sizes - (LENGTH - 1), 0))
    return line, window_hashes(codes)[inside]


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def bands(lines: list[str]) -> list[np.ndarray]:
    """The band keys of each line: a hash of every two consecutive ones of its smallest shingle hashes; one shingle is a band."""
    line, hashes = shingles(lines)
    # one sort for all lines: the line's number, then 40 bits of the hash
    low = distinct((line << np.uint64(40)) | (hashes >> np.uint64(24)))
    owner = (low >> np.uint64(40)).astype(np.int64)
    begin = np.searchsorted(owner, np.arange(len(lines) + 1))
    rank = np.arange(len(low)) - begin[owner]
    value = low & np.uint64((1 << 40) - 1)
    single = np.diff(begin)[owner] == 1
    nxt = np.roll(owner, -1) == owner if len(owner) else np.zeros(0, bool)
    if len(nxt):
        nxt[-1] = False
    at = np.flatnonzero(single | (nxt & (rank < BANDS)))
    after = np.where(single[at], np.uint64(0), value[np.minimum(at + 1, len(value) - 1)]) if len(at) else np.zeros(0, np.uint64)
    sigs = mix(value[at] * _BASE + mix(after)).view(np.int64)
    return np.split(sigs, np.searchsorted(owner[at], np.arange(1, len(lines)))) if lines else []


def written(line: str) -> bool:
    return bool(line) and not line.isspace()


def _chunks(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, str]]]:
    """(doc, line number, line) of all lines with anything written in them, about CHUNK characters at a time."""
    out, size = [], 0
    for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
        for i, line in enumerate((text.as_py() or "").split("\n")):
            if written(line):
                out.append((doc, i, line))
                size += len(line)
            if size > CHUNK:
                yield out
                out, size = [], 0
    if out:
        yield out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")


def places(docs: DataFrame) -> DataFrame:
    """(doc, line_no, key, sigs) of all lines; a task signs equal lines once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows in _chunks(batch):
                keys = [line_key(x) for _, _, x in rows]
                new = {}
                for k, (_, _, x) in zip(keys, rows):
                    if k not in seen and len(x) >= LENGTH:
                        seen.add(k)
                        new[k] = x
                signed = dict(zip(new, bands(list(new.values()))))
                sigs = [signed.pop(k, []) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _, _ in rows], pa.int64()), pa.array([i for _, i, _ in rows], pa.int32()),
                        pa.array(keys, pa.int64()), pa.array(sigs, pa.list_(pa.int64())),
                    ],
                    ["doc", "line_no", "key", "sigs"],
                )

    return _texts(docs).mapInArrow(run, "doc long, line_no int, key long, sigs array<bigint>")


def wanted_bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of BITS bits of keys, made by partial aggregates."""
    slot = F.col("key").bitwiseAND(F.lit(BITS - 1))
    words = keys.select(slot.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    out = np.zeros(BITS // 64, np.uint64)
    for w, b in words.collect():
        out[w] = np.uint64(b & 0xFFFFFFFFFFFFFFFF)
    return out


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, n, parity, line) of the wanted lines: texts are read again, and a task sends a line once."""
    bits = wanted_bits(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows in _chunks(batch):
                found = {}
                for _, _, x in rows:
                    k = line_key(x)
                    p = k & (BITS - 1)
                    if len(x) >= LENGTH and k not in seen and (int(bits[p >> 6]) >> (p & 63)) & 1:
                        seen.add(k)
                        found[k] = x
                line, hashes = shingles(list(found.values()))
                cut = np.searchsorted(line, np.arange(1, len(found), dtype=np.uint64))
                sets = [distinct(h) for h in np.split(hashes, cut)] if found else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found), pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([parity(s) for s in sets], pa.list_(pa.int64())), pa.array(list(found.values()), pa.string()),
                    ],
                    ["key", "n", "parity", "line"],
                )

    made = _texts(docs).mapInArrow(run, "key long, n int, parity array<bigint>, line string")
    return made.join(keys, "key", "left_semi").dropDuplicates(["key"])


def _like(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, x, y) whose shingle sets are like enough, by exact counts."""
    kept: dict[int, set[str]] = {}
    size = 0

    def cut(key: int, line: str) -> set[str]:
        nonlocal size
        if key not in kept:
            if size > CHUNK // 4:
                kept.clear()
                size = 0
            kept[key] = {line[i : i + LENGTH] for i in range(len(line) - LENGTH + 1)}
            size += len(kept[key])
        return kept[key]

    for batch in batches:
        out = []
        for a, b, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "x", "y")]):
            p = cut(a, x)
            q = cut(b, y)
            both = len(p & q)
            if both * DENOMINATOR >= (len(p) + len(q) - both) * NUMERATOR:
                out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])


def line_components(docs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(id, component) of line keys that are like another line."""

    def prepare(keys: DataFrame) -> DataFrame:
        return settle(texts_of(docs, keys), "line-texts")

    def light(texts: DataFrame) -> DataFrame:
        return texts.select("key", F.struct("n", "parity").alias("f"))

    def may(x: Column, y: Column) -> Column:
        return may_link(x, y, NUMERATOR, DENOMINATOR)

    def link(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        x = texts.select(F.col("key").alias("a"), F.struct("n", "parity").alias("fa"), F.col("line").alias("x"))
        y = texts.select(F.col("key").alias("b"), F.struct("n", "parity").alias("fb"), F.col("line").alias("y"))
        near = pairs.join(x.drop("x"), "a").join(y.drop("y"), "b").where(may(F.col("fa"), F.col("fb"))).select("a", "b")
        return near.join(x.drop("fa"), "a").join(y.drop("fb"), "b").select("a", "b", "x", "y").mapInArrow(_like, "a long, b long")

    return similarity_components(sigs, prepare, link, "lines", light, may, LEADERS, ROUNDS)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc, drop): line numbers of each document that repeat an earlier line, exactly or nearly."""
    at = settle(places(docs), "line-places")
    label = line_components(docs, at.select(F.explode("sigs").alias("sig"), "key"))
    # one row for each key first, so that a frequent line is never joined row by row
    by_doc = at.groupBy("key", "doc").agg(F.min("line_no").alias("line_no"))
    by_key = by_doc.groupBy("key").agg(F.min_by("line_no", "doc").alias("line_no"), F.min("doc").alias("doc"))
    named = by_key.join(label.withColumnRenamed("id", "key"), "key", "left").withColumn("c", F.coalesce("component", "key"))
    firsts = named.groupBy("c").agg(F.min(F.struct("doc", "line_no")).alias("first")).select("first.doc", "first.line_no")
    drop = at.select("doc", "line_no").join(firsts, ["doc", "line_no"], "left_anti")
    return drop.groupBy("doc").agg(F.collect_set("line_no").alias("drop"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` freed of repeated lines, ``n_lines`` and ``n_kept``; all rows and other columns stay.

    The first line of a component stays, by doc_id (null before all), then by
    place.  Lines with nothing but white space stay; lines under LENGTH
    characters are repeated by equal ones only.  Null text stays null with no
    lines.  Very long texts and lines are hashed whole, in chunks of lines.
    Rows that share a doc_id are one document here: a line that is first in one
    of them, at that place, stays in each.  Columns n_lines and n_kept are
    replaced; columns of any other name stay.  An empty table gives no rows.
    """
    rest = [c for c in docs.columns if c not in ("n_lines", "n_kept")]
    gone = dropped_lines(only(docs, "doc_id", "text"))
    # names are given by place, so that no column of the table can clash
    rows = docs.select(F.coalesce(F.col("`doc_id`"), F.lit(NO_ID)).alias("doc"), F.col("`text`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    joined = rows.join(gone, "doc", "left")
    lines = F.split(F.col("text"), "\n")
    left = F.filter(lines, lambda x, i: ~F.array_contains("drop", i))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    kept = F.when(F.col("drop").isNull() | F.col("text").isNull(), n).otherwise(F.size(left))
    made = joined.select("row", text.alias("t"), n.alias("n_lines"), kept.alias("n_kept"))
    return made.select(*[(F.col("t").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)) for c in rest], "n_lines", "n_kept")
