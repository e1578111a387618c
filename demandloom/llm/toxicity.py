"""Toxicity by a subsequence string kernel with Nystroem landmarks and a linear support vector machine.

The kernel counts shared subsequences of letters, each gap letter costing a
factor, so a word with inserted or skipped letters stays close to its origin.
Landmarks are short strings that labelled toxic texts hold and others don't.
A text's feature for a landmark is the best kernel value among its words.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import only

#: Letters of a subsequence, cost of a letter of gap, kernel values that count as none.
ORDER, DECAY, DULL = 4, 0.7, 0.3
#: Landmarks; lengths of landmark strings; rows of each label that the machine is fitted on, at most.
LANDMARKS, SHORTEST, LONGEST, SAMPLE = 48, 5, 9, 4000
#: Stands before the first letter of a word.
BEGIN = "^"
#: A longer word is looked at through windows of this many letters, half overlapping.
WINDOW = 24
#: Words whose kernel values are computed at a time: their arrays should fit a core's cache.
TOGETHER = 256
KEPT_WORDS = 300_000
#: Rows whose texts are held beside their batch.
ROWS = 1024
THRESHOLD = 0.3

PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¡¿"


def fold_of(doc_id: Column, n: int = 4) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def tokens_of(text: str) -> list[str]:
    return text.lower().split()


def word_of(token: str) -> str:
    return token.strip(PUNCTUATION)


def spelled(tokens: list[str], letters: set[str]) -> set[str]:
    """Words written as three or more single letters in a row; ``letters``: the tokens that are one letter each."""
    out, run = set(), []
    for t in [*tokens, ""]:
        if t in letters:
            run.append(word_of(t))
        elif run:
            if len(run) > 2:
                out.add("".join(run))
            run = []
    return out


def words_of(text: str) -> set[str]:
    """Distinct lower-case words without edge punctuation; runs of three or more single letters also count as one word."""
    tokens = tokens_of(text)
    words = {t: word_of(t) for t in set(tokens)}
    letters = {t for t, w in words.items() if len(w) == 1}
    return {w for w in words.values() if len(w) > 1} | (spelled(tokens, letters) if letters else set())


def windows_of(word: str) -> list[str]:
    """A word with its begin mark, in windows."""
    word = BEGIN + word
    if len(word) <= WINDOW:
        return [word]
    step = WINDOW // 2
    return [word[s : s + WINDOW] for s in range(0, len(word) - step, step)]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Subsequence kernel of each word with each landmark.

    A cell is computed only where letters enough stand before and after it, and
    only for landmarks that reach so far; the others are zero or are not used.
    """
    n, longest = max(map(len, words)), max(map(len, landmarks))
    order = sorted(range(len(landmarks)), key=lambda k: -len(landmarks[k]))
    reach = [sum(len(x) > j for x in landmarks) for j in range(longest)]
    # what fills up words and landmarks is like nothing
    s = np.array([list(map(ord, w.ljust(n, "\1"))) for w in words], np.int32).T
    t = np.array([list(map(ord, landmarks[k].ljust(longest, "\0"))) for k in order], np.int32).T
    square = np.float32(DECAY**2)
    same = [[(t[j, : reach[j], None] == s[i]) * square for j in range(longest)] for i in range(n)]
    total = np.zeros((len(landmarks), len(words)), np.float32)
    # before[i][j]: subsequences of p - 1 letters within the first i and j letters; None is zero
    before: list[list[np.ndarray | None]] = []
    for p in range(1, ORDER):
        rows: list[list[np.ndarray | None]] = [[None] * (longest + 1)]
        for i in range(n - ORDER + p):
            along, row = None, [None]
            for j in range(longest - ORDER + p):
                if i >= p - 1 and j >= p - 1:
                    now = same[i][j] if p == 1 else same[i][j] * before[i][j][: reach[j]]
                    along = now if along is None else along[: reach[j]] * np.float32(DECAY) + now
                above = rows[i][j + 1]
                row.append(along if above is None else above * np.float32(DECAY) + along)
            rows.append(row)
        before = rows
    for i in range(ORDER - 1, n):
        for j in range(ORDER - 1, longest):
            total[: reach[j]] += same[i][j] * before[i][j][: reach[j]]
    out = np.empty((len(words), len(landmarks)), np.float32)
    out[:, order] = total.T
    return out


def closeness(words: list[str], landmarks: list[str], own: np.ndarray) -> np.ndarray:
    """Kernel values as a share of the landmark's own, at most 1; values under DULL are 0."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    parts = [(k, w) for k, word in enumerate(words) for w in windows_of(word)]
    # words of about one length together, as the longest decides how many cells there are
    parts = sorted((p for p in parts if len(p[1]) >= ORDER), key=lambda p: len(p[1]))
    for s in range(0, len(parts), TOGETHER):
        some = parts[s : s + TOGETHER]
        np.maximum.at(out, [k for k, _ in some], kernel([w for _, w in some], landmarks) / own)
    out = np.minimum(out, 1)
    out[out < DULL] = 0
    return out


class Pooler:
    """Best closeness of a text's words to each landmark; remembers words it has seen."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.own = np.array([kernel([x], [x])[0, 0] for x in landmarks], np.float32)
        self.near: dict[str, np.ndarray] = {}
        self.dull: set[str] = set()
        #: Tokens that are no single letters and whose word is dull or empty.
        self.skipped: set[str] = set()

    def pool(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.landmarks)), np.float32)
        bags, seen = [], {}
        for text in texts:
            tokens = tokens_of(text)
            bag, letters = set(), set()
            for t in set(tokens) - self.skipped:
                if t not in seen:
                    seen[t] = word_of(t)
                if len(seen[t]) == 1:
                    letters.add(t)
                else:
                    bag.add(seen[t])
            bags.append(bag | spelled(tokens, letters) if letters else bag)
        new = list(set().union(*bags) - self.dull - self.near.keys() - {""})
        for s in range(0, len(new), 8192):
            some = new[s : s + 8192]
            values = closeness(some, self.landmarks, self.own)
            hit = values.any(1)
            self.near.update((some[k], values[k].copy()) for k in np.flatnonzero(hit))
            self.dull.update(some[k] for k in np.flatnonzero(~hit))
        for k, bag in enumerate(bags):
            for w in self.near.keys() & bag:
                np.maximum(out[k], self.near[w], out=out[k])
        self.skipped.update(t for t, w in seen.items() if len(w) != 1 and (not w or w in self.dull))
        if len(self.dull) + len(self.near) > KEPT_WORDS or len(self.skipped) > KEPT_WORDS:
            self.dull.clear()
            self.near.clear()
            self.skipped.clear()
        return out


_poolers: dict[tuple[str, ...], Pooler] = {}


def pooler(landmarks: tuple[str, ...]) -> Pooler:
    """The worker's pooler for these landmarks; another set replaces it."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    if landmarks not in _poolers:
        _poolers.clear()
        _poolers[landmarks] = Pooler(list(landmarks))
    return _poolers[landmarks]


def chunks(batch: pd.DataFrame, chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Parts of a batch of about so many characters."""
    yield from (part for _, part in batch.groupby(batch["text"].str.len().cumsum() // chars))


@dataclass
class Machine:
    """Landmarks, their whitening, and the calibrated hyperplane."""

    landmarks: list[str]
    white: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, pooled: np.ndarray) -> np.ndarray:
        margin = pooled @ self.white @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def choose_landmarks(sample: DataFrame, n: int = LANDMARKS) -> list[str]:
    """Strings of SHORTEST to LONGEST letters that toxic texts of the sample hold most beyond the usual, no two alike."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)))
    each = sample.select("toxic", F.explode(words).alias("w")).groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    each = each.withColumn("w", F.concat(F.lit(BEGIN), "w"))
    starts = F.sequence(F.lit(1), F.length("w") - SHORTEST + 1)
    grams = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("w") - i + 1)), lambda k: F.substr("w", i, k))))
    counted = (
        each.where(F.length("w").between(SHORTEST, 64)).select(F.explode(F.array_distinct(grams)).alias("g"), "t", "c")
        .groupBy("g").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where("t >= 2")
    )
    words_in = each.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    usual = (F.col("c") + 0.5) * (words_in["t"] or 0) / max(1, words_in["c"] or 0)
    gain = F.when(F.col("t") > 3 * usual, F.col("t") * F.log(F.col("t") / usual) - F.col("t") + usual).otherwise(0.0)
    best = counted.withColumn("gain", gain).orderBy(F.desc("gain"), F.desc(F.length("g")), "g").limit(60 * n).collect()
    chosen: list[str] = []
    seen: set[str] = set()
    for r in best:
        parts = {r["g"][k : k + ORDER] for k in range(len(r["g"]) - ORDER + 1)}
        if r["gain"] > 0 and not parts & seen:
            chosen.append(r["g"])
            seen |= parts
        if len(chosen) == n:
            break
    return chosen


def pooled(docs: DataFrame, landmarks: list[str], keep: str) -> DataFrame:
    """(keep, x): a column of ``docs`` and the pooled features of its text."""
    marks = tuple(landmarks)

    def run(batches):
        own = pooler(marks)
        for b in batches:
            for part in chunks(b):
                yield pd.DataFrame({keep: part[keep].array, "x": list(own.pool(part["text"].tolist()))})

    return docs.select(keep, "text").mapInPandas(run, f"{keep} int, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """The machine fitted on at most ``sample`` labelled rows of each label, the first by hash of their id.

    Rows with null labels, ids or texts don't count; of several labels for an
    id the highest holds.  None without rows of both labels or landmarks.
    """
    known = only(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    train = known.where(fold_of(F.col("doc_id")) != 2)
    order = F.xxhash64("doc_id")
    some = train.where("toxic = 1").orderBy(order).limit(sample).unionByName(train.where("toxic = 0").orderBy(order).limit(sample))
    # at most 2 x sample rows of two numbers each
    rows = only(docs, "doc_id", "text").where("text is not null").join(F.broadcast(some), "doc_id").select("text", "toxic")
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).repartition(12).persist()
    try:
        n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        if len(n) < 2:
            return None
        landmarks = choose_landmarks(rows)
        if not landmarks:
            return None
        data = pooled(rows, landmarks, "toxic").collect()
    finally:
        rows.unpersist()
    x, y = np.array([r["x"] for r in data], float), np.array([r["toxic"] for r in data]) * 2.0 - 1
    own = Pooler(landmarks)
    k = kernel_matrix(landmarks, own.own)
    value, vector = np.linalg.eigh(k)
    white = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    z = np.hstack([x @ white, np.ones((len(x), 1))])
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    w = squared_hinge(z, y, cost)
    slope, offset = platt(z @ w, y)
    return Machine(landmarks, white, w[:-1], float(w[-1]), slope, offset)


def kernel_matrix(landmarks: list[str], own: np.ndarray) -> np.ndarray:
    k = np.array([kernel([a], landmarks)[0] for a in landmarks], float)
    return k / np.sqrt(np.outer(own, own))


def squared_hinge(z: np.ndarray, y: np.ndarray, cost: np.ndarray, reg: float = 1.0) -> np.ndarray:
    """Primal Newton steps for the linear machine with squared hinge loss."""
    w = np.zeros(z.shape[1])
    ridge = reg * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        on = y * (z @ w) < 1
        c = cost[on]
        new = np.linalg.solve(ridge + (z[on] * c[:, None]).T @ z[on], (z[on] * c[:, None]).T @ y[on])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic calibration of margins, with slightly softened targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design = np.stack([margin, np.ones_like(margin)], 1)
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, design.T @ (t - p) - 1e-3 * a)
        a = a + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def scored(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score) of every row of documents; without a machine every score is 0."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if machine is None:
        return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("score"))
    marks = tuple(machine.landmarks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pooler(marks)
        for b in batches:
            for part in chunks(b):
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "score": machine.score(own.pool(part["text"].tolist()))})

    return rows.mapInPandas(run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of documents.

    Only labels whose fold isn't 2 are learnt from.  Null text scores as the
    empty text; rows that repeat each get a row; a null doc_id stays null and
    isn't held out.  Further columns, labels, language and source are no
    inputs of a score.  Without labels of both kinds every score is 0.
    """
    out = scored(docs, fit(docs, labels, sample))
    return out.select(
        "doc_id", (fold_of(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, machine: Machine | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores at least ``threshold``; all columns stay as they are.

    Null text scores as the empty text; without a machine every row stays.
    """
    if machine is None:
        return docs
    marks, place = tuple(machine.landmarks), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pooler(marks)
        for batch in batches:
            for b in (batch.slice(s, ROWS) for s in range(0, batch.num_rows, ROWS)):
                texts = pd.DataFrame({"text": [t or "" for t in b.column(place).to_pylist()]})
                low = [machine.score(own.pool(part["text"].tolist())) < threshold for part in chunks(texts)]
                yield b.filter(pa.array(np.concatenate(low)))

    return docs.mapInArrow(run, docs.schema)
