"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class, times that of its slot within the
class, both given hashed n-gram and skip features of the words before, times
its share of its slot.  Frequent words have a slot of their own; the others of
a class share some, in proportion to counts over all training documents.  The
weights are trained on all of them by rounds of gradient steps in every task
and averaging across tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import only
from demandloom.llm.shingles import hashed_words, mix
from demandloom.llm.toxicity import chunks, fold_of
from demandloom.sources.io import settle

#: Classes: the most frequent words have one each, the others share one by their ending.
SINGLES, CLASSES = 12, 32
#: Slots of a shared class: its most frequent words have one each, the others share one by their hash.
OWN, SLOTS = 24, 32
#: Tokens of a gradient step, rounds, step size.
STEP, ROUNDS, RATE = 8192, 2, 0.15
#: Most frequent words whose counts are kept in every task; the others' are joined.
KEPT = 1 << 18
#: Distinct words that a task remembers; a full table starts anew.
LEXICON = 1 << 18
#: Rows of the weight table that are averaged together; rows of class features are rounded up to such a number.
BLOCK, ALIGN = 1024, 64
#: Training tokens of a task at least: each ships the whole weight table, so small partitions are read together.
TASK_TOKENS = 2_000_000

BEGIN, END = 0, 1
#: Rows of the weight table: features of classes only have rows of their own, those of words are hashed.
STATES = CLASSES + 1
PAIRS = 3 * STATES
INSIDE = PAIRS + STATES * STATES
PLAIN = -(-(INSIDE + CLASSES * STATES) // ALIGN) * ALIGN
ROWS = 1 << 16


def split(texts: list[str]) -> list[list[bytes]]:
    """A-Z lower-cased words of each text; bytes know ASCII letters and white space only."""
    return [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]


def hashes_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and endings of some words."""
    ids, _, endings = hashed_words([b" ".join(words).decode("utf-8", "surrogatepass")])
    return ids.view(np.int64), (endings % np.uint64(CLASSES - SINGLES)).astype(np.int32)


@dataclass
class Tokens:
    """Tokens of some texts in order: number in the lexicon, place in the text, and each text's number of tokens."""

    at: np.ndarray
    place: np.ndarray
    counts: np.ndarray


class Lexicon:
    """Numbers distinct words and describes each once; word 0 is the end, word 1 what stands before a text."""

    def __init__(self, describe: Callable[[np.ndarray, np.ndarray], pd.DataFrame]):
        self.describe = describe
        self._start()

    def _start(self) -> None:
        # no word holds white space
        self.known = {b"\n": 0, b" ": 1}
        self.words = self.describe(np.array([END, BEGIN], np.int64), np.zeros(2, np.int32))

    def tokens(self, texts: list[str]) -> Tokens:
        words = split(texts)
        flat = list(chain.from_iterable(words))
        distinct = set(flat)
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > LEXICON:
            self._start()
            new = list(distinct)
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.words = pd.concat([self.words, self.describe(*hashes_of(new))], ignore_index=True)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        counts = sizes + 1
        place = np.arange(len(at) + len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
        return Tokens(np.insert(at, np.cumsum(sizes), 0), place, counts)

    def of(self, column: str, t: Tokens) -> np.ndarray:
        return self.words[column].to_numpy()[t.at]


def before(x: np.ndarray, place: np.ndarray, n: int, start: int) -> np.ndarray:
    """What stands n tokens earlier in the same text."""
    out = np.full(len(x), start, x.dtype)
    out[n:] = x[:-n] if len(x) > n else out[n:]
    out[place < n] = start
    return out


def hashed_rows(keys: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """Rows of features that name a word."""
    salt = np.uint64(0x9E3779B97F4A7C15) * np.asarray(salt).astype(np.uint64)
    return (PLAIN + (mix(keys.view(np.uint64) ^ salt) >> np.uint64(20)) % np.uint64(ROWS - PLAIN)).astype(np.int64)


def features_of(ids: np.ndarray, classes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table that a token's class, and its slot within the class, depend on.

    Class: the word before, the classes one, two and three before, and the
    first two of them together.  Slot: within the class, the word before, the
    word before that, and the class before.
    """
    word, skip = before(ids, place, 1, BEGIN), before(ids, place, 2, BEGIN)
    one, two, three = (before(classes, place, n, -1) + 1 for n in (1, 2, 3))
    outer = [hashed_rows(word, 1), one, STATES + two, 2 * STATES + three, PAIRS + one * STATES + two]
    inner = [hashed_rows(word, 2 + classes), hashed_rows(skip, 2 + CLASSES + classes), INSIDE + classes * STATES + one]
    return np.stack(outer), np.stack(inner)


def context_table(weights: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """For every two classes before: the sum of the rows that depend on nothing else, and the prior."""
    one, two = np.divmod(np.arange(STATES * STATES), STATES)
    return weights[one] + weights[STATES + two] + weights[PAIRS : PAIRS + STATES * STATES] + prior


def class_sums(weights: np.ndarray, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums over the five class features; those of the two classes before come from ``table``."""
    x = table.take(rows[4] - PAIRS, 0)
    x += weights.take(rows[0], 0)
    x += weights.take(rows[3], 0)
    return x


def slot_sums(weights: np.ndarray, rows: np.ndarray, prior: np.ndarray) -> np.ndarray:
    x = weights.take(rows[0], 0)
    x += prior
    for r in rows[1:]:
        x += weights.take(r, 0)
    return x


def softmax(x: np.ndarray) -> np.ndarray:
    """Chances of every class or slot from sums, in place."""
    # the largest of a row by halves, as there are few columns
    top = x
    while top.shape[1] > 1:
        half = top.shape[1] // 2
        top = np.maximum(top[:, :half], top[:, half:])
    x -= top
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], np.float32))[:, None]
    return x


def step(weights: np.ndarray, squares: np.ndarray, hit: np.ndarray, g: np.ndarray, times: np.ndarray) -> None:
    """One adaptive step of the rows ``hit`` by summed slopes ``g`` of ``times`` tokens each."""
    g = g / np.sqrt(times.astype(np.float32))[:, None]
    total = squares.take(hit, 0) + g * g
    squares[hit] = total
    weights[hit] -= np.float32(RATE) * g / np.sqrt(total + np.float32(1e-2))


def by_row(slope: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, summed slopes, tokens) of the rows that tokens have."""
    # row numbers fit 16 bits, which are sorted by radix
    order = np.argsort(r.astype(np.uint16), kind="stable")
    at = r.take(order)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return at[starts], np.add.reduceat(slope.take(order, 0), starts), np.diff(np.append(starts, len(at)))


def descend_slots(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, prior: np.ndarray, wanted: np.ndarray) -> None:
    """One step on some tokens' slots, in place; only the rows they touch change."""
    slope = softmax(slot_sums(weights, rows, prior))
    slope[np.arange(len(wanted)), wanted] -= 1
    for r in rows:
        step(weights, squares, *by_row(slope, r))


def descend_classes(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, prior: np.ndarray, wanted: np.ndarray) -> None:
    """One step on some tokens' classes; slopes of the class one or two before are added up from those of both."""
    slope = softmax(class_sums(weights, rows, context_table(weights, prior)))
    slope[np.arange(len(wanted)), wanted] -= 1
    pair, g, times = by_row(slope, rows[4])
    one, two = np.divmod(pair - PAIRS, STATES)
    for first, state in ((0, one), (STATES, two)):
        order = np.argsort(state, kind="stable")
        at = state[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        step(weights, squares, first + at[starts], np.add.reduceat(g[order], starts), np.add.reduceat(times[order], starts))
    step(weights, squares, pair, g, times)
    for r in (rows[0], rows[3]):
        step(weights, squares, *by_row(slope, r))


def log_chances(m: Model, ids: np.ndarray, classes: np.ndarray, slots: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log10 of the chance of each token's class times that of its slot."""
    outer, inner = features_of(ids, classes, place)
    out, table = np.empty(len(ids)), context_table(m.weights, m.class_prior)
    for s in range(0, len(ids), STEP):
        c, w = classes[s : s + STEP], slots[s : s + STEP]
        p = softmax(class_sums(m.weights, outer[:, s : s + STEP], table))[np.arange(len(c)), c].astype(float)
        shared = np.flatnonzero(c >= SINGLES)
        if len(shared):
            q = softmax(slot_sums(m.weights, inner[:, s + shared], m.slot_prior[c[shared]]))
            p[shared] *= np.maximum(q[np.arange(len(shared)), w[shared]], 1e-37)
        # beyond single precision a chance counts as its smallest number
        out[s : s + STEP] = np.log10(np.maximum(p, 1e-75))
    return out


def training(docs: DataFrame) -> DataFrame:
    return docs.where(fold_of(F.col("doc_id"), 7) != 2)


def texts_of(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))


def token_counts(docs: DataFrame) -> DataFrame:
    """(id, n, ending) of every distinct token of ``docs``; words are added up within tasks first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in chunks(b, 3_000_000):
                found = Counter(chain.from_iterable(split(part["text"].tolist())))
                ids, endings = hashes_of(list(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                yield pd.DataFrame({"id": np.append(ids, END), "n": np.append(n, len(part)), "ending": np.append(endings, 0).astype(np.int32)})

    return docs.select("text").mapInPandas(run, "id long, n long, ending int").groupBy("id").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


@dataclass
class Model:
    """What scoring needs; every part has a fixed largest size."""

    total: int
    distinct: int
    singles: np.ndarray
    #: Ids, counts and slots of the most frequent words, by id.
    kept: np.ndarray
    kept_n: np.ndarray
    kept_slot: np.ndarray
    #: Counts of all words of a slot, one added for each; logarithms of shares.
    slot_size: np.ndarray
    class_prior: np.ndarray
    slot_prior: np.ndarray
    weights: np.ndarray

    def describe(self, ids: np.ndarray, endings: np.ndarray) -> pd.DataFrame:
        """Class, slot and count of words; the count is 0 where it isn't kept."""
        single = np.minimum(np.searchsorted(self.singles, ids), len(self.singles) - 1)
        classes = np.where(self.singles[single] == ids, single, SINGLES + endings)
        slots, n = OWN + np.mod(ids, SLOTS - OWN), np.zeros(len(ids), np.int64)
        if len(self.kept):
            at = np.minimum(np.searchsorted(self.kept, ids), len(self.kept) - 1)
            known = self.kept[at] == ids
            n[known] = self.kept_n[at[known]]
            slots[known] = self.kept_slot[at[known]]
        return pd.DataFrame({"id": ids, "class": classes, "slot": slots, "n": n})


def statistics(counts: DataFrame) -> Model:
    """Totals, kept counts, slots and their sizes, from counts over all training tokens."""
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    often = counts.orderBy(F.desc("n"), "id").limit(KEPT).toPandas().astype(np.int64)
    singles = np.sort(often["id"].to_numpy()[:SINGLES]) if len(often) else np.array([END], np.int64)
    size = np.zeros((CLASSES, SLOTS))
    size[SINGLES:, OWN:] = 1
    shared = often[~often["id"].isin(singles)]
    tail = OWN + np.mod(often["id"].to_numpy(), SLOTS - OWN)
    often["slot"] = tail
    # the frequent words come first, so their rank within a class is its slot
    rank = shared.groupby("ending").cumcount()
    own = rank.index[rank < OWN]
    often.loc[own, "slot"] = rank[own]
    others = counts.where(~F.col("id").isin([int(x) for x in singles]))
    others = others.groupBy("ending", F.pmod("id", F.lit(SLOTS - OWN)).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r in others.collect():
        size[SINGLES + r["ending"], OWN + r["tail"]] += r["n"] + r["v"]
    for i in own:
        c, times = SINGLES + often.at[i, "ending"], often.at[i, "n"] + 1
        size[c, tail[i]] -= times
        size[c, often.at[i, "slot"]] = times
    alone = often[often["id"].isin(singles)]
    size[np.searchsorted(singles, alone["id"].to_numpy()), 0] = alone["n"].to_numpy() + 1
    by_class = size.sum(1)
    class_prior = np.log(np.maximum(by_class, 1e-6) / by_class.sum())
    slot_prior = np.log(np.maximum(size, 1e-6) / np.maximum(by_class, 1e-6)[:, None])
    often = often.sort_values("id")
    return Model(
        n["n"], n["v"], singles, often["id"].to_numpy(), often["n"].to_numpy(), often["slot"].to_numpy(), size,
        class_prior.astype(np.float32), slot_prior.astype(np.float32), np.zeros((ROWS, CLASSES), np.float32),
    )


def learn(m: Model, lexicon: Lexicon, texts: list[str], weights: np.ndarray, squares: np.ndarray) -> int:
    """Steps over all tokens of some texts, in place; returns how many they are."""
    t = lexicon.tokens(texts)
    classes, slots = lexicon.of("class", t), lexicon.of("slot", t)
    outer, inner = features_of(lexicon.of("id", t), classes, t.place)
    for s in range(0, len(classes), STEP):
        c = classes[s : s + STEP]
        descend_classes(weights, squares, outer[:, s : s + STEP], m.class_prior, c)
        inside = np.flatnonzero(c >= SINGLES)
        if len(inside):
            descend_slots(weights, squares, inner[:, s + inside], m.slot_prior[c[inside]], slots[s + inside])
    return len(classes)


def train_round(docs: DataFrame, model: Model) -> np.ndarray:
    """Weights after one pass: each task descends from the model's, and the results are averaged by tokens."""
    start = model.weights
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        lexicon = Lexicon(m.describe)
        weights, squares, seen = m.weights.copy(), np.zeros_like(m.weights), 0
        for b in batches:
            for part in chunks(b, 1_000_000):
                seen += learn(m, lexicon, part["text"].tolist(), weights, squares)
        if seen:
            parts = (weights * np.float32(seen)).reshape(-1, BLOCK * CLASSES)
            salt = TaskContext.get().partitionId() % 64
            yield pd.DataFrame({"block": np.arange(len(parts), dtype=np.int32), "salt": salt, "n": float(seen), "w": [p.tobytes() for p in parts]})

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(w, np.float32).astype(np.float64) for w in batch["w"]], axis=0)
        return pd.DataFrame({"block": batch["block"].iloc[:1], "n": [batch["n"].sum()], "w": [total.astype(np.float32).tobytes()]})

    def added(key, batch: pd.DataFrame) -> pd.DataFrame:
        return add(batch)

    made = docs.select("text").mapInPandas(run, "block int, salt int, n double, w binary")
    shape = "block int, n double, w binary"
    # tasks are added up by salt first, so no group grows with their number
    done = made.groupBy("block", "salt").applyInPandas(added, shape).groupBy("block").applyInPandas(added, shape)
    out = start.reshape(-1, BLOCK * CLASSES).copy()
    for r in done.toLocalIterator():
        out[r["block"]] = np.frombuffer(r["w"], np.float32) / r["n"]
    return out.reshape(ROWS, CLASSES)


def fit(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """Each round descends on its own share of all training documents."""
    model = statistics(counts)
    tasks = max(1, -(-model.total // (rounds * TASK_TOKENS)))
    for k in range(rounds):
        model.weights = train_round(docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).coalesce(tasks), model)
    return model


def scored_parts(docs: DataFrame, model: Model) -> DataFrame:
    """Sums over kept words for each row, and the ids of its other words with their numbers."""

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        row = TaskContext.get().partitionId() << 33
        lexicon = Lexicon(m.describe)
        base_norm = np.log10(m.total + m.distinct + 1)
        slot_norm = np.log10(np.maximum(m.slot_size, 1))
        for b in batches:
            for part in chunks(b, 1_000_000):
                t = lexicon.tokens(part["text"].tolist())
                ids, classes, slots, n = (lexicon.of(c, t) for c in ("id", "class", "slot", "n"))
                p = log_chances(m, ids, classes, slots, t.place) - np.where(classes < SINGLES, slot_norm[classes, 0], slot_norm[classes, slots])
                known = n > 0
                logs = np.where(known, np.log10(n + 1.0), 0.0)
                starts = np.cumsum(t.counts) - t.counts
                out = pd.DataFrame({"row": row + np.arange(len(part)), "doc_id": part["doc_id"].array, "n_tokens": t.counts})
                row += len(part)
                out["n_known"] = np.add.reduceat(known.astype(np.int64), starts)
                common = np.add.reduceat(logs, starts)
                out["base"] = common - t.counts * base_norm
                out["score"] = common + np.add.reduceat(p, starts)
                rest = np.split(np.where(known, 0, ids), starts[1:])
                kept = np.split(known, starts[1:])
                pairs = [np.unique(x[~k], return_counts=True) for x, k in zip(rest, kept)]
                out["ids"], out["times"] = [x for x, _ in pairs], [n for _, n in pairs]
                yield out

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    made = rows.mapInPandas(run, "row long, doc_id string, n_tokens long, n_known long, base double, score double, ids array<long>, times array<long>")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def language_model_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Documents whose crc32 of the id, modulo 7, is 2 are held out.  Null text
    is empty and has the end alone; a null doc_id stays null and is learnt
    from; rows that repeat are counted and scored each for itself.  Other
    columns are not read.  With no training rows every count is 0.
    """
    rows = texts_of(docs)
    learn = training(rows)
    counts = settle(token_counts(learn), "token-counts")
    model = fit(learn, counts)
    parts = settle(scored_parts(rows, model), "lm-scores")
    rare = parts.select("row", F.explode(F.arrays_zip("ids", "times")).alias("x")).select("row", F.col("x.ids").alias("id"), F.col("x.times").alias("times"))
    found = rare.join(counts.select("id", "n"), "id").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"), F.sum("times").alias("more")
    )
    more = F.coalesce("logs", F.lit(0.0))
    return parts.join(found, "row", "left").select(
        "doc_id", (fold_of(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
