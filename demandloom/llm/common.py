"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.sources.io import settle

#: What stands in for a missing document id when ids are ordered or joined: before all others.
NO_ID = -(1 << 63)

T = TypeVar("T")

MAX_RANGES = 1024


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator reads, so that further columns of any name can't clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def range_of(value: Column, bounds: list[int]) -> Column:
    """How many bounds are <= value, by a tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def id_ranges(ids: DataFrame, column: str) -> list[int]:
    """At most MAX_RANGES - 1 bounds that cut a long column into ranges of like size (one bounded row on the driver)."""
    n = min(MAX_RANGES, max(2, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = ids.select(F.percentile_approx(column, [i / n for i in range(1, n)], 100 * n)).first()[0]
    return sorted(set(found or []))


def neighbours(rows: DataFrame, key: str, carry: str) -> DataFrame:
    """For each distinct key in ascending order: the key before it and that key's largest ``carry``.

    Returns (key, prev_key, prev_carry); the key before the first is the last
    one.  Ranges of keys are ordered separately, and the last row of each range
    (at most MAX_RANGES rows) passes on to the next range through the driver.
    """
    spark = rows.sparkSession
    one = settle(rows.groupBy(key).agg(F.max(carry).alias("_carry")), "order")
    bounds = id_ranges(one, key)
    cut = one.withColumn("_range", range_of(F.col(key), bounds))
    ends = cut.groupBy("_range").agg(F.max(F.struct(key, "_carry")).alias("e")).orderBy("_range").collect()
    order = [r["_range"] for r in ends]
    last = [(r["_range"], ends[i - 1]["e"][0], ends[i - 1]["e"][1]) for i, r in enumerate(ends)]
    assert order == sorted(order)
    edge = spark.createDataFrame(last, "_range int, _last long, _last_carry long")
    w = W.partitionBy("_range").orderBy(key)
    inside = cut.withColumn("_p", F.lag(F.struct(F.col(key).alias("k"), F.col("_carry").alias("c"))).over(w))
    return inside.join(edge, "_range").select(
        key,
        F.coalesce("_p.k", "_last").alias("prev_key"),
        F.when(F.col("_p").isNull(), F.col("_last_carry")).otherwise(F.col("_p.c")).alias("prev_carry"),
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id reachable from it.

    Alternating large-star and small-star rounds; each is written to the shared
    folder.  Every step keeps at most one edge for a node and its smallest
    neighbour, so a hub never gathers its neighbours in one task: minima are
    partial aggregates, and joins on a hub's id are splittable.
    """
    e = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = settle(small, name)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


#: Slots of a bitmap that stands for a set of ids; its size is the same for any number of them.
FILTER_BITS = 1 << 22

#: Slots for each id of a bitmap that grows with their number, and all of its slots at most.
EACH_BITS, MOST_BITS = 16, 1 << 28


def slot_of(key: Column, slots: int = FILTER_BITS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def bit_array(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the ids on the driver: a power of two of slots, EACH_BITS for each at least or MOST_BITS in all."""
    slots = min(MOST_BITS, max(1 << 16, 1 << (EACH_BITS * ids.count()).bit_length()))
    found = bit_table(ids, column, slots).toArrow()
    bits = np.zeros(slots // 64, np.uint64)
    bits[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def bit_table(ids: DataFrame, column: str, slots: int = FILTER_BITS) -> DataFrame:
    """(w, bits): a bitmap of the ids in at most slots / 64 rows; it fills up but never misses one."""
    return (
        ids.select(slot_of(F.col(column), slots).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    )


def maybe_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is in ``ids``, and a few others: a join with a bitmap of fixed size, so rows stay where they are."""
    bits = F.broadcast(bit_table(ids, column).withColumnRenamed("w", "_w"))
    slot = slot_of(F.col(column))
    hit = rows.withColumn("_w", F.shiftright(slot, 6)).withColumn("_b", F.pmod(slot, F.lit(64)).cast("int")).join(bits, "_w")
    return hit.where(F.getbit("bits", "_b") == 1).drop("_w", "_b", "bits")


def merged(label: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``label`` (id, component) after more links (a, b): only components that these join are worked on."""
    a = label.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = label.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = settle(components(ends, name), f"{name}-joined")
    to = joined.select(F.col("id").alias("component"), F.col("component").alias("c"))
    old = label.join(to, "component", "left").select("id", F.coalesce("c", "component").alias("component"))
    return settle(old.unionByName(joined.join(label.select("id"), "id", "left_anti")), f"{name}-label")


def crossing(apart: DataFrame) -> float:
    """How many pairs of different components the signatures of (sig, key, c) hold, for each row."""
    by = apart.groupBy("sig", "c").agg(F.count("*").cast("double").alias("n"))
    by = by.groupBy("sig").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    found = by.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2), F.sum("n")).first()
    return found[0] / found[1] if found[1] else 0.0


#: Different members that the signatures of one group of like keys are compared with.
LEADERS = 8

#: Pairs for each member that are made at once; members of a group from which it has several leaders, and how many.
FEW, MANY, HEADS = 1, 32, 4


def similarity_components(
    sigs: DataFrame,
    prepare: Callable[[DataFrame], T],
    link: Callable[[DataFrame, T], DataFrame],
    name: str,
    light: Callable[[T], DataFrame] | None = None,
    may: Callable[[Column, Column], Column] | None = None,
    leaders: int = LEADERS,
    rounds: int = 0,
    alike: bool = False,
) -> DataFrame:
    """(id, component) of the keys that are linked, from signatures (sig, key) of which linked keys share one.

    All keys that share a signature are first compared with one of them, a
    different one for every ``leaders``-th signature.  What that leaves in
    different components under one signature is then compared pair by pair, so
    no link between components is lost, and members of one component are never
    paired.  ``prepare`` gets the keys that share a signature with another;
    ``link`` gets pairs (a, b) of them and returns those that hold.  With
    ``light`` (key, f) and ``may``, pairs that f rules out aren't made.  So many
    ``rounds`` at most first compare what is left in other components of a
    signature with new leaders of it, as long as that finds links and more than
    FEW pairs a member are left.  So a member of a large group needs one of its
    neighbours among the leaders, and is not paired with all of them.  With
    ``alike``, signatures with the same keys are one once they have had their
    leaders: keys that are like share many.
    """
    parts = int(sigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # made once, read by both sides; the few shared signatures are the built side
    dealt = sigs.repartition(parts, "sig")
    # another order of the keys for another signature, by flipping bits
    turned = F.col("key").bitwiseXOR(F.xxhash64(F.pmod("sig", F.lit(leaders))))
    leader = F.col("low").bitwiseXOR(F.xxhash64(F.pmod("sig", F.lit(leaders))))
    if alike:
        once = dealt.distinct()
        hashes = F.struct(F.count("*"), F.bit_xor(F.xxhash64("key")), F.bit_xor(F.xxhash64("key", F.lit(1))))
        shared = once.groupBy("sig").agg(F.min(turned).alias("low"), F.max(turned).alias("high"), F.xxhash64(hashes).alias("group")).where("low < high")
        members = settle(once.join(shared.hint("shuffle_hash"), "sig").select("group", leader.alias("l"), "key").distinct(), f"{name}-groups")
        led = members.select("l", "key").where("l <> key")
        members = settle(members.select(F.col("group").alias("sig"), "key").distinct(), f"{name}-members")
    else:
        shared = dealt.groupBy("sig").agg(F.min(turned).alias("low"), F.max(turned).alias("high")).where("low < high").select("sig", "low")
        members = settle(dealt.join(shared.hint("shuffle_hash"), "sig").distinct(), f"{name}-members")
        led = members.select(leader.alias("l"), "key").where("l <> key")
    stars = settle(led.select(F.least("l", "key").alias("a"), F.greatest("l", "key").alias("b")).distinct(), f"{name}-pairs")
    ready = prepare(members.select("key").distinct())
    edges = settle(link(stars, ready), f"{name}-edges")
    label = components(edges, name)

    def across(label: DataFrame) -> DataFrame:
        """(sig, key, c) of signatures whose keys are in different components."""
        at = members.join(label.withColumnRenamed("id", "key"), "key", "left").select("sig", "key", F.coalesce("component", "key").alias("c"))
        mixed = at.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("sig")
        return at.join(mixed, "sig")

    apart = across(label)
    for r in range(rounds):
        apart = settle(apart, f"{name}-apart")
        if crossing(apart) <= FEW:
            break
        # the smallest sets lead first: what a group has in common links them with all that it can link
        turn = F.xxhash64("sig", F.lit(r))
        sized = apart.join(light(ready).select("key", F.col("f.n").alias("n")), "key") if light and r == 0 else apart.withColumn("n", F.lit(0))
        # a large group has several leaders, each for all of its members
        large = apart.groupBy("sig").count().where(F.col("count") > MANY).select("sig", F.lit(HEADS).alias("heads"))
        part = F.pmod(F.xxhash64("key", turn), F.coalesce("heads", F.lit(1)))
        first = (
            sized.join(large, "sig", "left").groupBy("sig", part.alias("part"))
            .agg(F.min(F.struct("n", F.col("key").bitwiseXOR(turn).alias("low"))).alias("m")).select("sig", F.col("m.low").bitwiseXOR(turn).alias("l"))
        )
        heads = apart.groupBy("key").agg(F.min("c").alias("lc")).withColumnRenamed("key", "l")
        led = apart.join(first, "sig").join(heads, "l").where("c <> lc")
        pairs = led.select(F.least("l", "key").alias("a"), F.greatest("l", "key").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
        pairs = settle(pairs, f"{name}-pairs")
        found = settle(link(pairs, ready), f"{name}-edges")
        stars = stars.unionByName(pairs)
        if found.isEmpty():
            break
        label = merged(label, found, name)
        apart = across(label)
    apart = settle(apart.join(light(ready), "key") if light else apart.withColumn("f", F.lit(0)), f"{name}-apart")
    left = apart.select("sig", F.col("key").alias("a"), F.col("c").alias("ca"), F.col("f").alias("fa"))
    right = apart.select(F.col("sig").alias("sig2"), F.col("key").alias("b"), F.col("c").alias("cb"), F.col("f").alias("fb"))
    # the condition belongs to the join, so that ruled-out pairs never become rows
    on = (F.col("sig") == F.col("sig2")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    if may:
        on = on & may(F.col("fa"), F.col("fb"))
    rest = left.join(right, on).select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = settle(link(rest, ready), f"{name}-more")
    return label if more.isEmpty() else merged(label, more, name)


def may_link(x: Column, y: Column, numerator: int, denominator: int) -> Column:
    """Whether sets with these (n, parity) can be similar: by size, then by bits that each element flips one of."""
    differ = F.aggregate(F.zip_with(x["parity"], y["parity"], lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    return (F.least(x["n"], y["n"]) * denominator >= F.greatest(x["n"], y["n"]) * numerator) & (
        differ * (denominator + numerator) <= (x["n"] + y["n"]) * (denominator - numerator)
    )


def near_pairs(pairs: DataFrame, light: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) of keys that ``may_link`` by their (key, f) in ``light``."""
    x = light.withColumnsRenamed({"key": "a", "f": "fa"})
    y = light.withColumnsRenamed({"key": "b", "f": "fb"})
    return pairs.join(x, "a").join(y, "b").where(may_link(F.col("fa"), F.col("fb"), numerator, denominator)).select("a", "b")
