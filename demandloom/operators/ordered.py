"""Ordered operators over a whole table, without a task that holds all of it.

Rows get their position in the order from ranges that Spark samples and sorts;
the sizes of the ranges add up to offsets.  Positions are then cut into blocks
of equal length.  What an operator needs from a bounded number of earlier rows
comes with copies of the end of the block before; what it needs from any
distance is carried over the blocks' summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.sources.io import settle

#: Rows of a block, and groups of blocks at most; their summaries are added up on the driver.
BLOCK, GROUPS = 1 << 16, 1024

_BITS = 33  # of monotonically_increasing_id, for the row within its partition


def with_positions(df: DataFrame, order: Sequence[str], total: str | None = None) -> DataFrame:
    """``df`` with ``_pos``, its 0-based position by ``order`` (NULL first); rows equal in it are ordered by all their values.

    ``total`` names a column with the number of all rows.

    The table is dealt by sampled ranges, sorted inside them and written once;
    the driver reads one count for each range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    by = [*[F.col(f"`{c}`") for c in order], F.xxhash64(*[F.col(f"`{c}`") for c in ties])]
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    rows = settle(ranged.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_row", _BITS)
    sizes = sorted(rows.groupBy(part.alias("p")).count().collect())
    offsets, ahead = [], 0
    for p, n in sizes:
        offsets.append((p, ahead))
        ahead += n
    before = df.sparkSession.createDataFrame(offsets, "_part long, _ahead long")
    placed = rows.withColumn("_part", part).join(before, "_part")
    pos = F.col("_ahead") + F.col("_row").bitwiseAND(F.lit((1 << _BITS) - 1))
    return placed.select(*df.columns, pos.alias("_pos"), *([F.lit(ahead).cast("long").alias(total)] if total else []))


def in_blocks(df: DataFrame, order: Sequence[str], reach: int, apply: Callable[[DataFrame, list[str], str], DataFrame], block: int | None = None) -> DataFrame:
    """``apply(rows, keys, order)`` block by block, where a row's result needs at most ``reach`` rows before it.

    Each block also holds copies of the ``reach`` rows before it, which are
    dropped afterwards.  ``_pos`` stays in the result.
    """
    size = max(block or BLOCK, reach, 1)
    placed = df if "_pos" in df.columns else with_positions(df, order)
    own, at = F.floor(F.col("_pos") / size), F.col("_pos") % size
    homes = F.array(F.struct(own.alias("b"), F.lit(False).alias("copy")), F.when(at >= size - reach, F.struct((own + 1).alias("b"), F.lit(True).alias("copy"))))
    dealt = placed.withColumn("_home", F.explode(F.filter(homes, lambda h: h.isNotNull())))
    dealt = dealt.select(*placed.columns, F.col("_home.b").alias("_block"), F.col("_home.copy").alias("_copy"))
    return apply(dealt, ["_block"], "_pos").where(~F.col("_copy")).drop("_block", "_copy")


def carried(placed: DataFrame, before: Mapping[str, Column], after: Mapping[str, Column] | None = None, block: int | None = None) -> DataFrame:
    """``placed`` (with ``_pos``) with the last known value at or before the row of each expression in ``before``, and the next one of ``after``.

    A row sees its own block; the blocks of its group, and at most GROUPS
    groups, supply the rest.
    """
    block, after = block or BLOCK, dict(after or {})
    names = [*before, *after]
    rows = placed.withColumns({**before, **after, "_block": F.floor(F.col("_pos") / block)})

    def ends_of(df: DataFrame, by: str, at: str) -> DataFrame:
        """Of each group the last known value of what is carried forwards, and the first of the others."""
        picks = [(F.max_by, before), (F.min_by, after)]
        return df.groupBy(by).agg(*[pick(n, F.when(F.col(n).isNotNull(), F.col(at))).alias(n) for pick, ns in picks for n in ns])

    def along(keys: str, by: str, own: int) -> dict[str, Column]:
        """The last known value up to a row, in either direction; without the row itself if ``own`` is -1."""
        up, down = (Window.partitionBy(keys).orderBy(o).rowsBetween(Window.unboundedPreceding, own) for o in (F.col(by).asc(), F.col(by).desc()))
        return {n: F.last(n, ignorenulls=True).over(up if n in before else down) for n in names}

    ends = settle(ends_of(rows, "_block", "_pos"), "block-ends")
    last = ends.agg(F.max("_block")).first()[0]
    per_group = max(1, -(-((last or 0) + 1) // GROUPS))
    ends = ends.withColumn("_group", F.floor(F.col("_block") / per_group))
    groups = sorted(ends_of(ends, "_group", "_block").collect(), key=lambda r: r["_group"])
    reach: dict[int, dict] = {r["_group"]: {} for r in groups}
    for carry, order in ((before, groups), (after, groups[::-1])):
        held = dict.fromkeys(carry)
        for r in order:
            reach[r["_group"]].update(held)
            held = {n: held[n] if r[n] is None else r[n] for n in carry}
    kinds = T.StructType([T.StructField("_group", T.LongType()), *[T.StructField(f"{n}_g", rows.schema[n].dataType) for n in names]])
    between = placed.sparkSession.createDataFrame([(g, *[v[n] for n in names]) for g, v in reach.items()], kinds)
    met = ends.select("_group", "_block", *[c.alias(n) for n, c in along("_group", "_block", -1).items()]).join(between, "_group")
    met = met.select("_block", *[F.coalesce(n, f"{n}_g").alias(f"{n}_b") for n in names])
    here = rows.withColumns(along("_block", "_pos", 0)).join(met, "_block")
    return here.select(*[c for c in placed.columns if c not in names], *[F.coalesce(n, f"{n}_b").alias(n) for n in names])
