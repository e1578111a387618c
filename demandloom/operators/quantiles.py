"""Exact quantiles that never gather one group's values in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so
a hot group with many distinct values outgrows its task.  Here values are first
counted (partial aggregation), then spread over value ranges taken from a
bounded quantile sketch; only the ranges that hold a wanted rank are ordered.
The sketch decides where ranges begin, never the answer: ranks are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Value ranges at least and at most; between them as many as there are shuffle partitions.
LEAST_RANGES, MOST_RANGES = 64, 1024


def ranges_of(df: DataFrame) -> int:
    return max(LEAST_RANGES, min(MOST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per key (one row in all without keys) with linearly interpolated quantiles.

    NULL values are ignored; rank of probability ``p`` is ``p * (n - 1)``.
    """
    ranges = ranges or ranges_of(df)
    keys = list(keys)
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    values = df.select(*keys, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))

    grid = [i / ranges for i in range(1, ranges)]
    # Over distinct values: those are the rows the ranges have to balance.
    sketch = counted.groupBy(*keys).agg(
        F.percentile_approx("_v", grid, 4 * ranges).alias("_cuts"), F.sum("_n").alias("_total")
    )
    if keys:
        ranged = _null_safe_join(counted, sketch, keys)
    else:
        one = sketch.select(F.struct("_cuts", "_total").alias("s")).scalar()
        ranged = counted.withColumns({"_cuts": one.getField("_cuts"), "_total": one.getField("_total")})
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    ranged = ranged.select(*keys, "_v", "_n", "_total", below.alias("_range"))

    per_range = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_rows"), F.max("_total").alias("_total"))
    running = F.sum("_rows").over(
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = per_range.withColumn("_before", running - F.col("_rows"))
    wanted = [(_rank(p), p) for p in probs]
    touches = F.lit(False)
    for rank, _ in wanted:
        for r in (F.floor(rank), F.ceil(rank)):
            touches = touches | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows")))
    hit = placed.where(touches).select(*keys, "_range", "_before")

    inside = _null_safe_join(ranged, hit, [*keys, "_range"])
    upto = F.sum("_n").over(
        Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ) + F.col("_before")
    ranked = inside.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_n"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))

    picks = []
    for i, (rank, _) in enumerate(wanted):
        picks += [value_at(F.floor(rank)).alias(f"_lo{i}"), value_at(F.ceil(rank)).alias(f"_hi{i}")]
    picked = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    outputs = []
    for i, (rank, _) in enumerate(wanted):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outputs.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(names[i]))
    return picked.select(*keys, *outputs)


def _rank(p: float) -> Column:
    return F.lit(float(p)) * (F.col("_total") - 1)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that also matches NULL keys with NULL keys."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])
