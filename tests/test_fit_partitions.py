"""Fits run over as few partitions as their rows need, and keep all rows."""

import random

import pytest
from pyspark.sql import functions as F

from demandloom.operators.forecast import boosted as B
from demandloom.operators.forecast import stacking as ST


def tasks(spark, group, work):
    """Tasks of the jobs that ``work`` runs."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i is not None)


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(3)
    rows = [(i % 40, float(i % 17), i % 17 + rng.random(), i % 17 - rng.random()) for i in range(800)]
    days = spark.createDataFrame(rows, "day int, y double, m1 double, m2 double")
    return days.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).alias("ds"), "y", "m1", "m2")


def test_meta_fit_has_few_tasks(spark, wide, monkeypatch):
    monkeypatch.setattr(ST, "TREES", 2)
    # 64 partitions are read twice at most: once while they are made, once while they are counted
    assert tasks(spark, "meta", lambda: ST.fit_meta(wide.repartition(64), ["m1", "m2"], "random_forest")) < 250


def test_kept_holds_all_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "FIT_ROWS", 100)
    for n, parts in ((0, 1), (100, 1), (101, 2), (5_000, 30)):
        with B.kept(spark.range(n).repartition(30)) as rows:
            assert rows.count() == n and rows.rdd.getNumPartitions() == parts


def test_folds_at_a_time_do_not_change_scores(wide):
    one, many = (ST.cv_scores(wide, ["m1", "m2"], ("ridge", "lasso"), 3, parallelism=n).collect() for n in (1, 8))
    assert one == many and len(one) == 2
