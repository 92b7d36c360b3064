"""Range-split windows against plain windows and plain Python: hot partitions, NULL order keys, many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from coursematch.operators.ranges import keep_shown, previous_value, running_sum, sampled_bounds
from coursematch.operators.windows import before_first, lag_marker, running_cutoff


def table(spark, seed, n=900):
    rnd = random.Random(seed)
    data = [("hot" if rnd.random() < 0.5 else None if rnd.random() < 0.1 else f"k{rnd.randrange(9)}",
             None if rnd.random() < 0.15 else rnd.randrange(40), i, None if rnd.random() < 0.2 else rnd.randrange(-50, 99),
             rnd.random() < 0.3, rnd.random() < (0.02, 0.2, 0, 1)[seed % 4]) for i in range(n)]
    return data, spark.createDataFrame(data, "g string, o int, id int, v long, hides boolean, ends boolean").repartition(5).cache()


def ordered(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("block", [7, 60, 1 << 20])
def test_running_sum_and_previous(spark, block):
    for seed in range(3):
        data, df = table(spark, seed)
        sums, before = {}, {}
        for group in ordered(data).values():
            total, last = None, None
            for r in group:
                total = r[3] if total is None else total + (r[3] or 0)
                sums[r[2]], before[r[2]] = total, last
                last = r[3]
        got = running_sum(df, ["g"], ["o", "id"], "v", "s", block_rows=block)
        assert got.columns == [*df.columns, "s"] and {r.id: r.s for r in got.collect()} == sums
        got = previous_value(df, ["g"], ["o", "id"], "v", "p", block_rows=block)
        assert {r.id: r.p for r in got.collect()} == before


def test_hot_partition_spans_blocks(spark):
    _, df = table(spark, 1)
    bounds = sampled_bounds(df, ["g", "o", "id"], 30)
    assert 10 < len(bounds) < 30 and sum(b.g == "hot" for b in bounds) > 5
    assert sampled_bounds(df, ["g", "o", "id"], 1 << 20) == [] and len(sampled_bounds(df, ["g", "o", "id"], 1, max_blocks=8)) <= 7


@pytest.mark.parametrize("block", [5, 80, 1 << 20])
def test_keep_shown_equals_plain_windows(spark, block):
    for seed in range(4):
        _, df = table(spark, seed)
        w = lag_marker(running_cutoff(df, ["g"], ["o", "id"], F.col("ends"), "c"), ["g"], ["o", "id"], "hides", "p")
        got = keep_shown(df, ["g"], ["o", "id"], F.col("ends"), F.col("hides"), block_rows=block)
        assert rows(got, "id") == rows(w.filter("c = 0 and not coalesce(p, false)"), "id")
        assert rows(before_first(df, ["g"], ["o", "id"], F.col("ends")), "id") == rows(w.filter("c = 0"), "id")


def test_no_rows(spark):
    _, df = table(spark, 0)
    none = df.limit(0)
    assert running_sum(none, ["g"], ["o"], "v").count() == previous_value(none, ["g"], ["o"], "v").count() == keep_shown(none, ["g"], ["o"], F.col("ends"), F.col("hides")).count() == 0


def test_no_partition_is_sorted_by_one_task(spark):
    """With blocks, the window's exchange is on (partition, block); the parts of a partition meet one row a block."""
    _, df = table(spark, 0)
    plan = running_sum(df, ["g"], ["o", "id"], "v", block_rows=50)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "_block" in plan and "hashpartitioning(g#" not in plan
