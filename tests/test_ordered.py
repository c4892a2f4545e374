from __future__ import annotations

import random

import pytest
from frames import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from acadmetric.operators import ordered


@pytest.fixture
def sample(spark):
    """Group 'a' holds most rows and value 5 a third of them."""
    draw = random.Random(11)
    data = [("a" if draw.random() < 0.8 else draw.choice("bcd"), n, 5 if draw.random() < 0.33 else draw.randrange(40),
             draw.randrange(9)) for n in range(500)]
    return spark.createDataFrame(data, "grp string, id long, v long, w long").repartition(6)


def test_ranges_follow_the_order_and_split_large_groups(spark, sample):
    some = sample.withColumn("v", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("v")))
    keys = [("grp", False), ("v", True), ("id", False)]
    placed = ordered.ranged(some, keys, 7).orderBy("grp", F.desc_nulls_first("v"), "id").select("_range").collect()
    found = [r[0] for r in placed]
    assert found == sorted(found) and set(found) == set(range(7))


def test_a_numbering_writes_nothing_and_shuffles_its_rows_once(spark, sample):
    plan = ordered.row_numbers(sample, [("v", True), ("id", False)], "rn", ["grp"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(grp") <= 3 and "InsertInto" not in plan


@pytest.mark.parametrize("by", [(), ("grp",)])
def test_row_numbers(sample, many_ranges, by):
    got = ordered.row_numbers(sample, [("v", True), ("id", False)], "rn", by)
    order = [F.col("v").desc(), F.col("id")]
    want = sample.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    assert sorted(rows(got)) == sorted(rows(want))


@pytest.mark.parametrize("by", [(), ("grp",)])
def test_sum_before(sample, many_ranges, by):
    order = [F.col("v"), F.col("id").desc()]
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = sample.withColumn("before", F.coalesce(F.sum("w").over(window), F.lit(0)))
    assert sorted(rows(ordered.sum_before(sample, "w", [("v", False), ("id", True)], by))) == sorted(rows(want))


@pytest.mark.parametrize("by", [(), ("grp",)])
@pytest.mark.parametrize("descending", [False, True])
def test_peer_positions_give_rank_and_distributions(spark, sample, many_ranges, by, descending):
    some = sample.withColumn("v", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("v")))
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    window = Window.partitionBy(*by).orderBy(order)
    want = some.select("id", F.rank().over(window), F.percent_rank().over(window), F.cume_dist().over(window))
    got = ordered.with_peer_positions(some, "v", by, descending).select(
        "id", F.col("before") + 1, F.col("before") / (F.col("total") - 1),
        (F.col("before") + F.col("peers")) / F.col("total"))
    assert sorted(rows(got)) == sorted(rows(want))


@pytest.mark.parametrize("rows_in", [1, 2, 3, 4, 5, 7, 8, 103])
def test_tile_equals_ntile(spark, rows_in):
    df = spark.range(1, rows_in + 1).withColumn("n", F.lit(rows_in).cast("bigint"))
    got = df.select("id", ordered.tile(F.col("id"), F.col("n"), 4).alias("t"))
    want = df.select("id", F.ntile(4).over(Window.orderBy("id")).cast("bigint").alias("t"))
    assert sorted(rows(got)) == sorted(rows(want))


def test_top_ranked_keeps_global_ranks_and_puts_missing_first(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", None), ("c", 9), ("d", 9), ("e", 1), ("f", 5)], "name string, v long")
    got = rows(ordered.top_ranked(df, "v", [F.asc("name")], 5).orderBy("ranking", "name"))
    assert got == [("b", None, 1), ("c", 9, 2), ("d", 9, 2), ("a", 5, 4), ("f", 5, 4)]


def test_top_values_counts_rows_above(sample):
    got = {(g, v): (peers, above, total) for g, v, peers, above, total in rows(
        ordered.top_values(sample, "v", ["grp"], 3))}
    data = [(r.grp, r.v) for r in sample.collect()]
    for grp in {g for g, _ in data}:
        values = [v for g, v in data if g == grp]
        top = sorted(set(values), reverse=True)[:3]
        assert {v for g, v in got if g == grp} == set(top)
        for v in top:
            assert got[grp, v] == (values.count(v), sum(x > v for x in values), len(values))


@pytest.mark.parametrize("by", [(), ("grp",)])
@pytest.mark.parametrize(("back", "parts"), [(1, 7), (3, 7), (4, 60), (2, 1)])
def test_windows_that_look_back_cross_ranges(sample, many_ranges, by, back, parts):
    """With 60 ranges of 500 rows some groups end, and some ranges are shorter than what the window looks back."""
    some = sample.withColumn("v", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("v")))

    def columns(w):
        return {"lagged": F.lag("w", back).over(w), "s": F.sum("w").over(w.rowsBetween(-back, 0)), "k": F.count("w").over(w.rowsBetween(-back, 0))}

    got = ordered.with_rows_before(some, back, [("v", True), ("id", False)], by, columns, parts)
    want = some.withColumns(columns(Window.partitionBy(*by).orderBy(F.desc_nulls_first("v"), "id")))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_few_rows_cross_the_borders(spark, sample, many_ranges):
    """What a range gets from before it is limited inside each task, before it moves."""
    df = ordered.with_rows_before(sample, 2, [("v", False), ("id", False)], ["grp"], lambda w: {"l": F.lag("w", 2).over(w)})
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("enough", [0, 3, 10_000])
def test_percentiles_by_refinement(spark, share, enough):
    draw = random.Random(4)
    values = [5.5 if draw.random() < 0.33 else draw.choice([draw.random() * 1000, float(draw.randrange(-40, 40))]) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double").repartition(5)
    at = (len(values) - 1) * share
    ordered_values = sorted(values)
    low, high = ordered_values[int(at)], ordered_values[min(len(values) - 1, -int(-at // 1))]
    assert rows(ordered.exact_percentile(df, "v", share, parts=4, enough=enough)) == [(low + (high - low) * (at - int(at)),)]


def test_percentiles_of_few_values(spark):
    for values, share, want in (([], 0.5, None), ([3.0], 0.9, 3.0), ([1.0, 2.0], 0.5, 1.5), ([7.0] * 100, 0.25, 7.0), ([0.0] * 99 + [1.0], 0.995, 0.505)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = rows(ordered.exact_percentile(df, "v", share))[0][0]
        assert got == want or abs(got - want) < 1e-12
