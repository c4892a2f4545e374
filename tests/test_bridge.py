from __future__ import annotations

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from acadmetric.operators import bridge

LINKS, ITEMS = "g long, m long", "m long, i long"


def brute(links, items):
    made = {}
    for m, i in items:
        made.setdefault(m, set()).add(i)
    found = {}
    for g, m in links:
        found.setdefault(g, set()).update(made.get(m, ()))
    return {g: len(s) for g, s in found.items() if s}


def skewed(seed, members=30, groups=60, items=400):
    """Members 0 to 2 hold a third of the links and of the items each or together."""
    draw = random.Random(seed)
    links = {(g, m) for g in range(groups) for m in range(3) if draw.random() < 0.6}
    links |= {(draw.randrange(groups), draw.randrange(members)) for _ in range(150)}
    made = {(m, i) for i in range(items) for m in range(3) if draw.random() < 0.4}
    made |= {(draw.randrange(members), draw.randrange(items)) for _ in range(600)}
    return sorted(links), sorted(made)


@pytest.mark.parametrize("seed,heavy,salts", [(1, 10, 8), (2, 2, 3), (3, 1, 1), (4, 20, 2)])
def test_distinct_items_with_few_and_many_heavy_members(spark, seed, heavy, salts):
    links, items = skewed(seed)
    got = bridge.distinct_items(
        spark.createDataFrame(links, LINKS), spark.createDataFrame(items, ITEMS), "m", "g", "i", heavy=heavy, salts=salts)
    assert dict(rows(got)) == brute(links, items)


def test_heavy_members_are_those_with_most_pairs(spark):
    links, items = skewed(5)
    found = rows(bridge._heavy_members(spark.createDataFrame(links, LINKS), spark.createDataFrame(items, ITEMS), "m", 10))
    assert sorted(b for _, b in found) == [1 << i for i in range(10)]
    assert {m for m, b in found if b < 8} == {0, 1, 2}


def test_nothing_runs_before_the_caller_asks(spark):
    links, items = skewed(8)
    frames = spark.createDataFrame(links, LINKS), spark.createDataFrame(items, ITEMS)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    bridge.distinct_items(*frames, "m", "g", "i")
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_repeated_links_and_items_count_once(spark):
    links, items = skewed(6)
    got = bridge.distinct_items(
        spark.createDataFrame(links + links, LINKS), spark.createDataFrame(items + items[:50], ITEMS), "m", "g", "i",
        heavy=3)
    assert dict(rows(got)) == brute(links, items)


def test_path_counts_equal_joined_rows(spark):
    links, items = skewed(7)
    left = spark.createDataFrame([(g, m, g % 3) for g, m in links], "g long, m long, area long")
    right = spark.createDataFrame([(m, i, i % 4) for m, i in items], "m long, i long, kind long")
    got = {(a, k): n for a, k, n in rows(bridge.path_counts(left, right, "m", ["area"], ["kind"]))}
    want = {(a, k): n for a, k, n in rows(left.join(right, "m").groupBy("area", "kind").count())}
    assert got == want


def far(i):
    """Sparse and negative keys, one word apart and more."""
    return (i - 200) * 1_000_003


@pytest.mark.parametrize("key", [lambda i: i, far], ids=["dense", "sparse"])
def test_sets_of_keys_count_distinct_items_and_members(spark, key):
    links, items = skewed(9)
    items = [(m, key(i)) for m, i in items]
    known = [(i,) for i in sorted({i for _, i in items}) if i % 3]
    frames = (spark.createDataFrame([*links, *links[:40], (5, None)], LINKS),
              spark.createDataFrame([*items, *items[:90], (3, None), (None, key(1))], ITEMS))
    assert dict(rows(bridge.set_counts(*frames, "m", "g", "i"))) == brute(links, items)
    held = spark.createDataFrame([*known, *known[:9], (None,), (123456789,)], "i long")
    kept = [(m, i) for m, i in items if i % 3]
    both = {g: (n, k) for g, n, k in rows(bridge.set_counts(*frames, "m", "g", "i", held, members=True))}
    authors = {m for m, _ in kept}
    assert {g: n for g, (n, _) in both.items()} == brute(links, kept)
    assert {g: k for g, (_, k) in both.items()} == {g: len({m for h, m in links if h == g and m in authors}) for g in both}


def test_a_member_with_a_third_of_all_items_is_a_row_for_64_of_them(spark):
    items = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("m"), F.col("id").alias("i"))
    sets = bridge.key_sets(items, "i", ["m"])
    assert sets.filter("m = 0").count() == -(-30_000 // 64)
    assert sets.agg(F.sum(F.bit_count("_bits"))).first()[0] == 30_000


def test_each_input_is_read_once(spark, tmp_path):
    links, items = skewed(10)
    for name, data, schema in (("links", links, LINKS), ("items", items, ITEMS), ("known", [(i,) for _, i in items], "i long")):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / name)) for name in ("links", "items", "known")]
    found = bridge.set_counts(*read[:2], "m", "g", "i", read[2], members=True)
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 3
