from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from acadmetric.session import drop_written
from acadmetric.sources import layout, serials
from acadmetric.sources import tables as store


def grid(spark, n=20_000):
    """Two columns that say nothing about each other."""
    return spark.range(n).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 977).alias("b"), "id")


def read_files(df) -> int:
    return len(df.inputFiles())


def test_a_filter_on_either_column_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "z")
    stored = layout.store_interleaved(grid(spark), path, ["a", "b"], 36)
    assert sorted(rows(stored)) == sorted(rows(grid(spark)))
    total = read_files(stored)
    assert total >= 30
    for column in ("a", "b"):
        found = layout.read_between(spark, path, column, 100, 110)
        assert sorted(rows(found)) == sorted(rows(grid(spark).filter(f"{column} BETWEEN 100 AND 110")))
        assert read_files(found) <= total / 3
    one_column = layout.store_ordered(grid(spark), str(tmp_path / "o"), ["a"], 36)
    assert read_files(layout.read_between(spark, str(tmp_path / "o"), "a", 100, 110)) <= 3
    assert read_files(one_column) >= 30
    nothing = layout.read_between(spark, path, "a", 5000, 6000)
    assert nothing.count() == 0 and nothing.columns == stored.columns


def test_a_combination_that_a_third_of_the_rows_share_fills_several_files(spark, tmp_path):
    hot = grid(spark).withColumn("a", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("a"))).withColumn(
        "b", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("b")))
    layout.store_interleaved(hot, str(tmp_path / "h"), ["a", "b"], 24)
    held = layout.bounds(spark, str(tmp_path / "h"))
    assert held.agg(F.sum("rows")).first()[0] == hot.count()
    assert held.agg(F.max("rows")).first()[0] < hot.count() / 8


def test_bloom_filters_skip_row_groups_by_value(spark, tmp_path):
    even = spark.range(40_000).select((F.col("id") * 2).alias("a"), F.col("id").alias("b"))
    layout.store_interleaved(even, str(tmp_path / "f"), ["a"], 4, bloom=["a"])

    def rows_read(value: int) -> int:
        df = spark.read.parquet(str(tmp_path / "f")).filter(F.col("a") == value)
        df.collect()
        return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    assert rows_read(10_000) > 0
    assert sum(rows_read(value) == 0 for value in range(10_001, 10_041, 2)) >= 15  # inside the bounds, absent from the file


def test_interleaving_follows_its_rule(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    got = {(r.a, r.b): r.z for r in df.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    for (a, b), found in got.items():
        assert found == sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(3))


def pairs(spark, data):
    return spark.createDataFrame(data, "p long, d string, role string, seq long")


def test_a_small_insert_reads_few_files(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "pairs"), ["p", "d"]
    held = spark.range(5000).select("id", F.concat(F.lit("d"), F.col("id") % 7).alias("d"), F.lit("AP").alias("role")).withColumnRenamed("id", "p")
    layout.store_ordered(held, path, key, 20)
    names = layout.file_names(spark, path)
    incoming = pairs(spark, [(100, "d2", "CA", 1), (100, "d9", "CA", 2), (100, "d9", "AP", 1), (4999, "d1", "CA", 1), (9000, "x", "CA", 1), (None, "d1", "CA", 1)])
    chosen = layout.files_with(spark, path, incoming, key)
    assert 0 < len(chosen) <= 4 < len(names)
    found = layout.insert_ignore_ordered(spark, path, incoming, key, ["seq"])
    fresh = sorted(rows(found.join(held.select("p", "d"), key, "left_anti")), key=str)
    assert fresh == [(100, "d9", "AP"), (9000, "x", "CA"), (None, "d1", "CA")]
    assert found.count() == 5003
    again = layout.insert_ignore_ordered(spark, path, incoming.filter("p IS NOT NULL"), key, ["seq"])
    assert again.count() == 5003


def test_serials_go_on_over_loads(spark, tmp_path):
    table, sequence = str(tmp_path / "t"), str(tmp_path / "s")
    for n in (5, 0, 300):
        serials.append_numbered(spark.range(n).select((-F.col("id")).alias("v")), table, sequence, "key", [("v", False)])
    assert sorted(r.key for r in spark.read.parquet(table).collect()) == list(range(1, 306))
    assert serials.last_number(spark, sequence) == 305


def test_a_failed_load_gives_its_numbers_to_nobody(spark, tmp_path, monkeypatch):
    table, sequence, order = str(tmp_path / "t"), str(tmp_path / "s"), [("id", False)]
    serials.append_numbered(spark.range(4), table, sequence, "key", order)

    def broken(df, path):
        raise OSError("the disk is full")

    with monkeypatch.context() as patch:
        patch.setattr(serials, "append", broken)
        with pytest.raises(OSError, match="full"):
            serials.append_numbered(spark.range(3), table, sequence, "key", order)
    serials.append_numbered(spark.range(2), table, sequence, "key", order)
    assert sorted(r.key for r in spark.read.parquet(table).collect()) == [1, 2, 3, 4, 8, 9]


def test_two_writers_never_share_a_number(spark, tmp_path, monkeypatch):
    """The second writer has read the end before the first one reserves."""
    path = str(tmp_path / "s")
    assert serials.reserve(spark, path, 10) == 1
    seen = serials.last_number
    stale = iter([10])
    with monkeypatch.context() as patch:
        patch.setattr(serials, "last_number", lambda spark, path: next(stale, None) or seen(spark, path))
        first = serials.reserve(spark, path, 5)
        stale = iter([10])
        second = serials.reserve(spark, path, 5)
    assert (first, second) == (11, 16)


def test_tables_laid_out_go_with_the_files(spark, tmp_path):
    from acadmetric.session import new_path

    store.lay_out_by_key(spark.range(10), "laid_out_once", new_path(spark, "layout"), ["id"], 2)
    assert spark.catalog.tableExists("laid_out_once")
    drop_written(spark)
    assert not spark.catalog.tableExists("laid_out_once")
