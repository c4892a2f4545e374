from __future__ import annotations

from fractions import Fraction

from frames import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acadmetric.functions import exact, keys


def half_up(num: int, den: int, places: int) -> float:
    scaled = abs(Fraction(num, den)) * 10**places
    whole = int(scaled + Fraction(1, 2))
    return (-whole if num < 0 else whole) / 10**places


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = rows(df.select("a", "b", exact.half_up(F.col("a"), F.col("b"), 2)))
    assert all(value == half_up(a, b, 2) for a, b, value in got)


def test_half_up_at_ties_and_without_rows(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (-1, 8), (5, 0), (0, 3)], "a long, b long")
    assert [r[0] for r in df.select(exact.half_up(F.col("a"), F.col("b"), 2)).collect()] == [0.13, 0.38, -0.13, None, 0.0]


def test_floor_div(spark):
    pairs = [(7, 2), (-7, 2), (6, 3), (-6, 3), (0, 5), (-1, 10**9), (5, 0), (10**30, 7)]
    df = spark.createDataFrame([(str(a), b) for a, b in pairs], "a string, b long").select(F.col("a").cast("decimal(38,0)").alias("a"), "b")
    got = [None if r[0] is None else int(r[0]) for r in df.select(exact.floor_div(F.col("a"), F.col("b"))).collect()]
    assert got == [None if b == 0 else a // b for a, b in pairs]


def test_mean_of_decimals(spark):
    df = spark.createDataFrame([("1.01",), ("1.02",), (None,)], "v string").select(F.col("v").cast("decimal(4,2)"))
    got = df.select(exact.half_up_mean(F.sum("v"), F.count("v"), 2, 2), exact.half_up_mean(F.sum("v"), F.count("v"), 2, 1))
    assert rows(got) == [(1.02, 1.0)]


def test_equal_ratios_are_equal(spark):
    df = spark.createDataFrame([(2, 6), (1, 3), (1, 0)], "a long, b long")
    values = [r[0] for r in df.select(exact.scaled_ratio(F.col("a"), F.col("b"))).collect()]
    assert values[0] == values[1] and values[2] is None


def test_key_text_in_given_order_with_missing_part(spark):
    df = spark.createDataFrame([(7, None)], "b long, a string")
    assert rows(df.select(keys.key_text(["b", "a"]))) == [("b=7;a=NULL;",)]


def test_image_keeps_nulls_and_microseconds(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS note, TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts")
    text = df.select(keys.record_image(F.struct("*"))).first()[0]
    assert text == '{"id":1,"note":null,"ts":"2024-01-01T00:00:07.179575"}'


def test_pick_is_one_based_and_null_outside(spark):
    df = spark.range(1, 5)
    assert [r[0] for r in df.select(keys.pick(("x", "y", "z"), F.col("id"))).collect()] == ["x", "y", "z", None]


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumn("u", keys.uniform(42, F.col("id")))
    again = spark.range(2000).repartition(5).withColumn("u", keys.uniform(42, F.col("id")))
    assert sorted(rows(df)) == sorted(rows(again))
    assert df.agg(F.avg("u")).first()[0] == __import__("pytest").approx(0.5, abs=0.03)
    drawn = df.select(keys.skewed_draw(F.col("u"), F.lit(80)).alias("k"))
    low, high, first = drawn.agg(F.min("k"), F.max("k"), F.count(F.when(F.col("k") == 1, 1))).first()
    assert (low, high) == (1, 80) and first > 2000 / 10


def test_elapsed_ms(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:01.5005' AS b")
    assert rows(df.select(keys.elapsed_ms(F.col("a"), F.col("b")))) == [(1500.5,)]
