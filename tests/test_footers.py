from __future__ import annotations

from frames import rows
from pyspark.sql import functions as F

from acadmetric.operators import quality
from acadmetric.sources.footers import column_profile, read_for_footers


def test_counts_and_bounds_read_no_page(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("t"),
                                  F.array("id").alias("list"))
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    spark.range(7).write.parquet(str(tmp_path / "u"))
    tables = read_for_footers(spark, {"t": str(tmp_path / "t"), "u": str(tmp_path / "u")})
    found = quality.volumes(tables)
    assert rows(found) == [("t", 1000), ("u", 7)]
    assert found._jdf.queryExecution().sparkPlan().toString().count("PushedAggregation: [COUNT(*)]") == 2
    profile = column_profile(tables)
    assert sorted(rows(profile)) == [("t", "id", 1000, 1000, 0.0, 999.0), ("t", "t", 1000, 1000, None, None), ("t", "v", 1000, 750, 2.0, 1998.0),
                                     ("u", "id", 7, 7, 0.0, 6.0)]
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(v), COUNT(t), MIN(id)" in profile._jdf.queryExecution().sparkPlan().toString()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_what_footers_lack_is_counted(spark, tmp_path):
    df = spark.range(100).select("id", F.lit(None).cast("long").alias("v"))
    df.write.parquet(str(tmp_path / "t"))
    [table] = read_for_footers(spark, {"t": str(tmp_path / "t")}).values()
    assert table.filter("id % 3 = 0").count() == 34
    assert rows(column_profile({"t": table.limit(0)})) == [("t", "id", 0, 0, None, None), ("t", "v", 0, 0, None, None)]
