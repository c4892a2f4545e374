from __future__ import annotations

from frames import rows
from pyspark.sql import functions as F

from acadmetric.catalog import load
from acadmetric.schema import TABLES
from acadmetric.sources import tables as store
from acadmetric.sources.driver import StarTables

QUERIES = load().QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_read_tables_uses_declared_types(spark, tmp_path):
    import datetime as dt

    event = [(1, "Congresso", "CO", None, dt.date(2020, 1, 1), None)]
    spark.createDataFrame(event, TABLES["tb_evento"].struct).write.parquet(str(tmp_path / "tb_evento"))
    df = store.read_table(spark, str(tmp_path), "tb_evento")
    assert dict(df.dtypes)["dt_inicio"] == "date"
    assert rows(df) == event


def test_first_writer_wins_inside_and_across_loads(spark, tmp_path):
    def pairs(data):
        return spark.createDataFrame(data, "p int, d int, role string, seq int")

    path = str(tmp_path / "pairs")
    first = store.insert_ignore(pairs([]), pairs([(1, 1, "AP", 0), (2, 5, "AP", 0)]), ["p", "d"], ["seq"])
    held = store.append(first, path)
    more = pairs([(1, 1, "CA", 1), (1, 2, "CA", 2), (1, 2, "AP", 1), (3, 3, "CA", 1)])
    result = store.append(store.insert_ignore(held, more, ["p", "d"], ["seq"]), path)
    assert sorted(rows(result.select("p", "d", "role"))) == [(1, 1, "AP"), (1, 2, "AP"), (2, 5, "AP"), (3, 3, "CA")]


def test_loading_twice_equals_loading_once(spark, tmp_path):
    df = spark.range(10)
    store.replace(df, str(tmp_path / "t"))
    assert store.replace(df, str(tmp_path / "t")).count() == 10


def test_tables_laid_out_by_key_join_without_shuffle(spark, tmp_path):
    left = store.lay_out_by_key(spark.range(1000).withColumn("v", F.rand(1)), "lay_left", str(tmp_path / "l"), ["id"], 4)
    right = store.lay_out_by_key(spark.range(500).withColumn("w", F.rand(2)), "lay_right", str(tmp_path / "r"), ["id"], 4)
    joined = left.hint("merge").join(right, "id")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert joined.count() == 500


def test_the_caller_chooses_the_layout(spark, tmp_path):
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    stored = store.lay_out_by_key(hot, "lay_sorted", str(tmp_path / "h"), ["k"], None)
    assert spark.sql("DESCRIBE EXTENDED lay_sorted").filter("col_name = 'Num Buckets'").count() == 0
    assert sorted(rows(stored)) == sorted(rows(hot))
    stored = store.lay_out_by_key(hot, "lay_bucketed", str(tmp_path / "e"), ["k", "id"], 16)
    assert spark.sql("DESCRIBE EXTENDED lay_bucketed").filter("col_name = 'Num Buckets'").first().data_type == "16"
    assert "Exchange" not in plan(stored.groupBy("k", "id").count())


def test_subset_is_read_by_partition(spark, small, tmp_path):
    lines = StarTables(spark, small).lineitem.select("l_suppkey", "l_linestatus", "l_returnflag")
    subset = store.store_subset(lines, F.col("l_linestatus") == "F", "l_returnflag", str(tmp_path / "s"))
    kept = subset.filter(F.col("l_returnflag") == "A")
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan(kept)
    assert kept.count() == lines.filter("l_linestatus = 'F' AND l_returnflag = 'A'").count()


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["qi03_active_students"](spark, small))
    assert "l_linestatus" in text and "l_extendedprice" not in text
    text = plan(QUERIES["filter_eq"](spark, small))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)]" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string>" in text


def test_date_ranges_reach_the_scan(spark, small):
    assert "GreaterThanOrEqual(o_orderdate," in plan(QUERIES["join_self_pivot"](spark, small))


def test_no_report_starts_a_job_while_it_is_built(spark, small):
    tracker = spark.sparkContext.statusTracker()
    for name, run in QUERIES.items():
        if name.startswith(("qi", "qa", "win_", "timed_")):
            StarTables(spark, small).orders.count()
            spark.sparkContext.setJobGroup(f"build {name}", name)
            run(spark, small)
            jobs = list(tracker.getJobIdsForGroup(f"build {name}"))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
            assert jobs == [], name


def test_no_report_multiplies_rows_without_a_key(spark, small):
    for name, run in QUERIES.items():
        if name.startswith(("qi", "qa", "join_", "subq_", "win_")):
            text = plan(run(spark, small))
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_top_lists_are_not_full_sorts(spark, small):
    for name in ("qi01_outputs_per_program", "qi08_funding_rank", "qa13_output_quartile", "topk_global"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, small)), name
    for name in ("qa11_top3_faculty_per_area", "topk_per_group", "qa20_top_decile_indicator"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, small)), name


def test_an_application_can_remove_what_it_wrote(spark):
    from pathlib import Path

    from acadmetric.session import drop_written, new_path, written

    kept = written(spark.range(5), "numbers")
    assert kept.count() == 5
    folder = Path(new_path(spark, "x").removeprefix("file:")).parent
    assert any(folder.iterdir())
    drop_written(spark)
    assert not folder.exists()


def test_pairs_are_dealt_before_they_are_grouped(spark, small):
    """The tasks that read gather no pairs, so a table of one row group is not one task's memory."""
    for name in ("qa12_governance_gap", "qa12_governance_gap_all", "qa13_output_quartile", "qi01_outputs_per_program",
                 "timed_outputs_per_program", "qa01_productivity_above_mean", "timed_productive_programs", "qa06_international_and_funded"):
        lines = [line.lstrip(" +-:*(0123456789)") for line in plan(QUERIES[name](spark, small)).splitlines()]
        scans = [i for i, line in enumerate(lines) if line.startswith("FileScan") and "l_orderkey" in line + lines[i - 1] or
                 line.startswith("FileScan") and "l_partkey" in line]
        assert scans, name
        for i in scans:
            above = next(line for line in reversed(lines[:i]) if line.startswith(("Exchange", "HashAggregate")))
            assert above.startswith("Exchange") and "REPARTITION_BY_NUM" in above, (name, above)


def test_subset_deals_a_code_over_many_tasks(spark, tmp_path):
    rows = spark.range(64_000, numPartitions=1).selectExpr("id", "'A' AS code")
    store.store_subset(rows, F.col("id") >= 0, "code", str(tmp_path / "s"))
    files = list((tmp_path / "s" / "code=A").glob("*.parquet"))
    sizes = [spark.read.parquet(str(f)).count() for f in files[:8]]
    assert len(files) >= 64 and max(sizes) < 2_000
    assert spark.read.parquet(str(tmp_path / "s")).agg(F.count("*"), F.countDistinct("id")).first() == (64_000, 64_000)
