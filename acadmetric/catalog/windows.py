"""Window functions.

Windows over small aggregates (years, levels, types) are written as windows.
Numberings and distributions over groups of any size go through
``operators.ordered``; totals are an aggregate joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acadmetric.catalog.registry import query
from acadmetric.catalog.views_sql import rounded, with_views
from acadmetric.functions.exact import half_up_mean, half_up_percent, scaled_ratio
from acadmetric.operators.ordered import peer_positions, row_numbers, tile, with_peer_positions, with_rows_before
from acadmetric.sources.driver import StarTables
from acadmetric.sources.views import evaluation_views


def _count(name: str = "n"):
    return F.count("*").alias(name)


def _area_counts(s: StarTables, key: str) -> DataFrame:
    """Lines per region name and line key, counted before the dimensions are joined."""
    places = s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        s.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    counts = s.lineitem.groupBy(*{"l_suppkey", key}).agg(_count("k"))
    return counts.join(places, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("r_name", key).agg(
        F.sum("k").alias("n"))


@query("win_rank_global", """
    SELECT o_custkey, CAST(t AS DOUBLE) AS total, rank() OVER (ORDER BY t DESC) AS ranking
    FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS t FROM orders GROUP BY 1)""")
def win_rank_global(spark: SparkSession, folder: str) -> DataFrame:
    totals = StarTables(spark, folder).orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("t"))
    return with_peer_positions(totals, "t", descending=True).select(
        "o_custkey", F.col("t").cast("double").alias("total"), (F.col("before") + 1).alias("ranking"))


@query("win_rank_partition", """
    SELECT r_name, s_suppkey, n, rank() OVER (PARTITION BY r_name ORDER BY n DESC) AS posicao
    FROM (SELECT r_name, s_suppkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
          JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2)""")
def win_rank_partition(spark: SparkSession, folder: str) -> DataFrame:
    counts = _area_counts(StarTables(spark, folder), "l_suppkey").withColumnRenamed("l_suppkey", "s_suppkey")
    placed = with_peer_positions(counts, "n", ["r_name"], descending=True)
    return placed.select("r_name", "s_suppkey", "n", (F.col("before") + 1).alias("posicao"))


@query("win_row_number_agg", """
    SELECT r_name, l_partkey, n, row_number() OVER (PARTITION BY r_name ORDER BY n DESC, l_partkey) AS rn
    FROM (SELECT r_name, l_partkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
          JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2)""")
def win_row_number_agg(spark: SparkSession, folder: str) -> DataFrame:
    counts = _area_counts(StarTables(spark, folder), "l_partkey")
    return row_numbers(counts, [("n", True), ("l_partkey", False)], by=["r_name"])


@query("topk_per_group", """
    SELECT r_name, l_partkey, n FROM (
        SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY n DESC, l_partkey) AS pos
        FROM (SELECT r_name, l_partkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
              JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2))
    WHERE pos <= 3""")
def topk_per_group(spark: SparkSession, folder: str) -> DataFrame:
    counts = _area_counts(StarTables(spark, folder), "l_partkey")
    best = Window.partitionBy("r_name").orderBy(F.desc("n"), "l_partkey")
    return counts.withColumn("pos", F.row_number().over(best)).filter(F.col("pos") <= 3).drop("pos")


@query("filter_window_result", """
    SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def filter_window_result(spark: SparkSession, folder: str) -> DataFrame:
    best = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    orders = StarTables(spark, folder).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= 3).select("o_custkey", "o_orderkey")


@query("win_row_number_time", """
    SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq_evento
    FROM events""")
def win_row_number_time(spark: SparkSession, folder: str) -> DataFrame:
    events = StarTables(spark, folder).events.select("event_type", "event_id", "ts")
    numbered = row_numbers(events, [("ts", False), ("event_id", False)], "seq_evento", ["event_type"])
    return numbered.select("event_type", "event_id", "seq_evento")


@query("win_percent_rank", with_views("opinion program", """
    SELECT prog_name, area_id, percent_rank() OVER (PARTITION BY area_id ORDER BY q) AS percentil
    FROM (SELECT prog_name, area_id, CAST(sum(cents) AS HUGEINT) * 1000000000000 // count(*) AS q
          FROM opinion JOIN program USING (prog_id) GROUP BY prog_id, 1, 2)"""))
def win_percent_rank(spark: SparkSession, folder: str) -> DataFrame:
    t = evaluation_views(spark, folder)
    means = t["tb_parecer"].groupBy("co_seq_programa").agg(
        scaled_ratio(F.sum("vl_nota") * 100, F.count("*")).alias("mean"))
    placed = means.join(t["tb_programa"].select("co_seq_programa", "nm_programa", "co_seq_area"), "co_seq_programa")
    ranked = with_peer_positions(placed, "mean", ["co_seq_area"])
    share = F.when(F.col("total") == 1, 0.0).otherwise(F.try_divide("before", F.col("total") - 1))
    return ranked.select(F.col("nm_programa").alias("prog_name"), F.col("co_seq_area").alias("area_id"),
                         share.alias("percentil"))


@query("win_cume_dist", with_views("indicator", """
    SELECT prog_id, yr, kind, cume_dist() OVER (PARTITION BY kind ORDER BY units) AS dist FROM indicator"""))
def win_cume_dist(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluation_views(spark, folder)["tb_indicador"]
    placed = with_peer_positions(rows, "vl_indicador", ["tp_indicador"])
    return placed.select(
        F.col("co_seq_programa").alias("prog_id"), F.col("nu_ano_referencia").cast("bigint").alias("yr"),
        F.col("tp_indicador").alias("kind"), ((F.col("before") + F.col("peers")) / F.col("total")).alias("dist"))


@query("win_ntile", """
    SELECT l_suppkey, n, ntile(4) OVER (ORDER BY n, l_suppkey) AS quartil
    FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def win_ntile(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).lineitem.groupBy("l_suppkey").agg(_count())
    numbered = row_numbers(counts, [("n", False), ("l_suppkey", False)])
    rows = numbered.agg(F.count("*")).scalar()
    return numbered.withColumn("rows", rows).select(
        "l_suppkey", "n", tile(F.col("rn"), F.col("rows"), 4).alias("quartil"))


@query("win_lag", with_views("report", """
    SELECT prog_id, yr, grade, lag(grade) OVER w AS anterior, grade - lag(grade) OVER w AS variacao
    FROM report WHERE grade IS NOT NULL WINDOW w AS (PARTITION BY prog_id ORDER BY yr)"""))
def win_lag(spark: SparkSession, folder: str) -> DataFrame:
    # One row per program and year: a partition of this window is a number of years.
    grades = evaluation_views(spark, folder)["tb_relatorio"].filter(F.col("nu_conceito_final").isNotNull())
    before = F.lag("nu_conceito_final").over(Window.partitionBy("co_seq_programa").orderBy("nu_ano_referencia"))
    return grades.select(
        F.col("co_seq_programa").alias("prog_id"), F.col("nu_ano_referencia").cast("bigint").alias("yr"),
        F.col("nu_conceito_final").alias("grade"), before.alias("anterior"),
        (F.col("nu_conceito_final") - before).alias("variacao"))


@query("win_running_sum", """
    SELECT y AS ano, n, CAST(sum(n) OVER (ORDER BY y) AS BIGINT) AS acumulado
    FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)""")
def win_running_sum(spark: SparkSession, folder: str) -> DataFrame:
    yearly = StarTables(spark, folder).orders.groupBy(F.year("o_orderdate").cast("bigint").alias("ano")).agg(_count())
    return yearly.withColumn("acumulado", F.sum("n").over(Window.orderBy("ano")))


@query("win_cumulative_share", f"""
    SELECT l_shipmonth AS mes, n, {rounded('(sum(n) OVER (ORDER BY n DESC)) * 100', 'sum(n) OVER ()', 1)} AS perc_acumulado
    FROM (SELECT month(l_shipdate) AS l_shipmonth, count(*) AS n FROM lineitem GROUP BY 1)""")
def win_cumulative_share(spark: SparkSession, folder: str) -> DataFrame:
    monthly = StarTables(spark, folder).lineitem.groupBy(F.month("l_shipdate").cast("bigint").alias("mes")).agg(_count())
    running, whole = F.sum("n").over(Window.orderBy(F.desc("n"))), F.sum("n").over(Window.partitionBy())
    return monthly.withColumn("perc_acumulado", half_up_percent(running, whole, 1))


@query("win_total", """
    SELECT o_custkey, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM (
        SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""")
def win_total(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).orders.groupBy("o_custkey").agg(_count())
    return counts.withColumn("total", counts.agg(F.sum("n")).scalar())


@query("win_partition_total", """
    SELECT c_nationkey, o_custkey, n, CAST(sum(n) OVER (PARTITION BY c_nationkey) AS BIGINT) AS total
    FROM (SELECT c_nationkey, o_custkey, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)""")
def win_partition_total(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    counts = s.orders.groupBy("o_custkey").agg(_count()).join(
        s.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    totals = counts.groupBy("c_nationkey").agg(F.sum("n").alias("total"))
    return counts.join(totals, "c_nationkey")


@query("win_partition_count", """
    SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS total_na_tabela FROM events""")
def win_partition_count(spark: SparkSession, folder: str) -> DataFrame:
    events = StarTables(spark, folder).events.select("event_id", "event_type")
    return events.join(events.groupBy("event_type").agg(_count("total_na_tabela")), "event_type")


@query("win_moving_avg_rows", with_views("indicator", f"""
    SELECT prog_id, yr, {rounded('s', 'k * 10000', 2)} AS media FROM (
        SELECT prog_id, yr, sum(units) OVER w AS s, count(*) OVER w AS k FROM indicator WHERE kind = 'PD'
        WINDOW w AS (PARTITION BY prog_id ORDER BY yr ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))"""))
def win_moving_avg_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluation_views(spark, folder)["tb_indicador"].filter(F.col("tp_indicador") == "PD")
    pair = Window.partitionBy("co_seq_programa").orderBy("nu_ano_referencia").rowsBetween(-1, 0)
    sums = rows.withColumn("s", F.sum("vl_indicador").over(pair)).withColumn("k", F.count("*").over(pair))
    return sums.select(
        F.col("co_seq_programa").alias("prog_id"), F.col("nu_ano_referencia").cast("bigint").alias("yr"),
        half_up_mean(F.col("s"), F.col("k"), 4, 2).alias("media"))


@query("peer_positions", """
    SELECT n AS valor, count(*) AS iguais, CAST(sum(count(*)) OVER (ORDER BY n) - count(*) AS BIGINT) AS antes
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey) GROUP BY n""")
def peer_positions_query(spark: SparkSession, folder: str) -> DataFrame:
    per_part = StarTables(spark, folder).lineitem.groupBy("l_partkey").agg(_count())
    return peer_positions(per_part, "n").select(
        F.col("n").alias("valor"), F.col("peers").alias("iguais"), F.col("before").alias("antes"))


@query("win_lag_large_groups", """
    SELECT event_id, event_type, user_id, lag(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS anterior FROM events""")
def win_lag_large_groups(spark: SparkSession, folder: str) -> DataFrame:
    """A few types share all events: a type's events lie in many ranges, each with the last row before it."""
    events = StarTables(spark, folder).events.select("event_id", "event_type", "user_id", "ts")
    order = [("ts", False), ("event_id", False)]
    return with_rows_before(events, 1, order, ["event_type"], lambda w: {"anterior": F.lag("user_id").over(w)}).drop("ts")


@query("win_moving_avg_large_groups", f"""
    SELECT event_id, event_type, {rounded('s', 'n', 2)} AS media_movel FROM (
        SELECT event_id, event_type, sum(user_id) OVER w AS s, count(*) OVER w AS n FROM events
        WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""")
def win_moving_avg_large_groups(spark: SparkSession, folder: str) -> DataFrame:
    events = StarTables(spark, folder).events.select("event_id", "event_type", "user_id", "ts")
    moved = with_rows_before(events, 2, [("ts", False), ("event_id", False)], ["event_type"], lambda w: {
        "s": F.sum("user_id").over(w.rowsBetween(-2, 0)), "n": F.count("*").over(w.rowsBetween(-2, 0))})
    return moved.select("event_id", "event_type", half_up_mean(F.col("s"), F.col("n"), 0, 2).alias("media_movel"))
