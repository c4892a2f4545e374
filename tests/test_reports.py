"""Cases the star-schema tables lack: missing values, ties, zero denominators, fan-out."""

from __future__ import annotations

from frames import rows
from pyspark.sql import functions as F

from acadmetric.plans import advanced as adv
from acadmetric.plans import intermediate as mid
from acadmetric.plans import timing
from acadmetric.sources.views import evaluation_views

AREAS = ([(1, "Area 1"), (2, "Area 2")], "co_seq_area int, nm_area string")
PROGRAMS = ([(1, "PPG A", "ME", 1, 1), (2, "PPG B", "DO", 1, 1), (3, "PPG C", "ME", 1, 2)],
            "co_seq_programa int, nm_programa string, tp_nivel string, co_seq_instituicao int, co_seq_area int")


def tables(spark, **frames):
    given = {"tb_area_avaliacao": AREAS, "tb_programa": PROGRAMS, **frames}
    return {name: spark.createDataFrame(data, schema) for name, (data, schema) in given.items()}


def projects(data):
    text = "co_seq_projeto int, co_seq_programa int, vl_financiamento decimal(15,2), ds_financiador string"
    from decimal import Decimal
    return [(p, g, None if v is None else Decimal(v), f) for p, g, v, f in data], text


def test_missing_funding_ranks_first(spark):
    t = tables(spark, tb_projeto_pesquisa=projects(
        [(1, 1, "10.50", None), (2, 1, None, None), (3, 2, None, None), (4, 3, "10.50", None)]))
    got = [(r.nm_programa, r.total_financiado and float(r.total_financiado), r.ranking)
           for r in mid.funding_rank(t).collect()]
    assert got == [("PPG B", None, 1), ("PPG A", 10.5, 2), ("PPG C", 10.5, 2)]


def test_funding_counts_once_per_collaboration_unless_asked(spark):
    t = tables(
        spark,
        tb_projeto_pesquisa=projects([(1, 1, "100.00", None), (2, 2, "90.00", None), (3, 3, "200.00", None)]),
        rt_projeto_colaboracao=([(1, 7), (1, 8), (1, 9), (2, 7)], "co_seq_projeto int, co_seq_colaboracao int"))
    as_specified = [(r.nm_programa, float(r.total_financiado), r.qt_colaboracoes) for r in adv.funded_collaborators(t).collect()]
    assert as_specified == [("PPG A", 300.0, 3)]  # mean program total is 130
    assert rows(adv.funded_collaborators(t, once_per_project=True)) == []


def test_completion_ratio_without_students_sorts_last(spark):
    t = tables(
        spark,
        tb_egresso=([(1, 1), (2, 1), (3, 2)], "co_seq_egresso int, co_seq_programa int"),
        tb_discente=([(1, 1, "AT"), (2, 1, "DE"), (3, 1, "TI"), (4, 3, "AT")],
                     "co_seq_discente int, co_seq_programa int, tp_status string"))
    assert rows(adv.completion_ratio(t)) == [("PPG A", 2, 3, 0.67), ("PPG C", 0, 1, 0.0), ("PPG B", 1, 0, None)]
    assert rows(adv.completion_ratio(t, counted_status=("AT", "TI")))[0] == ("PPG A", 2, 2, 1.0)


def test_overview_leaves_out_programs_without_graduates(spark):
    t = tables(
        spark,
        tb_egresso=([(1, 1), (2, 1)], "co_seq_egresso int, co_seq_programa int"),
        tb_projeto_pesquisa=projects([(1, 2, "1.00", None)]),
        rt_programa_docente=([(1, 5, "PE"), (1, 6, "CO"), (2, 5, "PE")],
                             "co_seq_programa int, co_seq_docente int, tp_vinculo string"))
    assert rows(adv.program_overview(t)) == [("PPG A", "Area 1", 2, 0, 2)]


REPORT = "co_seq_relatorio int, co_seq_programa int, nu_ano_referencia int, tp_relatorio string, nu_conceito_final int"


def test_grade_before_skips_missing_grades(spark):
    t = tables(spark, tb_relatorio=(
        [(1, 1, 2021, "AN", 4), (2, 1, 2022, "AN", None), (3, 1, 2023, "AN", 6), (4, 2, 2023, "AN", 5)], REPORT))
    assert rows(adv.grade_evolution(t)) == [("PPG A", 2021, 4, None, None), ("PPG A", 2023, 6, 4, 2)]


def test_mean_grade_ignores_missing_but_counts_the_report(spark):
    t = tables(spark, tb_relatorio=(
        [(1, 1, 2024, "QU", 4), (2, 2, 2024, "QU", None), (3, 3, 2024, "QU", None), (4, 1, 2023, "AN", 7)], REPORT))
    assert rows(mid.grades_by_area(t)) == [("Area 2", 1, None), ("Area 1", 2, 4.0)]


def test_equal_levels_share_their_cumulative_value(spark):
    t = tables(
        spark,
        rt_programa_docente=([(1, 1, "PE"), (2, 2, "PE"), (3, 3, "PE")],
                             "co_seq_programa int, co_seq_docente int, tp_vinculo string"),
        rt_producao_docente=([(10, 1), (11, 2), (10, 3)], "co_seq_producao int, co_seq_docente int"),
        tb_producao_cientifica=([(10, "AR"), (11, "AR")], "co_seq_producao int, tp_producao string"))
    assert rows(adv.level_cumulative_share(t)) == [("DO", 1, 50.0, 100.0), ("ME", 1, 50.0, 100.0)]


def test_area_without_evaluators_is_kept(spark):
    t = tables(
        spark,
        tb_criterio_avaliacao=([(1, "60"), (1, "80"), (2, "90"), (2, "20")], "co_seq_area int, v string"),
        tb_avaliador=([(1, 2), (2, 2)], "co_seq_avaliador int, co_seq_area int"))
    t["tb_criterio_avaliacao"] = t["tb_criterio_avaliacao"].select("co_seq_area", F.col("v").cast("decimal(5,2)").alias("vl_peso"))
    assert rows(adv.heavy_criteria_areas(t)) == [("Area 1", 70.0, 0)]


def test_areas_that_share_a_name_weigh_criteria_by_evaluators(spark):
    t = tables(
        spark,
        tb_area_avaliacao=([(1, "Same"), (2, "Same"), (3, "Other")], "co_seq_area int, nm_area string"),
        tb_criterio_avaliacao=([(1, "50.55"), (1, "80"), (2, "90"), (3, "20.10")], "co_seq_area int, v string"),
        tb_avaliador=([(1, 1), (2, 1), (3, 1), (4, 2), (5, 3)], "co_seq_avaliador int, co_seq_area int"))
    t["tb_criterio_avaliacao"] = t["tb_criterio_avaliacao"].select(
        "co_seq_area", F.col("v").cast("decimal(5,2)").alias("vl_peso"))
    joined = t["tb_area_avaliacao"].join(t["tb_criterio_avaliacao"], "co_seq_area").join(
        t["tb_avaliador"], "co_seq_area", "left")
    want = joined.filter("nm_area = 'Same'").agg(F.round(F.avg("vl_peso"), 2).cast("double"), F.countDistinct("co_seq_avaliador"))
    assert rows(adv.heavy_criteria_areas(t)) == [("Same", *rows(want)[0])]


def indicator_tables(spark, values):
    t = tables(spark, tb_indicador=([(p, y, k, v) for p, y, k, v in values],
                                    "co_seq_programa int, nu_ano_referencia int, tp_indicador string, v string"))
    t["tb_programa"] = spark.range(1, 41).select(
        F.col("id").alias("co_seq_programa"), F.format_string("P%02d", "id").alias("nm_programa"), F.lit(1).alias("co_seq_area"))
    t["tb_indicador"] = t["tb_indicador"].withColumn("vl_indicador", F.col("v").cast("decimal(10,4)")).drop("v")
    return t


def test_top_decile_with_ties_and_missing_values(spark):
    values = [(p, 2024, "PD", str(min(p, 19))) for p in range(1, 21)] + [(1, 2023, "PD", "999")]
    values += [(p, 2024, "FE", None if p > 8 else str(p)) for p in range(1, 11)]
    t = indicator_tables(spark, values)
    got = rows(adv.top_decile_indicators(t))
    last = t["tb_indicador"].filter("nu_ano_referencia = 2024").join(t["tb_programa"], "co_seq_programa")
    last.createOrReplaceTempView("last_year")
    want = spark.sql("""
        SELECT tp_indicador, nm_programa, CAST(round(vl_indicador, 2) AS DOUBLE), round(d, 3)
        FROM (SELECT *, cume_dist() OVER (PARTITION BY tp_indicador ORDER BY vl_indicador NULLS LAST) AS d FROM last_year)
        WHERE d >= 0.9 ORDER BY tp_indicador, vl_indicador DESC NULLS FIRST, nm_programa""")
    assert got == rows(want)
    assert {r[3] for r in got if r[0] == "FE"} == {1.0}


def test_moving_mean_covers_two_rows_of_programs_with_three(spark):
    t = indicator_tables(spark, [(1, 2021, "PD", "1"), (1, 2022, "PD", "2"), (1, 2023, "PD", None), (2, 2021, "PD", "9")])
    assert rows(adv.indicator_moving_mean(t)) == [
        ("P01", 2021, 1.0, 1.0), ("P01", 2022, 2.0, 1.5), ("P01", 2023, None, 2.0)]


def test_speedup_equals_the_quotient_of_means(spark):
    data = [("BASELINE", "QI01", n, str(v)) for n, v in enumerate((10, 20, 30))]
    data += [("INDEXADO", "QI01", n, str(v)) for n, v in enumerate((4, 6))] + [("BASELINE", "QI02", 1, "5")]
    frame = spark.createDataFrame(data, "et_fase string, co_consulta string, nu_execucao int, v string")
    t = {"bench_resultado": frame.withColumn("vl_tempo_ms", F.col("v").cast("decimal(12,3)"))}
    assert rows(timing.timing_speedup(t)) == [("QI01", 20.0, 5.0, 4.0)]
    assert rows(timing.timing_summary(t))[0] == ("BASELINE", "QI01", 3, 20.0, 10.0, 10.0, 30.0)


def test_shares_and_totals_add_up(spark, small):
    t = evaluation_views(spark, small)
    shares = {}
    for r in adv.type_share_by_area(t, limit=1000).collect():
        shares[r.nm_area] = shares.get(r.nm_area, 0) + r.perc_area
    assert all(abs(total - 100) < 0.31 for total in shares.values())
    yearly = mid.outputs_running_total(t).collect()
    assert yearly[-1].acumulado == sum(r.qt_ano for r in yearly) == t["rt_producao_docente"].count()
    levels = adv.level_cumulative_share(t).collect()
    assert levels[-1].perc_acumulado == 100.0
    tops = {}
    for r in adv.top_decile_indicators(t, limit=1000).collect():
        tops[r.tp_indicador] = max(tops.get(r.tp_indicador, 0), r.distribuicao)
    assert set(tops.values()) == {1.0}
