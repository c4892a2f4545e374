"""Every report and rule on stored evaluation tables with the declared types."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce

import evaluation_data
import pytest
from frames import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.catalog.governance import event_changes
from acadmetric.operators import quality
from acadmetric.operators.audit import Actor, audit_from_changes
from acadmetric.plans import advanced as adv
from acadmetric.plans import intermediate as mid
from acadmetric.schema import TABLES
from acadmetric.sources.driver import StarTables
from acadmetric.sources.tables import read_tables

# What each report says, without its limit, as one plain statement over the stored tables.
PLAIN = {
    mid.graduates_by_program: """
        SELECT nm_instituicao, nm_programa, count(co_seq_egresso) FROM tb_instituicao JOIN tb_programa USING (co_seq_instituicao)
        JOIN tb_egresso USING (co_seq_programa) GROUP BY 1, 2""",
    mid.active_students: """
        SELECT p.nm_programa, d.tp_nivel, count(*) FROM tb_discente d JOIN tb_programa p USING (co_seq_programa)
        WHERE d.tp_status = 'AT' GROUP BY 1, 2""",
    mid.qualis_by_area: """
        SELECT nm_area, ds_qualis, count(*) FROM rt_producao_docente JOIN tb_producao_cientifica USING (co_seq_producao)
        JOIN rt_programa_docente USING (co_seq_docente) JOIN tb_programa USING (co_seq_programa) JOIN tb_area_avaliacao USING (co_seq_area)
        WHERE ds_qualis IS NOT NULL GROUP BY 1, 2""",
    mid.scores_by_program: """
        SELECT nm_programa, count(*), CAST(round(sum(vl_nota) / CAST(count(vl_nota) AS decimal(10,0)), 2) AS double)
        FROM tb_parecer JOIN tb_programa USING (co_seq_programa) GROUP BY 1""",
    mid.collaborations_by_program: """
        SELECT nm_programa, count(DISTINCT co_seq_colaboracao) FROM tb_programa JOIN tb_projeto_pesquisa USING (co_seq_programa)
        JOIN rt_projeto_colaboracao USING (co_seq_projeto) GROUP BY 1""",
    mid.funding_rank: """
        SELECT nm_programa, s, rank() OVER (ORDER BY s DESC NULLS FIRST) FROM (
            SELECT nm_programa, sum(vl_financiamento) AS s FROM tb_programa JOIN tb_projeto_pesquisa USING (co_seq_programa) GROUP BY 1)""",
    mid.outputs_running_total: """
        SELECT y, n, sum(n) OVER (ORDER BY y) FROM (
            SELECT nu_ano_publicacao AS y, count(*) AS n FROM rt_producao_docente JOIN tb_producao_cientifica USING (co_seq_producao) GROUP BY 1)""",
    adv.graduates_above_area_mean: """
        WITH c AS (SELECT co_seq_area, nm_area, co_seq_programa, nm_programa, count(*) AS n FROM tb_egresso
                   JOIN tb_programa USING (co_seq_programa) JOIN tb_area_avaliacao USING (co_seq_area) GROUP BY ALL)
        SELECT nm_area, nm_programa, n FROM (SELECT *, sum(n) OVER w AS s, count(*) OVER w AS k FROM c WINDOW w AS (PARTITION BY co_seq_area))
        WHERE n * k > s""",
    adv.score_percentiles: """
        SELECT nm_area, nm_programa, CAST(round(m, 2) AS double), n, round(percent_rank() OVER (PARTITION BY co_seq_area ORDER BY m), 2) FROM (
            SELECT nm_area, co_seq_area, co_seq_programa, nm_programa, count(*) AS n, sum(vl_nota) / CAST(count(*) AS decimal(10,0)) AS m
            FROM tb_parecer JOIN tb_programa USING (co_seq_programa) JOIN tb_area_avaliacao USING (co_seq_area) GROUP BY ALL)""",
    adv.completion_ratio: """
        SELECT nm_programa, g, d, CAST(round(CAST(g AS decimal(10,0)) / nullif(d, 0), 2) AS double) FROM (
            SELECT nm_programa, (SELECT count(*) FROM tb_egresso e WHERE e.co_seq_programa = p.co_seq_programa) AS g,
                   (SELECT count(*) FROM tb_discente s WHERE s.co_seq_programa = p.co_seq_programa) AS d FROM tb_programa p)""",
    adv.top_faculty_by_area: """
        SELECT nm_area, nm_docente, n FROM (
            SELECT nm_area, nm_docente, n, row_number() OVER (PARTITION BY co_seq_area ORDER BY n DESC, nm_docente) AS rn FROM (
                SELECT co_seq_area, nm_area, nm_docente, count(*) AS n FROM rt_producao_docente JOIN tb_docente USING (co_seq_docente)
                JOIN rt_programa_docente USING (co_seq_docente) JOIN tb_programa USING (co_seq_programa) JOIN tb_area_avaliacao USING (co_seq_area)
                GROUP BY ALL)) WHERE rn <= 3""",
    adv.advisors_without_permanent_link: """
        SELECT nm_programa, nm_docente, count(*) FROM tb_discente d JOIN tb_programa USING (co_seq_programa)
        JOIN tb_docente f ON f.co_seq_docente = d.co_seq_docente_orientador
        WHERE NOT EXISTS (SELECT 1 FROM rt_programa_docente l WHERE l.co_seq_programa = d.co_seq_programa
                          AND l.co_seq_docente = d.co_seq_docente_orientador AND l.tp_vinculo = 'PE') GROUP BY 1, 2""",
    adv.diverse_funders: """
        SELECT ds_financiador, count(DISTINCT co_seq_area) AS a, count(DISTINCT co_seq_projeto), sum(vl_financiamento)
        FROM tb_projeto_pesquisa JOIN tb_programa USING (co_seq_programa) WHERE ds_financiador IS NOT NULL GROUP BY 1
        HAVING count(DISTINCT co_seq_area) > 1""",
    adv.level_cumulative_share: """
        SELECT tp_nivel, n, round(100 * n / sum(n) OVER (), 1), round(100 * sum(n) OVER (ORDER BY n DESC) / sum(n) OVER (), 1) FROM (
            SELECT tp_nivel, count(DISTINCT co_seq_producao) AS n FROM rt_programa_docente JOIN rt_producao_docente USING (co_seq_docente)
            JOIN tb_programa USING (co_seq_programa) GROUP BY 1)""",
    adv.program_overview: """
        SELECT nm_programa, nm_area, count(DISTINCT co_seq_egresso), count(DISTINCT co_seq_projeto), count(DISTINCT co_seq_docente)
        FROM tb_programa JOIN tb_area_avaliacao USING (co_seq_area) JOIN tb_egresso USING (co_seq_programa)
        LEFT JOIN tb_projeto_pesquisa USING (co_seq_programa) LEFT JOIN rt_programa_docente USING (co_seq_programa)
        GROUP BY co_seq_programa, nm_programa, nm_area""",
    adv.top_decile_indicators: """
        SELECT tp_indicador, nm_programa, CAST(round(vl_indicador, 2) AS double), round(d, 3) FROM (
            SELECT *, cume_dist() OVER (PARTITION BY tp_indicador ORDER BY vl_indicador NULLS LAST) AS d
            FROM tb_indicador JOIN tb_programa USING (co_seq_programa)
            WHERE nu_ano_referencia = (SELECT max(nu_ano_referencia) FROM tb_indicador)) WHERE d >= 0.9""",
}

# These have no limit of their own or are compared below.
WITHOUT_LIMIT = (mid.outputs_running_total, adv.diverse_funders, adv.level_cumulative_share)
OTHERS = [
    mid.indicator_means, mid.grades_by_area, adv.productivity_above_mean, adv.grade_evolution, adv.star_faculty, adv.funded_collaborators,
    adv.indicator_moving_mean, adv.type_share_by_area, adv.heavy_criteria_areas, adv.output_quartiles, adv.consistent_evaluators,
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("evaluation"))
    evaluation_data.load(spark, folder)
    tables = read_tables(spark, folder, [name for name in TABLES if name[:2] in ("tb", "rt")])
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def plain(values):
    return sorted(tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in values)


@pytest.mark.parametrize("report", PLAIN, ids=lambda r: r.__name__)
def test_whole_report_equals_plain_sql(spark, stored, report):
    got = report(stored) if report in WITHOUT_LIMIT else report(stored, limit=None)
    want = plain(map(none_last, rows(spark.sql(PLAIN[report]))))
    assert want and plain(map(none_last, rows(got))) == want


def none_last(row):
    return tuple((v is None, 0 if v is None else v)[1] if v is not None else -1.0 for v in row)


@pytest.mark.parametrize("report", [*PLAIN, *OTHERS], ids=lambda r: r.__name__)
def test_a_limit_keeps_the_first_rows(stored, report):
    if report in WITHOUT_LIMIT or report is mid.indicator_means:
        assert report(stored).count() > 0
        return
    whole = rows(report(stored, limit=None))
    few = rows(report(stored, limit=4))
    assert len(few) == min(4, len(whole))
    if report not in (adv.grade_evolution, adv.indicator_moving_mean):  # a cut history looks back no further than its rows
        assert set(few) <= set(whole)


def test_areas_that_share_a_name_are_ordered_by_share(spark, stored):
    areas = spark.createDataFrame([(1, "A", "1"), (2, "A", "2")], TABLES["tb_area_avaliacao"].struct)
    programs = spark.createDataFrame([(i, f"P{i:02d}", str(i), "ME", 1, 1 if i < 4 else 2, "S") for i in range(1, 7)], TABLES["tb_programa"].struct)
    marks = ["9.00", "8.50", "8.00", "3.00", "2.00", "1.00"]
    opinions = spark.createDataFrame(
        [(i, 1, i, 2020, Decimal(m), None, date(2020, 1, 1)) for i, m in enumerate(marks, 1)], TABLES["tb_parecer"].struct)
    got = adv.score_percentiles({"tb_area_avaliacao": areas, "tb_programa": programs, "tb_parecer": opinions}, limit=3)
    assert [r.nm_programa for r in got.collect()] == ["P01", "P04", "P02"]


def test_stored_tables_break_no_rule(stored):
    found = [quality.rule_violations(stored, TABLES[name]) for name in stored]
    everything = reduce(DataFrame.unionByName, found)
    assert rows(everything.filter("violacoes > 0")) == []
    assert quality.rule_counts(everything).count() == len(stored) == 18


def test_outputs_by_program_against_plain_sql(spark, stored):
    want = spark.sql("""
        SELECT l.co_seq_programa, count(DISTINCT a.co_seq_producao) AS n
        FROM rt_programa_docente l, rt_producao_docente a WHERE a.co_seq_docente = l.co_seq_docente GROUP BY 1""")
    got = mid.outputs_by_program(stored, limit=1000).select("co_seq_programa", "qt_producoes")
    assert sorted(rows(got)) == sorted(rows(want))


def test_quartiles_against_plain_windows(spark, stored):
    tiles = [(r.nm_programa, r.quartil_producao) for r in adv.output_quartiles(stored, limit=1000).collect()]
    mid.outputs_by_program(stored, limit=1000).createOrReplaceTempView("produced")
    want = spark.sql("""
        SELECT nm_programa, CAST(ntile(4) OVER (ORDER BY qt_producoes, co_seq_programa DESC) AS BIGINT) FROM produced
        WHERE co_seq_programa IN (SELECT co_seq_programa FROM tb_relatorio WHERE tp_relatorio = 'QU')""")
    assert sorted(tiles) == sorted(rows(want))


def test_a_log_of_accepted_changes_feeds_the_audit_reports(spark, small):
    feed = event_changes(StarTables(spark, small).events)
    log = audit_from_changes(feed, "tb_evento", ["event_id"], Actor("maria"))
    assert set(log.columns) == {c.name for c in TABLES["au_operacao"].columns}
    broken = quality.with_broken_rules(log, TABLES["au_operacao"])
    accepted = broken.filter(F.size("broken_rules") == 0).drop("broken_rules")
    total = feed.count()
    assert accepted.count() == total
    volume = adv.audit_volume({"au_operacao": accepted}).first()
    assert volume.insercoes + volume.alteracoes + volume.exclusoes == volume.total_tabela == total
    sequence = adv.audit_sequence({"au_operacao": accepted}).collect()
    assert [r.seq_evento for r in sequence] == list(range(1, 31))
    assert {r.total_na_tabela for r in sequence} == {total}
