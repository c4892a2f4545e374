"""The thirty reports, the timing summaries and the timed forms, on the logical views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.catalog.registry import register
from acadmetric.catalog.views_sql import rounded, with_views
from acadmetric.plans import advanced as adv
from acadmetric.plans import intermediate as mid
from acadmetric.plans import timing
from acadmetric.sources.views import criteria_views, evaluation_views, funding_views, sponsor_views

Report = Callable[..., DataFrame]


def _plain_types(df: DataFrame) -> DataFrame:
    """Counts and years as bigint, decimals as double and dates as text, so both engines return the same types."""
    targets = {"int": "bigint", "date": "string"}
    columns = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else targets.get(kind, kind)
        columns.append(F.col(name).cast(target).alias(name))
    return df.select(*columns)


def _add(name: str, report: Report, check: str, views: Callable = evaluation_views, **options) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain_types(report(views(spark, folder), **options))

    register(name, check, query=run)


_BRIDGE = "FROM program JOIN link USING (prog_id) JOIN author USING (fac_id) JOIN output USING (out_id)"

_add("qi01_outputs_per_program", mid.outputs_by_program, with_views("program link author output", f"""
    SELECT prog_id AS co_seq_programa, prog_name AS nm_programa, count(DISTINCT out_id) AS qt_producoes
    {_BRIDGE} GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""))

_add("qi02_graduates_per_program", mid.graduates_by_program, with_views("graduate program institution", """
    SELECT inst_name AS nm_instituicao, prog_name AS nm_programa, count(*) AS qt_egressos
    FROM institution JOIN program USING (inst_id) JOIN graduate USING (prog_id)
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""))

_add("qi03_active_students", mid.active_students, with_views("student program area", """
    SELECT prog_name AS nm_programa, student.lvl AS tp_nivel, count(*) AS qt_discentes
    FROM area JOIN program USING (area_id) JOIN student USING (prog_id)
    WHERE status = 'AT' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""))

_add("qi04_qualis_by_area", mid.qualis_by_area, with_views("area program link author output", f"""
    SELECT area_name AS nm_area, qualis AS ds_qualis, count(*) AS qt {_BRIDGE} JOIN area USING (area_id)
    WHERE qualis IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 30"""))

_add("qi05_scores_per_program", mid.scores_by_program, with_views("opinion program evaluator", f"""
    SELECT prog_name AS nm_programa, count(*) AS qt_pareceres, {rounded('sum(cents)', 'count(*) * 100', 2)} AS nota_media
    FROM evaluator JOIN opinion USING (eval_id) JOIN program USING (prog_id)
    GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20"""))

_add("qi06_indicator_mean", mid.indicator_means, with_views("indicator program area", f"""
    SELECT yr AS nu_ano_referencia, kind AS tp_indicador, {rounded('sum(units)', 'count(units) * 10000', 2)} AS media
    FROM area JOIN program USING (area_id) JOIN indicator USING (prog_id) GROUP BY 1, 2"""))

_add("qi07_collabs_per_program", mid.collaborations_by_program, with_views("funded_program project project_collab", """
    SELECT prog_name AS nm_programa, count(DISTINCT s_suppkey) AS qt_colaboracoes
    FROM funded_program JOIN project USING (prog_id) JOIN project_collab USING (proj_id)
    JOIN supplier ON s_suppkey = collab_id
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""), funding_views)

_add("qi08_funding_rank", mid.funding_rank, with_views("funded_program project area", """
    SELECT * FROM (SELECT prog_name AS nm_programa, CAST(sum(amount) AS DOUBLE) AS total_financiado,
                          rank() OVER (ORDER BY sum(amount) DESC NULLS FIRST) AS ranking
                   FROM project JOIN funded_program USING (prog_id) JOIN area USING (area_id) GROUP BY 1)
    ORDER BY ranking, nm_programa LIMIT 20"""), funding_views)

_add("qi09_outputs_running_total", mid.outputs_running_total, with_views("output author faculty", """
    SELECT yr AS ano, count(*) AS qt_ano, CAST(sum(count(*)) OVER (ORDER BY yr) AS BIGINT) AS acumulado
    FROM output JOIN author USING (out_id) JOIN faculty USING (fac_id) GROUP BY yr"""))

_add("qi10_grade_by_area", mid.grades_by_area, with_views("report program area", f"""
    SELECT area_name AS nm_area, count(*) AS qt_relatorios,
           {rounded('sum(grade)', 'nullif(count(grade), 0)', 2)} AS conceito_medio
    FROM report JOIN program USING (prog_id) JOIN area USING (area_id) WHERE kind = 'QU'
    GROUP BY 1 ORDER BY 3 DESC NULLS FIRST, 1 LIMIT 20"""))

_PRODUCTIVE = f"""per AS (
    SELECT prog_id, prog_name, count(DISTINCT out_id) AS n_out, count(DISTINCT fac_id) AS n_fac {_BRIDGE} GROUP BY 1, 2),
    rat AS (SELECT *, CAST(n_out AS HUGEINT) * 1000000000000 // n_fac AS r FROM per)"""

_add("qa01_productivity_above_mean", adv.productivity_above_mean, with_views("program link author output", f"""
    SELECT prog_name AS nm_programa, n_out AS qt_prod, n_fac AS qt_doc,
           {rounded('n_out', 'n_fac', 2)} AS prod_por_docente, rank() OVER (ORDER BY r DESC) AS ranking
    FROM rat WHERE r * (SELECT count(*) FROM rat) > (SELECT sum(r) FROM rat)
    ORDER BY r DESC, prog_id LIMIT 20""", _PRODUCTIVE))

_add("qa02_graduates_above_area_mean", adv.graduates_above_area_mean, with_views("graduate program area", """
    SELECT area_name AS nm_area, prog_name AS nm_programa, n AS qt_egressos
    FROM per JOIN area USING (area_id)
    WHERE n > (SELECT avg(o.n) FROM per AS o WHERE o.area_id = per.area_id)
    ORDER BY 1, 3 DESC, 2 LIMIT 25""", """
    per AS (SELECT prog_id, prog_name, area_id, count(*) AS n
            FROM graduate JOIN program USING (prog_id) GROUP BY 1, 2, 3)"""))

_add("qa03_score_percentile", adv.score_percentiles, with_views("opinion program area", f"""
    SELECT nm_area, nm_programa, nota_media, qt_pareceres, CASE WHEN m = 1 THEN 0.0::DOUBLE ELSE
           {rounded('rk - 1', 'm - 1', 2)} END AS percentil_area
    FROM (SELECT *, rank() OVER (PARTITION BY area_id ORDER BY q) AS rk, count(*) OVER (PARTITION BY area_id) AS m
          FROM per)
    ORDER BY nm_area, percentil_area DESC, q DESC, nm_programa LIMIT 25""", f"""
    per AS (SELECT area_id, area_name AS nm_area, prog_name AS nm_programa, count(*) AS qt_pareceres,
                   {rounded('sum(cents)', 'count(*) * 100', 2)} AS nota_media,
                   CAST(sum(cents) AS HUGEINT) * 1000000000000 // count(*) AS q
            FROM opinion JOIN program USING (prog_id) JOIN area USING (area_id) GROUP BY prog_id, 1, 2, 3)"""))

_add("qa04_grade_evolution", adv.grade_evolution, with_views("report program", """
    SELECT prog_name AS nm_programa, yr AS nu_ano_referencia, grade AS nu_conceito_final, prev AS conceito_anterior,
           grade - prev AS variacao
    FROM (SELECT *, lag(grade) OVER (PARTITION BY prog_name ORDER BY yr) AS prev FROM known)
    WHERE prog_name IN (SELECT prog_name FROM known GROUP BY 1 HAVING count(*) > 1)
    ORDER BY 1, 2 LIMIT 30""", """
    known AS (SELECT prog_name, yr, grade FROM report JOIN program USING (prog_id) WHERE grade IS NOT NULL)"""))

_STAR = """
    star AS (SELECT fac_id, k FROM (
        SELECT fac_id, count(o.out_id) AS k, quantile_cont(count(*), 0.9) OVER () AS least
        FROM author LEFT JOIN output AS o USING (out_id) GROUP BY fac_id) WHERE k > 0 AND k >= least)"""

_add("qa05_star_faculty", adv.star_faculty, with_views("faculty author output", """
    SELECT fac_id AS co_seq_docente, fac_name AS nm_docente, k AS qt_producoes FROM star JOIN faculty USING (fac_id)
    ORDER BY k DESC, fac_id LIMIT 20""", _STAR))

_FUNDED = "funded_program project project_collab"
_MEAN_TOTAL = "SELECT avg(s) FROM (SELECT sum(amount) AS s FROM project GROUP BY prog_id)"

_add("qa06_international_and_funded", adv.funded_collaborators, with_views(_FUNDED, f"""
    SELECT prog_name AS nm_programa, CAST(sum(amount) AS DOUBLE) AS total_financiado,
           count(DISTINCT collab_id) AS qt_colaboracoes
    FROM funded_program JOIN project USING (prog_id) JOIN project_collab USING (proj_id)
    GROUP BY 1 HAVING sum(amount) > ({_MEAN_TOTAL}) ORDER BY 2 DESC, 1 LIMIT 20"""), funding_views)

_add("qa06_funded_once_per_project", adv.funded_collaborators, with_views(_FUNDED, f"""
    SELECT prog_name AS nm_programa, CAST(total AS DOUBLE) AS total_financiado, n AS qt_colaboracoes
    FROM (SELECT prog_name, sum(amount) AS total FROM funded_program JOIN project USING (prog_id)
          WHERE proj_id IN (SELECT proj_id FROM project_collab) GROUP BY 1) JOIN
         (SELECT prog_name, count(DISTINCT collab_id) AS n FROM funded_program JOIN project USING (prog_id)
          JOIN project_collab USING (proj_id) GROUP BY 1) USING (prog_name)
    WHERE total > ({_MEAN_TOTAL}) ORDER BY 2 DESC, 1 LIMIT 20"""), funding_views, once_per_project=True)

_add("qa07_indicator_moving_avg", adv.indicator_moving_mean, with_views("indicator program", f"""
    SELECT prog_name AS nm_programa, yr AS nu_ano_referencia, {rounded('units', '10000', 2)} AS valor,
           {rounded('s', 'k * 10000', 2)} AS media_movel_2a
    FROM (SELECT *, count(*) OVER (PARTITION BY prog_name) AS n, sum(units) OVER w AS s, count(units) OVER w AS k
          FROM indicator JOIN program USING (prog_id) WHERE kind = 'PD'
          WINDOW w AS (PARTITION BY prog_name ORDER BY yr ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
    WHERE n >= 3 ORDER BY 1, 2 LIMIT 30"""))


def _completion(student_filter: str) -> str:
    return with_views("graduate student program area", f"""
        SELECT prog_name AS nm_programa, coalesce(g, 0) AS qt_egressos, coalesce(d, 0) AS qt_discentes,
               {rounded('coalesce(g, 0)', 'd', 2)} AS razao_egr_disc
        FROM program SEMI JOIN area USING (area_id) LEFT JOIN made USING (prog_id) LEFT JOIN held USING (prog_id)
        ORDER BY 4 DESC NULLS LAST, prog_id LIMIT 20""", f"""
        made AS (SELECT prog_id, count(*) AS g FROM graduate GROUP BY 1),
        held AS (SELECT prog_id, count(*) AS d FROM student {student_filter} GROUP BY 1)""")


_add("qa08_completion_ratio", adv.completion_ratio, _completion(""))
_add("qa08_completion_ratio_titled", adv.completion_ratio, _completion("WHERE status = 'TI'"), counted_status=("TI",))

_add("qa09_type_share_by_area", adv.type_share_by_area, with_views("area program link author output", f"""
    SELECT area_name AS nm_area, kind AS tp_producao, n AS qt,
           {rounded('n * 100', 'sum(n) OVER (PARTITION BY area_name)', 1)} AS perc_area,
           rank() OVER (PARTITION BY area_name ORDER BY n DESC) AS posicao
    FROM (SELECT area_name, output.kind, count(*) AS n FROM area JOIN program USING (area_id) JOIN link USING (prog_id)
          JOIN author USING (fac_id) JOIN output USING (out_id) GROUP BY 1, 2)
    ORDER BY 1, 4 DESC, 2 LIMIT 30"""))

_add("qa10_heavy_criteria_areas", adv.heavy_criteria_areas, with_views("nation_area criterion evaluator", f"""
    SELECT area_name AS nm_area, {rounded('sum(cents)', 'count(cents) * 100', 2)} AS peso_medio,
           count(DISTINCT eval_id) AS qt_avaliadores
    FROM nation_area JOIN criterion USING (area_id) LEFT JOIN evaluator USING (area_id)
    GROUP BY 1 HAVING sum(cents) * (SELECT count(*) FROM criterion) > (SELECT sum(cents) FROM criterion) * count(cents)
    ORDER BY 2 DESC, 1 LIMIT 25"""), criteria_views)

_add("qa11_top3_faculty_per_area", adv.top_faculty_by_area, with_views("area program link author output faculty", """
    SELECT area_name AS nm_area, fac_name AS nm_docente, n AS qt
    FROM (SELECT area_name, fac_name, count(*) AS n,
                 row_number() OVER (PARTITION BY area_id ORDER BY count(*) DESC, fac_name) AS pos
          FROM area JOIN program USING (area_id) JOIN link USING (prog_id) JOIN faculty USING (fac_id)
          JOIN author USING (fac_id) JOIN output USING (out_id) GROUP BY area_id, area_name, fac_name)
    WHERE pos <= 3 ORDER BY 1, 3 DESC, 2 LIMIT 30"""))

_add("qa12_governance_gap", adv.advisors_without_permanent_link, with_views("student program faculty link", """
    SELECT prog_name AS nm_programa, fac_name AS orientador, count(*) AS qt_discentes_afetados
    FROM student JOIN program USING (prog_id) JOIN faculty USING (fac_id)
    WHERE NOT EXISTS (SELECT 1 FROM link WHERE link.fac_id = student.fac_id AND link.prog_id = student.prog_id
                      AND link.kind = 'PE')
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 25"""))

_add("qa12_governance_gap_all", adv.advisors_without_permanent_link, with_views("student program faculty link", """
    SELECT prog_name AS nm_programa, fac_name AS orientador, count(*) AS qt_discentes_afetados
    FROM student JOIN program USING (prog_id) JOIN faculty USING (fac_id)
    WHERE (fac_id, prog_id) NOT IN (SELECT (fac_id, prog_id) FROM link WHERE link.kind = 'PE')
    GROUP BY 1, 2"""), limit=None)

_add("qa13_output_quartile", adv.output_quartiles, with_views("program link author output report", """
    SELECT prog_name AS nm_programa, n AS qt_prod, best AS conceito,
           ntile(4) OVER (ORDER BY n, prog_id DESC) AS quartil_producao
    FROM (SELECT prog_id, prog_name, count(DISTINCT out_id) AS n, max(grade) AS best
          FROM program JOIN link USING (prog_id) JOIN author USING (fac_id) JOIN output USING (out_id)
          JOIN report ON report.prog_id = program.prog_id AND report.kind = 'QU' GROUP BY 1, 2)
    ORDER BY n DESC, prog_id LIMIT 25"""))

_add("qa14_diverse_funders", adv.diverse_funders, with_views("project funded_program", """
    SELECT ds_financiador, count(area_id) AS qt_areas, CAST(sum(p) AS BIGINT) AS qt_projetos, CAST(sum(t) AS DOUBLE) AS total
    FROM (SELECT funder AS ds_financiador, area_id, sum(p) AS p, sum(t) AS t FROM paid JOIN funded_program USING (prog_id) GROUP BY 1, 2)
    GROUP BY 1 HAVING count(area_id) > 1""", """
    paid AS (SELECT funder, prog_id, count(*) AS p, sum(amount) AS t FROM project WHERE funder IS NOT NULL GROUP BY 1, 2)"""), sponsor_views)

_add("qa15_level_cumulative_share", adv.level_cumulative_share, with_views("program link author output", f"""
    SELECT lvl AS tp_nivel, n AS qt_prod, {rounded('n * 100', 'sum(n) OVER ()', 1)} AS perc,
           {rounded('(sum(n) OVER (ORDER BY n DESC)) * 100', 'sum(n) OVER ()', 1)} AS perc_acumulado
    FROM (SELECT lvl, count(DISTINCT out_id) AS n {_BRIDGE} GROUP BY 1)"""))

_YEARLY = """
    heard AS (SELECT eval_id, yr, prog_id, count(*) AS n, sum(cents) AS c FROM opinion GROUP BY 1, 2, 3),
    overall AS (SELECT sum(c) AS c, sum(n) AS n FROM heard),
    yearly AS (SELECT eval_name, yr, sum(h.n) AS n, sum(h.c) AS c FROM heard AS h SEMI JOIN program USING (prog_id)
               JOIN evaluator USING (eval_id) GROUP BY 1, 2)"""


def _consistent(most_low_years: str) -> str:
    """Evaluators over three years or more with a mean above the overall one, and at most so many years below it."""
    return with_views("opinion evaluator program", f"""
        SELECT eval_name AS nm_avaliador, CAST(sum(y.n) AS BIGINT) AS qt_pareceres, {rounded('sum(y.c)', 'sum(y.n) * 100', 2)} AS nota_media,
               count(*) AS anos_distintos
        FROM yearly AS y, overall AS o GROUP BY eval_name, o.c, o.n
        HAVING sum(y.c) * o.n > o.c * sum(y.n) AND count(*) > 2 AND count(*) FILTER (y.c * o.n <= o.c * y.n) <= {most_low_years}
        ORDER BY 2 DESC, 1 LIMIT 20""", _YEARLY)


_add("qa16_consistent_evaluators", adv.consistent_evaluators, _consistent("count(*)"))
_add("qa16_consistent_every_year", adv.consistent_evaluators, _consistent("0"), every_year=True)

_add("qa17_audit_volume", adv.audit_volume, with_views("audit", f"""
    SELECT tab AS au_nm_tabela, count(*) FILTER (op = 'I') AS insercoes, count(*) FILTER (op = 'A') AS alteracoes,
           count(*) FILTER (op = 'E') AS exclusoes, count(*) AS total_tabela,
           {rounded('count(*) * 100', '(SELECT count(*) FROM audit)', 2)} AS perc_do_total
    FROM audit GROUP BY 1"""))

_add("qa18_audit_sequence", adv.audit_sequence, with_views("audit", """
    SELECT tab AS au_nm_tabela, op AS au_tp_operacao, CAST(CAST(ts AS DATE) AS VARCHAR) AS dia,
           count(*) OVER (PARTITION BY tab) AS total_na_tabela,
           row_number() OVER (PARTITION BY tab ORDER BY ts, id) AS seq_evento
    FROM audit ORDER BY 1, 5 LIMIT 30"""))

_OWNED = """
    made AS (SELECT prog_id, count(*) AS g FROM graduate GROUP BY 1), led AS (SELECT prog_id, count(*) AS p FROM project GROUP BY 1),
    tied AS (SELECT prog_id, count(*) AS f FROM (SELECT DISTINCT prog_id, fac_id FROM link) GROUP BY 1)"""

_add("qa19_program_overview", adv.program_overview, with_views("program area graduate project link", """
    SELECT prog_name AS nm_programa, area_name AS nm_area, g AS egressos, coalesce(p, 0) AS projetos, coalesce(f, 0) AS docentes
    FROM made JOIN program USING (prog_id) JOIN area USING (area_id) LEFT JOIN led USING (prog_id) LEFT JOIN tied USING (prog_id)
    ORDER BY g DESC, prog_id LIMIT 25""", _OWNED))

_add("qa20_top_decile_indicator", adv.top_decile_indicators, with_views("indicator program", f"""
    SELECT kind AS tp_indicador, prog_name AS nm_programa, {rounded('units', '10000', 2)} AS valor,
           {rounded('upto', 'm', 3)} AS distribuicao
    FROM (SELECT *, count(*) OVER (PARTITION BY kind) AS m, count(*) OVER (PARTITION BY kind ORDER BY units) AS upto,
                 cume_dist() OVER (PARTITION BY kind ORDER BY units) AS cd
          FROM indicator JOIN program USING (prog_id) WHERE yr = (SELECT max(yr) FROM indicator))
    WHERE cd >= 0.9 ORDER BY 1, units DESC, 2 LIMIT 30"""))

_add("bench_summary", timing.timing_summary, with_views("timing", f"""
    SELECT phase AS et_fase, code AS co_consulta, count(*) AS execucoes,
           {rounded('sum(micros)', 'count(*) * 1000', 3)} AS media_ms, round(stddev_samp(value), 3) AS desvio_ms,
           CAST(min(micros) AS DOUBLE) / 1000 AS min_ms, CAST(max(micros) AS DOUBLE) / 1000 AS max_ms
    FROM timing GROUP BY 1, 2"""))

_add("bench_speedup", timing.timing_speedup, with_views("timing", f"""
    SELECT code AS co_consulta, {rounded('s1', 'n1 * 1000', 3)} AS baseline_ms,
           {rounded('s2', 'n2 * 1000', 3)} AS indexado_ms, {rounded('s1 * n2', 's2 * n1', 2)} AS speedup
    FROM (SELECT b.code, b.s AS s1, b.n AS n1, x.s AS s2, x.n AS n2
          FROM (SELECT code, sum(micros) AS s, count(*) AS n FROM timing WHERE phase = 'BASELINE' GROUP BY 1) AS b
          JOIN (SELECT code, sum(micros) AS s, count(*) AS n FROM timing WHERE phase = 'INDEXADO' GROUP BY 1) AS x
            ON x.code = b.code)"""))

# The timed forms: whole results, ids only.

_add("timed_outputs_per_program", mid.outputs_per_known_program, with_views("program link author output", f"""
    SELECT prog_id AS co_seq_programa, count(DISTINCT out_id) AS qt_prod {_BRIDGE} GROUP BY 1"""))

_add("timed_graduates_per_program", mid.graduates_per_program, with_views("graduate program institution", """
    SELECT inst_id AS co_seq_instituicao, prog_id AS co_seq_programa, count(*) AS qt_egressos
    FROM institution JOIN program USING (inst_id) JOIN graduate USING (prog_id) GROUP BY 1, 2""".replace(
        "inst_id AS co", "CAST(inst_id AS BIGINT) AS co")))

_add("timed_active_students", mid.active_students_per_program, with_views("student program area", """
    SELECT prog_id AS co_seq_programa, student.lvl AS tp_nivel, count(*) AS qt_discentes
    FROM area JOIN program USING (area_id) JOIN student USING (prog_id) WHERE status = 'AT' GROUP BY 1, 2"""))

_add("timed_collabs_per_program", mid.collaborations_per_program, with_views(_FUNDED, """
    SELECT prog_id AS co_seq_programa, count(DISTINCT s_suppkey) AS qt_colaboracoes
    FROM funded_program JOIN project USING (prog_id) JOIN project_collab USING (proj_id)
    JOIN supplier ON s_suppkey = collab_id GROUP BY 1"""), funding_views)


def _productive_counts(t) -> DataFrame:
    return adv.productive_programs(t).select("co_seq_programa", "qt_prod", "qt_doc")


_add("timed_productive_programs", _productive_counts, with_views("program link author output", """
    SELECT prog_id AS co_seq_programa, n_out AS qt_prod, n_fac AS qt_doc FROM rat
    WHERE r * (SELECT count(*) FROM rat) > (SELECT sum(r) FROM rat)""", _PRODUCTIVE))

_add("timed_star_faculty", adv.star_authors, with_views("faculty author output", """
    SELECT fac_id AS co_seq_docente, k AS qt_producoes FROM star SEMI JOIN faculty USING (fac_id)""", _STAR))

_add("timed_top3_faculty", adv.top_authors_per_area, with_views("area program link author output faculty", """
    SELECT CAST(area_id AS BIGINT) AS co_seq_area, fac_id AS co_seq_docente, n AS qt, pos AS rn
    FROM (SELECT area_id, fac_id, count(*) AS n,
                 row_number() OVER (PARTITION BY area_id ORDER BY count(*) DESC, fac_id) AS pos
          FROM area JOIN program USING (area_id) JOIN link USING (prog_id) JOIN faculty USING (fac_id)
          JOIN author USING (fac_id) JOIN output USING (out_id) GROUP BY area_id, fac_id)
    WHERE pos <= 3"""))

_add("timed_program_totals", adv.program_totals, with_views("program area graduate project link", """
    SELECT prog_id AS co_seq_programa, g AS egressos, coalesce(p, 0) AS projetos, coalesce(f, 0) AS docentes
    FROM made SEMI JOIN (SELECT prog_id FROM program SEMI JOIN area USING (area_id)) USING (prog_id)
    LEFT JOIN led USING (prog_id) LEFT JOIN tied USING (prog_id)""", _OWNED))
