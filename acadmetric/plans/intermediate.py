"""Ten reports that join and aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acadmetric.functions.exact import half_up_mean
from acadmetric.operators.bridge import path_counts
from acadmetric.operators.ordered import top_ranked
from acadmetric.plans.parts import (
    Tables, at_most, outputs_per_program, programs_in_areas, programs_with_area_name, rows_per_program)


def outputs_by_program(t: Tables, limit: int | None = 20) -> DataFrame:
    """Programs with the most distinct outputs."""
    names = t["tb_programa"].select("co_seq_programa", "nm_programa")
    return (
        outputs_per_program(t).join(names, "co_seq_programa")
        .select("co_seq_programa", "nm_programa", F.col("qt_prod").alias("qt_producoes"))
        .orderBy(F.desc("qt_producoes"), "co_seq_programa")
        .transform(at_most(limit))
    )


def graduates_by_program(t: Tables, limit: int | None = 20) -> DataFrame:
    """Graduates by institution and program name."""
    counts = t["tb_egresso"].groupBy("co_seq_programa").agg(F.count("co_seq_egresso").alias("n"))
    return (
        counts.join(t["tb_programa"].select("co_seq_programa", "nm_programa", "co_seq_instituicao"), "co_seq_programa")
        .join(t["tb_instituicao"].select("co_seq_instituicao", "nm_instituicao"), "co_seq_instituicao")
        .groupBy("nm_instituicao", "nm_programa")
        .agg(F.sum("n").alias("qt_egressos"))
        .orderBy(F.desc("qt_egressos"), "nm_instituicao", "nm_programa")
        .transform(at_most(limit))
    )


def active_students(t: Tables, limit: int | None = 20) -> DataFrame:
    """Active students by program name and level."""
    counts = (
        t["tb_discente"].filter(F.col("tp_status") == "AT")
        .groupBy("co_seq_programa", "tp_nivel").agg(F.count("*").alias("n"))
    )
    return (
        counts.join(programs_in_areas(t), "co_seq_programa")
        .groupBy("nm_programa", "tp_nivel")
        .agg(F.sum("n").alias("qt_discentes"))
        .orderBy(F.desc("qt_discentes"), "nm_programa", "tp_nivel")
        .transform(at_most(limit))
    )


def paths_by_area(t: Tables, attribute: str) -> DataFrame:
    """Author x program paths per area name and output attribute.

    An output counts once for each of its authors and each program the author
    is linked to.
    """
    outputs = t["tb_producao_cientifica"].select("co_seq_producao", attribute).filter(F.col(attribute).isNotNull())
    items = t["rt_producao_docente"].select("co_seq_producao", "co_seq_docente").join(outputs, "co_seq_producao")
    links = t["rt_programa_docente"].select("co_seq_programa", "co_seq_docente").join(
        programs_with_area_name(t), "co_seq_programa")
    return path_counts(links, items, "co_seq_docente", ["nm_area"], [attribute])


def qualis_by_area(t: Tables, limit: int | None = 30) -> DataFrame:
    """Output paths by area and Qualis class."""
    return (
        paths_by_area(t, "ds_qualis")
        .select("nm_area", "ds_qualis", F.col("paths").alias("qt"))
        .orderBy("nm_area", "ds_qualis")
        .transform(at_most(limit))
    )


def scores_by_program(t: Tables, limit: int | None = 20) -> DataFrame:
    """Opinions and mean score per program name, best first."""
    per_evaluator = t["tb_parecer"].groupBy("co_seq_programa", "co_seq_avaliador").agg(
        F.count("co_seq_parecer").alias("n"), F.sum("vl_nota").alias("s"), F.count("vl_nota").alias("k"))
    sums = per_evaluator.join(t["tb_avaliador"].select("co_seq_avaliador"), "co_seq_avaliador", "left_semi").groupBy(
        "co_seq_programa").agg(*(F.sum(c).alias(c) for c in "nsk"))
    return (
        sums.join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
        .groupBy("nm_programa")
        .agg(F.sum("n").alias("qt_pareceres"), F.sum("s").alias("s"), F.sum("k").alias("k"))
        .filter(F.col("qt_pareceres") > 0)
        .select("nm_programa", "qt_pareceres", half_up_mean(F.col("s"), F.col("k"), 2, 2).alias("nota_media"))
        .orderBy(F.desc_nulls_first("nota_media"), "nm_programa")
        .transform(at_most(limit))
    )


def indicator_means(t: Tables) -> DataFrame:
    """Mean value of each indicator type per year."""
    known = t["tb_indicador"].join(programs_in_areas(t).select("co_seq_programa"), "co_seq_programa", "left_semi")
    return (
        known.groupBy("nu_ano_referencia", "tp_indicador")
        .agg(F.sum("vl_indicador").alias("s"), F.count("vl_indicador").alias("k"))
        .select("nu_ano_referencia", "tp_indicador", half_up_mean(F.col("s"), F.col("k"), 4, 2).alias("media"))
        .orderBy("nu_ano_referencia", "tp_indicador")
    )


def collaboration_paths(t: Tables) -> DataFrame:
    """(program, collaboration) of every known collaboration of a project; pairs may repeat."""
    bridge = t["rt_projeto_colaboracao"].join(
        t["tb_colaboracao_internacional"].select("co_seq_colaboracao"), "co_seq_colaboracao", "left_semi")
    projects = t["tb_projeto_pesquisa"].select("co_seq_projeto", "co_seq_programa")
    return bridge.join(projects, "co_seq_projeto").select("co_seq_programa", "co_seq_colaboracao")


def collaborations_by_program(t: Tables, limit: int | None = 20) -> DataFrame:
    """International collaborations per program name."""
    names = t["tb_programa"].select("co_seq_programa", "nm_programa")
    return (
        collaboration_paths(t).distinct().join(names, "co_seq_programa")
        .select("nm_programa", "co_seq_colaboracao").distinct()
        .groupBy("nm_programa").agg(F.count("*").alias("qt_colaboracoes"))
        .orderBy(F.desc("qt_colaboracoes"), "nm_programa")
        .transform(at_most(limit))
    )


def funding_rank(t: Tables, limit: int | None = 20) -> DataFrame:
    """Total funding per program name and its rank among all programs; a missing total ranks first."""
    totals = t["tb_projeto_pesquisa"].groupBy("co_seq_programa").agg(F.sum("vl_financiamento").alias("s"))
    per_name = (
        totals.join(programs_in_areas(t), "co_seq_programa")
        .groupBy("nm_programa").agg(F.sum("s").alias("total_financiado"))
    )
    return top_ranked(per_name, "total_financiado", [F.asc("nm_programa")], limit).orderBy("ranking", "nm_programa")


def outputs_running_total(t: Tables) -> DataFrame:
    """Authorships per publication year and their running total."""
    years = t["tb_producao_cientifica"].select("co_seq_producao", F.col("nu_ano_publicacao").alias("ano"))
    # The years are attached first; then one row per year and faculty member is left to look up.
    per_year = (
        t["rt_producao_docente"].select("co_seq_producao", "co_seq_docente").join(years, "co_seq_producao")
        .groupBy("ano", "co_seq_docente").agg(F.count("*").alias("n"))
        .join(t["tb_docente"].select("co_seq_docente"), "co_seq_docente", "left_semi")
        .groupBy("ano").agg(F.sum("n").alias("qt_ano"))
    )
    # One row per year reaches this window.
    running = F.sum("qt_ano").over(Window.orderBy("ano"))
    return per_year.withColumn("acumulado", running).orderBy("ano")


def grades_by_area(t: Tables, limit: int | None = 20) -> DataFrame:
    """Reports and mean final grade per area, four-year reports only; null grades count as reports only."""
    final = t["tb_relatorio"].filter(F.col("tp_relatorio") == "QU")
    sums = final.groupBy("co_seq_programa").agg(
        F.count("co_seq_relatorio").alias("n"),
        F.sum("nu_conceito_final").alias("s"),
        F.count("nu_conceito_final").alias("k"),
    )
    return (
        sums.join(programs_with_area_name(t), "co_seq_programa")
        .groupBy("nm_area")
        .agg(F.sum("n").alias("qt_relatorios"), F.sum("s").alias("s"), F.sum("k").alias("k"))
        .select("nm_area", "qt_relatorios", half_up_mean(F.col("s"), F.col("k"), 0, 2).alias("conceito_medio"))
        .orderBy(F.desc_nulls_first("conceito_medio"), "nm_area")
        .transform(at_most(limit))
    )


# The leaner forms used for timing: ids only, no order, no limit.


def outputs_per_known_program(t: Tables) -> DataFrame:
    known = t["tb_programa"].select("co_seq_programa")
    return outputs_per_program(t).join(known, "co_seq_programa", "left_semi")


def graduates_per_program(t: Tables) -> DataFrame:
    counts = rows_per_program(t["tb_egresso"].select("co_seq_programa"), "qt_egressos")
    programs = t["tb_programa"].select("co_seq_programa", "co_seq_instituicao").join(
        t["tb_instituicao"].select("co_seq_instituicao"), "co_seq_instituicao", "left_semi")
    return counts.join(programs, "co_seq_programa").select("co_seq_instituicao", "co_seq_programa", "qt_egressos")


def active_students_per_program(t: Tables) -> DataFrame:
    counts = (
        t["tb_discente"].filter(F.col("tp_status") == "AT")
        .groupBy("co_seq_programa", "tp_nivel").agg(F.count("*").alias("qt_discentes"))
    )
    return counts.join(programs_in_areas(t).select("co_seq_programa"), "co_seq_programa", "left_semi")


def collaborations_per_program(t: Tables) -> DataFrame:
    counts = rows_per_program(collaboration_paths(t).distinct(), "qt_colaboracoes")
    return counts.join(t["tb_programa"].select("co_seq_programa"), "co_seq_programa", "left_semi")
