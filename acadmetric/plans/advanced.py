"""Twenty reports that compare groups with each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from acadmetric.functions.exact import floor_div, half_up, half_up_mean, half_up_percent, scaled_ratio
from acadmetric.operators.ordered import first_rows, tile, top_numbered, top_ranked, top_values, with_rows_before
from acadmetric.plans.intermediate import paths_by_area
from acadmetric.plans.parts import (
    Tables, at_most, known_authorships, outputs_and_authors, outputs_per_program, programs_in_areas,
    programs_with_area_name, rows_per_program)
from acadmetric.session import dealt

_WIDE = "decimal(38,0)"


def _wide(name: str):
    return F.col(name).cast(_WIDE)


def productive_programs(t: Tables) -> DataFrame:
    """Program ids with outputs, authors and their ratio, where the ratio exceeds its mean."""
    known = t["tb_programa"].select("co_seq_programa")
    base = (
        outputs_and_authors(t).join(known, "co_seq_programa", "left_semi")
        .withColumn("ratio", scaled_ratio(F.col("qt_prod"), F.col("qt_doc")))
    )
    # ratio > mean(ratio), both in whole millionths of the ratio's unit.
    millionths = (F.col("ratio") * 10**6).cast(_WIDE)
    mean = base.agg(floor_div(F.sum(millionths), F.count("*")))
    return base.filter(millionths > mean.scalar())


def productivity_above_mean(t: Tables, limit: int | None = 20) -> DataFrame:
    """Programs whose outputs per author exceed the mean, ranked among those programs."""
    names = t["tb_programa"].select("co_seq_programa", "nm_programa")
    above = productive_programs(t).join(names, "co_seq_programa")
    return top_ranked(above, "ratio", [F.asc("co_seq_programa")], limit).select(
        "nm_programa", "qt_prod", "qt_doc",
        half_up(F.col("qt_prod"), F.col("qt_doc"), 2).alias("prod_por_docente"),
        "ranking",
    ).orderBy(F.desc("prod_por_docente"), "ranking", "nm_programa")


def graduates_above_area_mean(t: Tables, limit: int | None = 25) -> DataFrame:
    """Programs with more graduates than the mean of their own area; programs without graduates do not enter it."""
    counts = t["tb_egresso"].groupBy("co_seq_programa").agg(
        F.count("co_seq_egresso").alias("qt_egressos"), F.count("*").alias("rows"))
    placed = counts.join(programs_with_area_name(t), "co_seq_programa")
    means = placed.groupBy("co_seq_area").agg(F.sum("rows").alias("s"), F.count("*").alias("n"))
    return (
        placed.join(means, "co_seq_area")
        .filter(_wide("qt_egressos") * _wide("n") > _wide("s"))
        .orderBy("nm_area", F.desc("qt_egressos"), "nm_programa")
        .transform(at_most(limit))
        .select("nm_area", "nm_programa", "qt_egressos")
    )


def score_percentiles(t: Tables, limit: int | None = 25) -> DataFrame:
    """Mean score per program and its percent rank inside the area, by the unrounded mean."""
    sums = t["tb_parecer"].groupBy("co_seq_programa").agg(
        F.count("co_seq_parecer").alias("qt_pareceres"), F.sum("vl_nota").alias("s"), F.count("vl_nota").alias("k"))
    placed = sums.join(programs_with_area_name(t), "co_seq_programa").withColumn(
        "mean", scaled_ratio(F.col("s") * 100, F.col("k")))
    best = top_values(placed, "mean", ["co_seq_area"], limit).withColumnsRenamed({"co_seq_area": "area", "mean": "best_mean"})
    below = F.col("total") - F.col("above") - F.col("peers")
    share = F.when(F.col("total") == 1, 0.0).otherwise(half_up(below, F.col("total") - 1, 2))
    # Areas may share a name but are ranked one by one: the order is by name and share, not by name and mean.
    found = (
        placed.join(best, (placed["co_seq_area"] == best["area"]) & placed["mean"].eqNullSafe(best["best_mean"]))
        .select("nm_area", "nm_programa", half_up_mean(F.col("s"), F.col("k"), 2, 2).alias("nota_media"),
                "qt_pareceres", share.alias("percentil_area"), placed["mean"].alias("mean"), "co_seq_programa")
        .orderBy("nm_area", F.desc_nulls_first("percentil_area"), F.desc_nulls_first("mean"), "nm_programa", "co_seq_programa")
        .transform(at_most(limit))
    )
    return found.drop("mean", "co_seq_programa")


def grade_evolution(t: Tables, limit: int | None = 30) -> DataFrame:
    """Final grade, the grade before and the change, for programs with more than one grade.

    Missing grades are removed first, so the grade before is the last known one.
    """
    grades = (
        t["tb_relatorio"].filter(F.col("nu_conceito_final").isNotNull())
        .join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
        .select("nm_programa", "nu_ano_referencia", "nu_conceito_final", "co_seq_relatorio")
    )
    in_time = [F.col("nu_ano_referencia"), F.col("co_seq_relatorio")]
    kept = first_rows(grades, "nm_programa", in_time, 2, limit)
    if limit is None:  # programs may share a name, and a name any share of the rows
        found = with_rows_before(kept, 1, [("nu_ano_referencia", False), ("co_seq_relatorio", False)], ["nm_programa"],
                                 lambda w: {"conceito_anterior": F.lag("nu_conceito_final").over(w)})
    else:
        before = F.lag("nu_conceito_final").over(Window.partitionBy("nm_programa").orderBy(*in_time))
        found = kept.withColumn("conceito_anterior", before)
    return (
        found
        .orderBy("nm_programa", *in_time)
        .select("nm_programa", "nu_ano_referencia", "nu_conceito_final", "conceito_anterior",
                (F.col("nu_conceito_final") - F.col("conceito_anterior")).alias("variacao"))
    )


def outputs_per_author(t: Tables) -> DataFrame:
    return known_authorships(t).groupBy("co_seq_docente").agg(F.count("*").alias("qt_producoes"))


def star_authors(t: Tables) -> DataFrame:
    """Faculty ids whose number of known outputs reaches the 90th percentile of authorships per faculty.

    The percentile is the interpolated one over all authorships. Faculty are
    first counted by their number of authorships, so the exact percentile
    holds one entry per different number.
    """
    outputs = t["tb_producao_cientifica"].select("co_seq_producao", F.lit(1).alias("known"))
    pairs = t["rt_producao_docente"].select("co_seq_producao", "co_seq_docente")
    per_author = pairs.join(outputs, "co_seq_producao", "left").groupBy("co_seq_docente").agg(
        F.count("*").alias("c"), F.count("known").alias("qt_producoes"))
    cut = per_author.groupBy("c").agg(F.count("*").alias("n")).agg(F.percentile("c", F.lit(0.9), F.col("n")))
    return (
        per_author.filter((F.col("qt_producoes") > 0) & (F.col("qt_producoes") >= cut.scalar()))
        .join(t["tb_docente"].select("co_seq_docente"), "co_seq_docente", "left_semi")
        .select("co_seq_docente", "qt_producoes")
    )


def star_faculty(t: Tables, limit: int | None = 20) -> DataFrame:
    """Faculty at or above the 90th percentile of outputs."""
    names = t["tb_docente"].select("co_seq_docente", "nm_docente")
    return (
        star_authors(t).join(names, "co_seq_docente")
        .select("co_seq_docente", "nm_docente", "qt_producoes")
        .orderBy(F.desc("qt_producoes"), "co_seq_docente")
        .transform(at_most(limit))
    )


def funded_collaborators(t: Tables, limit: int | None = 20, once_per_project: bool = False) -> DataFrame:
    """Programs with collaborations whose funding exceeds the mean program total.

    As specified, a project's amount counts once per collaboration on the left
    of the comparison and once on the right. ``once_per_project`` counts it
    once on both sides.
    """
    projects = t["tb_projeto_pesquisa"].select("co_seq_projeto", "co_seq_programa", "vl_financiamento")
    names = t["tb_programa"].select("co_seq_programa", "nm_programa")
    bridge = t["rt_projeto_colaboracao"].select("co_seq_projeto", "co_seq_colaboracao")
    # Paths are summed by ids; names, which programs may share, meet the sums.
    per_pair = bridge.join(projects, "co_seq_projeto").groupBy("co_seq_programa", "co_seq_colaboracao").agg(
        F.sum("vl_financiamento").alias("s"))
    partners = (
        per_pair.join(names, "co_seq_programa")
        .groupBy("nm_programa", "co_seq_colaboracao").agg(F.sum("s").alias("s"))
        .groupBy("nm_programa").agg(F.sum("s").alias("total_financiado"), F.count("*").alias("qt_colaboracoes"))
    )
    if once_per_project:
        own = (
            projects.join(bridge.select("co_seq_projeto"), "co_seq_projeto", "left_semi")
            .groupBy("co_seq_programa").agg(F.sum("vl_financiamento").alias("s"))
            .join(names, "co_seq_programa")
            .groupBy("nm_programa").agg(F.sum("s").alias("total_financiado"))
        )
        partners = partners.drop("total_financiado").join(own, "nm_programa")
    per_program = projects.groupBy("co_seq_programa").agg(F.sum("vl_financiamento").alias("s"))
    # avg(t) ignores programs without any amount; compared in whole cents.
    mean = per_program.agg(floor_div(F.sum("s") * 100, F.count("s")))
    cents = (F.col("total_financiado") * 100).cast(_WIDE)
    return (
        partners.filter(cents > mean.scalar())
        .select("nm_programa", "total_financiado", "qt_colaboracoes")
        .orderBy(F.desc("total_financiado"), "nm_programa")
        .transform(at_most(limit))
    )


def indicator_moving_mean(t: Tables, limit: int | None = 30, indicator: str = "PD") -> DataFrame:
    """Value and two-row moving mean of one indicator, for programs with three or more rows."""
    rows = (
        t["tb_indicador"].filter(F.col("tp_indicador") == indicator)
        .join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
        .select("nm_programa", "nu_ano_referencia", "vl_indicador")
    )
    in_time = [F.col("nu_ano_referencia"), F.col("vl_indicador")]
    kept = first_rows(rows, "nm_programa", in_time, 3, limit)

    def pair(w: WindowSpec) -> dict[str, Column]:
        return {"s": F.sum("vl_indicador").over(w.rowsBetween(-1, 0)), "k": F.count("vl_indicador").over(w.rowsBetween(-1, 0))}

    if limit is None:
        # Rows of one program, year and value are interchangeable, so the order need not part them.
        found = with_rows_before(kept, 1, [("nu_ano_referencia", False), ("vl_indicador", False)], ["nm_programa"], pair)
    else:
        found = kept.withColumns(pair(Window.partitionBy("nm_programa").orderBy(*in_time)))
    return (
        found
        .orderBy("nm_programa", *in_time)
        .select("nm_programa", "nu_ano_referencia",
                half_up_mean(F.col("vl_indicador"), F.lit(1), 4, 2).alias("valor"),
                half_up_mean(F.col("s"), F.col("k"), 4, 2).alias("media_movel_2a"))
    )


def completion_ratio(t: Tables, limit: int | None = 20, counted_status: tuple[str, ...] | None = None) -> DataFrame:
    """Graduates over students per program; null without students, which sorts last.

    All students count, as specified; ``counted_status`` restricts them to
    some states (active and titled, for the ratio the report's title names).
    """
    students = t["tb_discente"]
    if counted_status:
        students = students.filter(F.col("tp_status").isin(*counted_status))
    graduates = rows_per_program(t["tb_egresso"].select("co_seq_programa"), "g")
    enrolled = rows_per_program(students.select("co_seq_programa"), "d")
    g, d = F.coalesce("g", F.lit(0)), F.coalesce("d", F.lit(0))
    return (
        programs_in_areas(t)
        .join(graduates, "co_seq_programa", "left")
        .join(enrolled, "co_seq_programa", "left")
        .select("co_seq_programa", "nm_programa", g.alias("qt_egressos"), d.alias("qt_discentes"),
                half_up(g, d, 2).alias("razao_egr_disc"))
        .orderBy(F.desc_nulls_last("razao_egr_disc"), "co_seq_programa")
        .transform(at_most(limit))
        .drop("co_seq_programa")
    )


def type_share_by_area(t: Tables, limit: int | None = 30) -> DataFrame:
    """Share and rank of each output type inside its area."""
    counts = paths_by_area(t, "tp_producao").withColumnRenamed("paths", "qt")
    # One row per (area, type): both windows see a handful of rows.
    in_area = Window.partitionBy("nm_area")
    return (
        counts.withColumn("perc_area", half_up_percent(F.col("qt"), F.sum("qt").over(in_area), 1))
        .withColumn("posicao", F.rank().over(in_area.orderBy(F.desc("qt"))).cast("bigint"))
        .orderBy("nm_area", F.desc("perc_area"), "tp_producao")
        .transform(at_most(limit))
        .select("nm_area", "tp_producao", "qt", "perc_area", "posicao")
    )


def heavy_criteria_areas(t: Tables, limit: int | None = 25) -> DataFrame:
    """Areas (by name) whose mean criterion weight exceeds the overall mean, with their number of evaluators.

    As specified, a criterion counts once per evaluator of its area, which
    matters only if areas share a name. Both sides are aggregated per area and
    the sums multiplied, so the join repeats nothing.
    """
    weights = t["tb_criterio_avaliacao"].groupBy("co_seq_area").agg(
        F.sum("vl_peso").alias("s"), F.count("vl_peso").alias("n"))
    people = (
        t["tb_avaliador"].groupBy("co_seq_area", "co_seq_avaliador").agg(F.count("*").alias("r"))
        .groupBy("co_seq_area").agg(F.count("co_seq_avaliador").alias("q"), F.sum("r").alias("r"))
    )
    overall = t["tb_criterio_avaliacao"].agg(F.struct(
        (F.sum("vl_peso") * 100).cast(_WIDE).alias("s"), F.count("vl_peso").cast(_WIDE).alias("n"))).scalar()
    times = F.coalesce("r", F.lit(1)).cast(_WIDE)
    named = (
        t["tb_area_avaliacao"].select("co_seq_area", "nm_area")
        .join(weights, "co_seq_area")
        .join(people, "co_seq_area", "left")
        .groupBy("nm_area")
        .agg(F.sum((F.col("s") * 100).cast(_WIDE) * times).alias("cents"), F.sum(F.col("n") * times).alias("rows"),
             F.sum(F.coalesce("q", F.lit(0))).alias("qt_avaliadores"))
    )
    above = F.col("cents") * overall["n"] > overall["s"] * F.col("rows")
    return (
        named.filter(above)
        .select("nm_area", half_up(F.col("cents"), F.col("rows") * 100, 2).alias("peso_medio"), "qt_avaliadores")
        .orderBy(F.desc("peso_medio"), "nm_area")
        .transform(at_most(limit))
    )


def area_author_paths(t: Tables) -> DataFrame:
    """(area, faculty) with output x link paths: outputs of the author times links into the area."""
    outputs = outputs_per_author(t)
    links = (
        t["rt_programa_docente"].select("co_seq_programa", "co_seq_docente")
        .join(programs_in_areas(t).select("co_seq_programa", "co_seq_area"), "co_seq_programa")
        .groupBy("co_seq_area", "co_seq_docente").agg(F.count("*").alias("links"))
    )
    return links.join(outputs, "co_seq_docente").select(
        "co_seq_area", "co_seq_docente", (F.col("links") * F.col("qt_producoes")).alias("qt"))


def top_authors_per_area(t: Tables, per_area: int = 3) -> DataFrame:
    """The leaner form: ids only."""
    known = area_author_paths(t).join(t["tb_docente"].select("co_seq_docente"), "co_seq_docente", "left_semi")
    best = Window.partitionBy("co_seq_area").orderBy(F.desc("qt"), "co_seq_docente")
    ranked = known.withColumn("rn", F.row_number().over(best).cast("bigint"))
    return ranked.filter(F.col("rn") <= per_area)


def top_faculty_by_area(t: Tables, limit: int | None = 30, per_area: int = 3) -> DataFrame:
    """The most productive faculty names of each area."""
    named = (
        area_author_paths(t)
        .join(t["tb_docente"].select("co_seq_docente", "nm_docente"), "co_seq_docente")
        .groupBy("co_seq_area", "nm_docente").agg(F.sum("qt").alias("qt"))
    )
    best = Window.partitionBy("co_seq_area").orderBy(F.desc("qt"), "nm_docente")
    return (
        named.withColumn("rn", F.row_number().over(best))
        .filter(F.col("rn") <= per_area)
        .join(t["tb_area_avaliacao"].select("co_seq_area", "nm_area"), "co_seq_area")
        .orderBy("nm_area", F.desc("qt"), "nm_docente")
        .transform(at_most(limit))
        .select("nm_area", "nm_docente", "qt")
    )


def advisors_without_permanent_link(t: Tables, limit: int | None = 25) -> DataFrame:
    """Students whose advisor holds no permanent link to the student's program."""
    students = t["tb_discente"].select("co_seq_programa", F.col("co_seq_docente_orientador").alias("co_seq_docente"), "co_seq_discente")
    advised = dealt(students, "co_seq_programa", "co_seq_docente").groupBy("co_seq_programa", "co_seq_docente").agg(
        F.count("co_seq_discente").alias("n"))
    permanent = t["rt_programa_docente"].filter(F.col("tp_vinculo") == "PE").select("co_seq_programa", "co_seq_docente")
    # Pairs are counted by ids; names, which are not unique, meet the counts and are summed again.
    return (
        advised.join(permanent, ["co_seq_programa", "co_seq_docente"], "left_anti")
        .join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
        .join(t["tb_docente"].select("co_seq_docente", F.col("nm_docente").alias("orientador")), "co_seq_docente")
        .groupBy("nm_programa", "orientador").agg(F.sum("n").alias("qt_discentes_afetados"))
        .orderBy(F.desc("qt_discentes_afetados"), "nm_programa", "orientador")
        .transform(at_most(limit))
    )


def output_quartiles(t: Tables, limit: int | None = 25) -> DataFrame:
    """Distinct outputs, best final grade and output quartile, most productive programs first.

    Rows are numbered from the top; the quartile counts from the bottom, so
    the number of rows is all that is needed besides the kept rows.
    """
    grades = (
        t["tb_relatorio"].filter(F.col("tp_relatorio") == "QU")
        .groupBy("co_seq_programa").agg(F.max("nu_conceito_final").alias("conceito"))
    )
    base = (
        outputs_per_program(t).join(grades, "co_seq_programa")
        .join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
    )
    rows = base.agg(F.count("*")).scalar()
    numbered = top_numbered(base, [("qt_prod", True), ("co_seq_programa", False)], limit, "from_top")
    return (
        numbered.withColumn("rows", rows)
        .orderBy("from_top")
        .select("nm_programa", "qt_prod", "conceito",
                tile(F.col("rows") - F.col("from_top") + 1, F.col("rows"), 4).alias("quartil_producao"))
    )


def diverse_funders(t: Tables) -> DataFrame:
    """Funders with projects in more than one area.

    The project id is the table's key and a project has one program, so one area: projects are counted per program
    first and add up over areas.
    """
    per_program = (
        t["tb_projeto_pesquisa"].filter(F.col("ds_financiador").isNotNull())
        .groupBy("ds_financiador", "co_seq_programa")
        .agg(F.count("*").alias("p"), F.sum("vl_financiamento").alias("s"))
    )
    return (
        per_program.join(t["tb_programa"].select("co_seq_programa", "co_seq_area"), "co_seq_programa")
        .groupBy("ds_financiador", "co_seq_area").agg(F.sum("p").alias("p"), F.sum("s").alias("s"))
        .groupBy("ds_financiador")
        .agg(F.count("co_seq_area").alias("qt_areas"), F.sum("p").alias("qt_projetos"), F.sum("s").alias("total"))
        .filter(F.col("qt_areas") > 1)
        .orderBy(F.desc("qt_areas"), F.desc_nulls_first("total"), "ds_financiador")
    )


def level_cumulative_share(t: Tables) -> DataFrame:
    """Distinct outputs per program level, their share and cumulative share; an output may count in several levels."""
    levels = (
        t["rt_programa_docente"].select("co_seq_programa", "co_seq_docente")
        .join(t["tb_programa"].select("co_seq_programa", "tp_nivel"), "co_seq_programa")
        .select("co_seq_docente", "tp_nivel").distinct()
    )
    # A member has at most one row per level, so the join cannot grow beyond the number of levels.
    counts = (
        levels.join(known_authorships(t), "co_seq_docente")
        .select("tp_nivel", "co_seq_producao").distinct()
        .groupBy("tp_nivel").agg(F.count("*").alias("qt_prod"))
    )
    # One row per level reaches these windows; equal counts share a cumulative value.
    whole = F.sum("qt_prod").over(Window.partitionBy())
    running = F.sum("qt_prod").over(Window.orderBy(F.desc("qt_prod")))
    return (
        counts.select("tp_nivel", "qt_prod", half_up_percent(F.col("qt_prod"), whole, 1).alias("perc"),
                      half_up_percent(running, whole, 1).alias("perc_acumulado"))
        .orderBy(F.desc("qt_prod"), "tp_nivel")
    )


def consistent_evaluators(t: Tables, limit: int | None = 20, every_year: bool = False) -> DataFrame:
    """Evaluators whose mean score exceeds the overall mean over three or more years.

    As specified, one mean over all years is compared. ``every_year`` asks that
    each year's own mean exceeds the overall mean.
    """
    known = t["tb_programa"].select("co_seq_programa", F.lit(True).alias("known"))
    opinions = t["tb_parecer"].select(
        "co_seq_parecer", "co_seq_avaliador", "co_seq_programa", "nu_ano_avaliacao", "vl_nota")

    def of_known(value: str) -> Column:
        return F.when(F.col("known"), F.col(value))

    # Opinions on unknown programs count for the overall mean only: they are marked, not dropped.
    yearly = opinions.join(known, "co_seq_programa", "left").groupBy("co_seq_avaliador", "nu_ano_avaliacao").agg(
        F.sum("vl_nota").alias("all_s"), F.count("vl_nota").alias("all_k"), F.count(of_known("co_seq_parecer")).alias("n"),
        F.sum(of_known("vl_nota")).alias("s"), F.count(of_known("vl_nota")).alias("k"), F.count("known").alias("rows"))
    overall = yearly.agg(F.struct((F.sum("all_s") * 100).cast(_WIDE).alias("s"), F.sum("all_k").cast(_WIDE).alias("n"))).scalar()

    def above(s: str, k: str):
        return (F.col(s) * 100).cast(_WIDE) * overall["n"] > overall["s"] * _wide(k)

    named = (
        yearly.filter(F.col("rows") > 0)
        .join(t["tb_avaliador"].select("co_seq_avaliador", "nm_avaliador"), "co_seq_avaliador")
        .groupBy("nm_avaliador", "nu_ano_avaliacao")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("k").alias("k"))
    )
    if every_year:
        named = named.withColumn("low", F.when(above("s", "k"), 0).otherwise(1))
    else:
        named = named.withColumn("low", F.lit(0))
    people = named.groupBy("nm_avaliador").agg(
        F.sum("n").alias("qt_pareceres"), F.sum("s").alias("s"), F.sum("k").alias("k"),
        F.count("nu_ano_avaliacao").alias("anos_distintos"), F.sum("low").alias("low"))
    return (
        people.filter(above("s", "k") & (F.col("anos_distintos") >= 3) & (F.col("low") == 0))
        .select("nm_avaliador", "qt_pareceres",
                half_up_mean(F.col("s"), F.col("k"), 2, 2).alias("nota_media"), "anos_distintos")
        .orderBy(F.desc("qt_pareceres"), "nm_avaliador")
        .transform(at_most(limit))
    )


def audit_volume(t: Tables) -> DataFrame:
    """Insert, change and delete counts per audited table and its share of the log."""
    def count_of(op: str, name: str):
        return F.count(F.when(F.col("au_tp_operacao") == op, 1)).alias(name)

    counts = t["au_operacao"].groupBy("au_nm_tabela").agg(
        count_of("I", "insercoes"), count_of("A", "alteracoes"), count_of("E", "exclusoes"),
        F.count("*").alias("total_tabela"))
    # One row per audited table reaches this window.
    whole = F.sum("total_tabela").over(Window.partitionBy())
    return counts.withColumn("perc_do_total", half_up_percent(F.col("total_tabela"), whole, 2)).orderBy(
        F.desc("total_tabela"), "au_nm_tabela")


def audit_sequence(t: Tables, limit: int | None = 30) -> DataFrame:
    """The first operations of the log by table and time, numbered per table.

    The kept rows are a prefix of each table's history, so they hold every row
    that a number depends on; totals come from a count per table.
    """
    log = t["au_operacao"].select("au_nm_tabela", "au_tp_operacao", "au_dt_operacao", "co_seq_auditoria")
    known = log.filter(F.col("au_nm_tabela").isNotNull())
    in_time = [("au_dt_operacao", False), ("co_seq_auditoria", False)]
    totals = log.groupBy("au_nm_tabela").agg(F.count("*").alias("total_na_tabela"))
    return (
        top_numbered(known, in_time, limit, "seq_evento", ["au_nm_tabela"])
        .join(totals, "au_nm_tabela")
        .select("au_nm_tabela", "au_tp_operacao", F.to_date("au_dt_operacao").alias("dia"),
                "total_na_tabela", "seq_evento")
        .orderBy("au_nm_tabela", "seq_evento")
    )


def program_totals(t: Tables) -> DataFrame:
    """Graduates, projects and linked faculty per program id; programs without graduates are left out."""
    graduates = rows_per_program(t["tb_egresso"].select("co_seq_programa"), "egressos")
    projects = rows_per_program(t["tb_projeto_pesquisa"].select("co_seq_programa"), "p")
    faculty = t["rt_programa_docente"].select("co_seq_programa", "co_seq_docente").distinct()
    return (
        programs_in_areas(t).select("co_seq_programa")
        .join(graduates, "co_seq_programa")
        .join(projects, "co_seq_programa", "left")
        .join(rows_per_program(faculty, "d"), "co_seq_programa", "left")
        .select("co_seq_programa", "egressos", F.coalesce("p", F.lit(0)).alias("projetos"),
                F.coalesce("d", F.lit(0)).alias("docentes"))
    )


def program_overview(t: Tables, limit: int | None = 25) -> DataFrame:
    """The largest programs by graduates, with projects and faculty."""
    top = program_totals(t).join(programs_with_area_name(t), "co_seq_programa").orderBy(
        F.desc("egressos"), "co_seq_programa").transform(at_most(limit))
    return top.select("nm_programa", "nm_area", "egressos", "projetos", "docentes")


def top_decile_indicators(t: Tables, limit: int | None = 30) -> DataFrame:
    """Programs in the top decile of each indicator type in the last year.

    ``cume_dist >= 0.9`` is read from the top: at most a tenth of the type's
    rows may lie above. Equal values share their position.
    """
    last_year = t["tb_indicador"].agg(F.max("nu_ano_referencia")).scalar()
    rows = (
        t["tb_indicador"].filter(F.col("nu_ano_referencia") == last_year)
        .join(t["tb_programa"].select("co_seq_programa", "nm_programa"), "co_seq_programa")
        .select("tp_indicador", "nm_programa", "vl_indicador")
    )
    known = rows.filter(F.col("vl_indicador").isNotNull())
    # Nulls sort last in the ascending distribution, so they are the top of it.
    missing = rows.groupBy("tp_indicador").agg(
        F.count("*").alias("all_rows"), F.count(F.when(F.col("vl_indicador").isNull(), 1)).alias("nulls"))
    best = top_values(known, "vl_indicador", ["tp_indicador"], limit).drop("total")
    unknown = missing.filter(F.col("nulls") > 0).select(
        "tp_indicador", F.lit(None).cast(rows.schema["vl_indicador"].dataType).alias("vl_indicador"),
        F.col("nulls").alias("peers"), (-F.col("nulls")).alias("above"))
    not_above = F.col("all_rows") - F.col("nulls") - F.col("above")
    places = best.unionByName(unknown).join(missing, "tp_indicador").filter(not_above * 10 >= F.col("all_rows") * 9)
    same = (F.col("r.tp_indicador") == F.col("q.tp_indicador")) & F.col("r.vl_indicador").eqNullSafe(
        F.col("q.vl_indicador"))
    return (
        rows.alias("r").join(places.alias("q"), same)
        .orderBy("r.tp_indicador", F.col("r.vl_indicador").desc_nulls_first(), "nm_programa")
        .transform(at_most(limit))
        .select("r.tp_indicador", "nm_programa",
                half_up_mean(F.col("r.vl_indicador"), F.lit(1), 4, 2).alias("valor"),
                half_up(not_above, F.col("all_rows"), 3).alias("distribuicao"))
    )
