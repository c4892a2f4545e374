"""The evaluation schema as logical views over the star-schema test tables.

Each view carries the column names of the evaluation schema, so a report runs
unchanged on these views and on stored evaluation tables. Nothing is computed
until a report uses a view.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.session import dealt
from acadmetric.sources.driver import StarTables


def _code(column: str, codes: dict[str, str], default: str | None = None) -> Column:
    first, *others = codes.items()
    chain = F.when(F.col(column) == first[0], first[1])
    for value, code in others:
        chain = chain.when(F.col(column) == value, code)
    return chain.otherwise(F.lit(default))


def _areas(s: StarTables) -> DataFrame:
    return s.region.select(F.col("r_regionkey").alias("co_seq_area"), F.col("r_name").alias("nm_area"))


def _nation_areas(s: StarTables) -> DataFrame:
    return s.nation.select(F.col("n_nationkey").alias("co_seq_area"), F.col("n_name").alias("nm_area"))


def _institutions(s: StarTables) -> DataFrame:
    return s.nation.select(
        F.col("n_nationkey").alias("co_seq_instituicao"), F.col("n_name").alias("nm_instituicao"))


def _region_of(s: StarTables, nation: str) -> Column:
    """The region of a nation by a map of the code list of nations.

    Programs are one plain scan that way: their size is known to the planner, and nobody who reads only names looks anything up.
    """
    regions = s.nation.agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_regionkey")))).scalar()
    return F.try_element_at(regions, F.col(nation))


def _programs(s: StarTables) -> DataFrame:
    slot = F.col("s_suppkey") % 6
    level = F.when(slot == 0, "DO").when(slot <= 2, "MP").otherwise("ME")
    return s.supplier.select(
        F.col("s_suppkey").alias("co_seq_programa"),
        F.col("s_name").alias("nm_programa"),
        level.alias("tp_nivel"),
        F.col("s_nationkey").alias("co_seq_instituicao"),
        _region_of(s, "s_nationkey").alias("co_seq_area"),
    )


def _funded_programs(s: StarTables) -> DataFrame:
    return s.customer.select(
        F.col("c_custkey").alias("co_seq_programa"),
        F.col("c_name").alias("nm_programa"),
        F.col("c_nationkey").alias("co_seq_instituicao"),
        _region_of(s, "c_nationkey").alias("co_seq_area"),
    )


def _faculty(s: StarTables) -> DataFrame:
    return s.part.select(
        F.col("p_partkey").alias("co_seq_docente"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("nm_docente"),
    )


def _outputs(s: StarTables) -> DataFrame:
    return s.orders.select(
        F.col("o_orderkey").alias("co_seq_producao"),
        _code("o_orderstatus", {"F": "AR", "O": "LI", "P": "CA"}).alias("tp_producao"),
        _code("o_orderpriority", {"1-URGENT": "A1", "2-HIGH": "A2", "3-MEDIUM": "B1", "5-LOW": "B2"}).alias("ds_qualis"),
        F.year("o_orderdate").alias("nu_ano_publicacao"),
    )


def _links(s: StarTables) -> DataFrame:
    held = s.lineitem.filter((F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "F"))
    # The smallest flag as a number: the minimum of a text would sort the rows of each task.
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    kinds = F.when(F.col("flag") == 0, "PE").when(F.col("flag") == 1, "CO").otherwise("VI")
    pairs = held.select(F.col("l_suppkey").alias("co_seq_programa"), F.col("l_partkey").alias("co_seq_docente"), flag.alias("flag"))
    return (
        dealt(pairs, "co_seq_programa", "co_seq_docente").groupBy("co_seq_programa", "co_seq_docente")
        .agg(F.min("flag").alias("flag"))
        .select("co_seq_programa", "co_seq_docente", kinds.alias("tp_vinculo"))
    )


def _authorships(s: StarTables) -> DataFrame:
    pairs = s.lineitem.select(F.col("l_orderkey").alias("co_seq_producao"), F.col("l_partkey").alias("co_seq_docente"))
    return dealt(pairs, "co_seq_producao", "co_seq_docente").distinct()


def _students(s: StarTables) -> DataFrame:
    return s.lineitem.select(
        F.col("l_orderkey").alias("co_seq_discente"),
        F.col("l_suppkey").alias("co_seq_programa"),
        F.col("l_partkey").alias("co_seq_docente_orientador"),
        _code("l_returnflag", {"A": "ME"}, "DO").alias("tp_nivel"),
        _code("l_linestatus", {"O": "AT"}, "TI").alias("tp_status"),
    )


def _graduates(s: StarTables) -> DataFrame:
    return s.lineitem.filter(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("co_seq_egresso"), F.col("l_suppkey").alias("co_seq_programa"))


def _projects(s: StarTables) -> DataFrame:
    return s.orders.select(
        F.col("o_orderkey").alias("co_seq_projeto"),
        F.col("o_custkey").alias("co_seq_programa"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("vl_financiamento"),
    )


def _sponsored_projects(s: StarTables) -> DataFrame:
    funder = s.customer.select(F.col("c_custkey").alias("co_seq_programa"), F.col("c_mktsegment").alias("ds_financiador"))
    return _projects(s).join(funder, "co_seq_programa")


def _project_collaborations(s: StarTables) -> DataFrame:
    pairs = s.lineitem.select(F.col("l_orderkey").alias("co_seq_projeto"), F.col("l_suppkey").alias("co_seq_colaboracao"))
    return dealt(pairs, "co_seq_projeto", "co_seq_colaboracao").distinct()


def _collaborations(s: StarTables) -> DataFrame:
    return s.supplier.select(F.col("s_suppkey").alias("co_seq_colaboracao"))


def _indicators(s: StarTables) -> DataFrame:
    return (
        s.lineitem.groupBy(
            F.col("l_suppkey").alias("co_seq_programa"),
            F.year("l_shipdate").alias("nu_ano_referencia"),
            _code("l_returnflag", {"A": "PD", "N": "FE", "R": "II"}).alias("tp_indicador"),
        )
        # Sums of at most 18 digits stay in a machine word.
        .agg(F.sum(F.col("l_quantity").cast("decimal(8,4)")).alias("vl_indicador"))
    )


def _reports(s: StarTables) -> DataFrame:
    last_year = s.lineitem.agg(F.year(F.max("l_shipdate"))).scalar()
    per_year = s.lineitem.groupBy(
        F.col("l_suppkey").alias("co_seq_programa"), F.year("l_shipdate").alias("nu_ano_referencia")
    ).agg(F.count("*").alias("n"))
    return per_year.select(
        (F.col("co_seq_programa") * 10000 + F.col("nu_ano_referencia")).alias("co_seq_relatorio"),
        "co_seq_programa",
        "nu_ano_referencia",
        F.when(F.col("nu_ano_referencia") == last_year, "QU").otherwise("AN").alias("tp_relatorio"),
        F.nullif(F.col("n") % 8, F.lit(0)).alias("nu_conceito_final"),
    )


def _evaluators(s: StarTables) -> DataFrame:
    return s.customer.select(
        F.col("c_custkey").alias("co_seq_avaliador"),
        F.col("c_name").alias("nm_avaliador"),
        F.col("c_nationkey").alias("co_seq_area"),
    )


def _opinions(s: StarTables) -> DataFrame:
    lines = s.lineitem.select("l_orderkey", "l_suppkey", "l_discount", "l_shipdate")
    return lines.join(s.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("co_seq_parecer"),
        F.col("o_custkey").alias("co_seq_avaliador"),
        F.col("l_suppkey").alias("co_seq_programa"),
        F.year("l_shipdate").alias("nu_ano_avaliacao"),
        (F.col("l_discount") * 100).cast("decimal(4,2)").alias("vl_nota"),
    )


def _criteria(s: StarTables) -> DataFrame:
    return s.customer.select(
        F.col("c_custkey").alias("co_seq_criterio"),
        F.col("c_nationkey").alias("co_seq_area"),
        F.col("c_acctbal").cast("decimal(15,2)").alias("vl_peso"),
    )


def _audit(s: StarTables) -> DataFrame:
    ops = F.array(F.lit("I"), F.lit("A"), F.lit("E"))
    return s.events.select(
        F.col("event_id").alias("co_seq_auditoria"),
        F.col("ts").alias("au_dt_operacao"),
        F.element_at(ops, (F.col("event_id") % 3 + 1).cast("int")).alias("au_tp_operacao"),
        F.col("event_type").alias("au_nm_tabela"),
    )


def _timings(s: StarTables) -> DataFrame:
    day = F.dayofmonth("ts")
    return s.events.select(
        F.when(day <= 15, "BASELINE").otherwise("INDEXADO").alias("et_fase"),
        F.col("event_type").alias("co_consulta"),
        F.col("value").cast("decimal(12,3)").alias("vl_tempo_ms"),
    )


_BUILDERS: dict[str, Callable[[StarTables], DataFrame]] = {
    "tb_area_avaliacao": _areas,
    "tb_instituicao": _institutions,
    "tb_programa": _programs,
    "tb_docente": _faculty,
    "tb_producao_cientifica": _outputs,
    "rt_programa_docente": _links,
    "rt_producao_docente": _authorships,
    "tb_discente": _students,
    "tb_egresso": _graduates,
    "tb_projeto_pesquisa": _projects,
    "rt_projeto_colaboracao": _project_collaborations,
    "tb_colaboracao_internacional": _collaborations,
    "tb_indicador": _indicators,
    "tb_relatorio": _reports,
    "tb_avaliador": _evaluators,
    "tb_parecer": _opinions,
    "tb_criterio_avaliacao": _criteria,
    "au_operacao": _audit,
    "bench_resultado": _timings,
}


class EvaluationViews(Mapping[str, DataFrame]):
    """Table name -> DataFrame, built on first use and kept.

    ``overrides`` swaps the builder of a table, for the reports whose natural
    stand-in differs (funding reports use customers as programs).
    """

    def __init__(self, spark: SparkSession, folder: str,
                 overrides: Mapping[str, Callable[[StarTables], DataFrame]] | None = None) -> None:
        self._star = StarTables(spark, folder)
        self._builders = {**_BUILDERS, **(overrides or {})}
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self._star)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def evaluation_views(spark: SparkSession, folder: str) -> EvaluationViews:
    return EvaluationViews(spark, folder)


def funding_views(spark: SparkSession, folder: str) -> EvaluationViews:
    """Customers stand for programs, which is what orders (projects) refer to."""
    return EvaluationViews(spark, folder, {
        "tb_programa": _funded_programs, "tb_projeto_pesquisa": _projects})


def sponsor_views(spark: SparkSession, folder: str) -> EvaluationViews:
    """As ``funding_views``, with the funder of every project joined in."""
    return EvaluationViews(spark, folder, {
        "tb_programa": _funded_programs, "tb_projeto_pesquisa": _sponsored_projects})


def criteria_views(spark: SparkSession, folder: str) -> EvaluationViews:
    """Nations stand for areas, which gives more than five groups."""
    return EvaluationViews(spark, folder, {"tb_area_avaliacao": _nation_areas})
