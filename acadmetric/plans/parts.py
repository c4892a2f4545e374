"""Building blocks shared by several reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.operators.bridge import distinct_items, set_counts

Tables = Mapping[str, DataFrame]


def at_most(limit: int | None) -> Callable[[DataFrame], DataFrame]:
    """The first ``limit`` rows, or all of them."""
    return lambda df: df if limit is None else df.limit(limit)


def programs_in_areas(t: Tables) -> DataFrame:
    """Programs with id, name and area, for areas that exist."""
    programs = t["tb_programa"].select("co_seq_programa", "nm_programa", "co_seq_area")
    return programs.join(t["tb_area_avaliacao"].select("co_seq_area"), "co_seq_area", "left_semi")


def programs_with_area_name(t: Tables) -> DataFrame:
    programs = t["tb_programa"].select("co_seq_programa", "nm_programa", "co_seq_area")
    return programs.join(t["tb_area_avaliacao"].select("co_seq_area", "nm_area"), "co_seq_area")


def known_authorships(t: Tables) -> DataFrame:
    """(output, faculty) pairs whose output exists."""
    pairs = t["rt_producao_docente"].select("co_seq_producao", "co_seq_docente")
    return pairs.join(t["tb_producao_cientifica"].select("co_seq_producao"), "co_seq_producao", "left_semi")


def outputs_per_program(t: Tables, heavy: int = 0) -> DataFrame:
    """Distinct known outputs per program id, through the faculty linked to it.

    ``heavy`` members with the most pairs are counted apart (see ``distinct_items``); worth its longer plan only where members may
    hold a large share of the links and of the authorships both.
    """
    links = t["rt_programa_docente"]
    if heavy:
        counts = distinct_items(links, known_authorships(t), "co_seq_docente", "co_seq_programa", "co_seq_producao", heavy)
    else:
        counts = set_counts(links, t["rt_producao_docente"], "co_seq_docente", "co_seq_programa", "co_seq_producao", t["tb_producao_cientifica"])
    return counts.withColumnRenamed("items", "qt_prod")


def outputs_and_authors(t: Tables) -> DataFrame:
    """Distinct known outputs and linked faculty with at least one, per program id, in one pass."""
    counts = set_counts(t["rt_programa_docente"], t["rt_producao_docente"], "co_seq_docente", "co_seq_programa", "co_seq_producao",
                        t["tb_producao_cientifica"], members=True)
    return counts.withColumnsRenamed({"items": "qt_prod", "members": "qt_doc"})


def rows_per_program(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("co_seq_programa").agg(F.count("*").alias(name))
