from __future__ import annotations

import datetime as dt
from decimal import Decimal

from frames import rows

from acadmetric.operators import quality
from acadmetric.schema import TABLES


def test_schema_holds_the_declared_rules():
    assert len(TABLES) == 20
    assert sum(1 for t in TABLES.values() if t.key) == 19
    assert sum(len(t.unique) for t in TABLES.values()) == 7
    assert sum(len(t.references) for t in TABLES.values()) == 19
    assert sum(len(t.domains) + len(t.ranges) + len(t.periods) for t in TABLES.values()) == 28
    assert [len(t.key) for t in TABLES.values() if t.name.startswith("rt_")] == [2, 2, 2]


def test_keys_repeat_or_miss_a_part(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (2, None), (2, None)], "a int, b int")
    assert sorted(rows(quality.key_violations(df, ["a", "b"])), key=str) == [(1, 1, 2), (2, None, 2), (None, 3, 1)]
    assert rows(quality.unique_violations(df, ["a", "b"])) == [(1, 1, 2)]


def test_missing_reference_is_allowed(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "f int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.reference_violations(child, "f", parent, "id")) == [(2, 2)]


def project(spark):
    day = dt.date
    return spark.createDataFrame([
        (1, "ok", None, None, 1, day(2020, 1, 1), None, "AT", "S"),
        (2, "x" * 301, "CNPq", Decimal("-1.00"), 9, day(2020, 1, 2), day(2020, 1, 1), "XX", "S"),
        (2, "ok", "CNPq", Decimal("1.00"), 1, None, day(2020, 1, 1), "CO", "N"),
    ], "co_seq_projeto int, nm_projeto string, ds_financiador string, vl_financiamento decimal(15,2), "
       "co_seq_programa int, dt_inicio date, dt_fim date, tp_status string, st_registro_ativo string")


def test_rules_of_one_table(spark):
    table = TABLES["tb_projeto_pesquisa"]
    programs = spark.createDataFrame([(1,)], "co_seq_programa int")
    found = quality.rule_violations({"tb_projeto_pesquisa": project(spark), "tb_programa": programs}, table)
    broken = {(r.tipo, r.regra): r.violacoes for r in found.collect() if r.violacoes}
    assert broken == {
        ("pk", "co_seq_projeto"): 2, ("fk", "co_seq_programa"): 1, ("check", "tp_status domain"): 1,
        ("check", "vl_financiamento range"): 1, ("check", "dt_fim period"): 1, ("required", "dt_inicio"): 1,
        ("length", "nm_projeto"): 1}
    assert rows(quality.rule_counts(found)) == [("tb_projeto_pesquisa", 2, 1, 0, 3, 1, 1)]


def test_accepted_and_rejected_make_the_input(spark):
    marked = quality.with_broken_rules(project(spark), TABLES["tb_projeto_pesquisa"])
    accepted, rejected = marked.filter("size(broken_rules) = 0"), marked.filter("size(broken_rules) > 0")
    assert (accepted.count(), rejected.count()) == (1, 2)
    assert rejected.filter("co_seq_programa = 1").first().broken_rules == ["required: dt_inicio"]


def test_filled_counts_and_volumes(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(quality.filled_counts(df, ["a", "b"])) == [("a", 2, 2), ("b", 2, 1)]
    assert rows(quality.volumes({"z": df, "y": df.limit(1)})) == [("y", 1), ("z", 2)]
