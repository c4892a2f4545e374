"""Declared data rules as jobs: each finds the rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acadmetric.schema import Table


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary keys that repeat or miss a part, with their number of rows.

    The count per key starts inside each task, so a key that repeats in a
    third of the rows reaches the shuffle once per task.
    """
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).filter(missing | (F.col("row_count") > 1))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Natural keys that repeat; rows with a missing part do not compete."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(
        F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def reference_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign key values without a parent, with their number of rows; a missing reference is allowed.

    Values are counted before the anti-join, so a frequent value joins once.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    return used.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def outside_domain(column: str, codes: Sequence[str]) -> Column:
    """A code outside its closed list; a missing code passes."""
    return ~F.col(column).isin(*codes)


def outside_range(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    if low is None:
        return value > high
    if high is None:
        return value < low
    return ~value.between(low, high)


def ends_before_start(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def longer_than(column: str, length: int) -> Column:
    return F.length(column) > length


def row_rules(table: Table) -> list[tuple[str, str, Column]]:
    """(kind, rule, broken?) for every rule one row can break by itself.

    A rule that cannot be decided because a value is missing is not broken.
    """
    rules = [("required", c.name, F.col(c.name).isNull()) for c in table.columns if c.required]
    rules += [("check", f"{c} domain", outside_domain(c, codes)) for c, codes in table.domains.items()]
    rules += [("check", f"{c} range", outside_range(c, *bounds)) for c, bounds in table.ranges.items()]
    rules += [("check", f"{end} period", ends_before_start(start, end)) for start, end in table.periods]
    rules += [("length", c.name, longer_than(c.name, c.max_length)) for c in table.columns if c.max_length]
    return [(kind, rule, F.coalesce(broken, F.lit(False))) for kind, rule, broken in rules]


def with_broken_rules(df: DataFrame, table: Table) -> DataFrame:
    """Add ``broken_rules``: accepted rows have an empty list, rejected rows name what they break."""
    flags = [F.when(broken, F.lit(f"{kind}: {rule}")) for kind, rule, broken in row_rules(table)]
    return df.withColumn("broken_rules", F.array_compact(F.array(*flags)))


def rule_violations(tables: Mapping[str, DataFrame], table: Table) -> DataFrame:
    """(tabela, tipo, regra, violacoes) for every declared rule of one table."""
    df = tables[table.name]
    rules = row_rules(table)
    # One pass decides all row rules.
    counts = df.agg(*[F.count(F.when(broken, 1)).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)])
    listed = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("tipo"), F.lit(rule).alias("regra"), F.col(f"r{i}").alias("violacoes"))
        for i, (kind, rule, _) in enumerate(rules)])).alias("v")
    parts = [counts.select(listed).select("v.*")]

    def total(violations: DataFrame, kind: str, rule: str, rows: Column) -> DataFrame:
        found = violations.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("violacoes"))
        return found.select(F.lit(kind).alias("tipo"), F.lit(rule).alias("regra"), "violacoes")

    if table.key:
        parts.append(total(key_violations(df, table.key), "pk", ",".join(table.key), F.col("row_count")))
    for column in table.unique:
        parts.append(total(unique_violations(df, [column]), "unique", column, F.col("row_count")))
    for column, (parent, parent_column) in table.references.items():
        found = reference_violations(df, column, tables[parent], parent_column)
        parts.append(total(found, "fk", column, F.col("row_count")))
    found = reduce(DataFrame.unionByName, parts)
    return found.select(F.lit(table.name).alias("tabela"), "tipo", "regra", "violacoes")


RULE_KINDS = ("pk", "fk", "unique", "check", "required", "length")


def rule_counts(violations: DataFrame) -> DataFrame:
    """One row per table with the violations of each kind of rule side by side."""
    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("tipo") == kind, F.col("violacoes"))), F.lit(0)).alias(kind)

    return violations.groupBy("tabela").agg(*[of(kind) for kind in RULE_KINDS]).orderBy("tabela")


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(coluna, total, preenchidas): how many rows fill each column, all in one pass."""
    counts = df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)])
    listed = F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"c{i}").alias("preenchidas")) for i, c in enumerate(columns)]))
    return counts.select("total", listed.alias("v")).select("v.coluna", "total", "v.preenchidas")


def completeness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, coluna, total, preenchidas) for every column of every table; each table is read once."""
    parts = [filled_counts(df, df.columns).select(F.lit(name).alias("tabela"), "coluna", "total", "preenchidas")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [df.agg(F.count("*").alias("total")).select(F.lit(name).alias("tabela"), "total")
              for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts).orderBy("tabela")
