"""Small tables for any schema: every value follows from what ``schema.TABLES`` declares about its column.

Domains give codes, references give keys of rows already made, ranges give numbers, periods give dates, unique columns and
keys give numbers that do not repeat. A third of all references go to the first row of their parent, optional values are
missing now and then, and names come in pairs, so that different rows share them.
"""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from acadmetric.schema import TABLES, Column, Table
from acadmetric.sources.tables import replace

FIRST_DAY, DAYS, FIRST_YEAR, YEARS = date(2017, 3, 7), 2100, 2017, 6
# Rows of tables whose size matters to the reports; every other table has ``OTHERS``.
ROWS = {"tb_area_avaliacao": 7, "tb_programa": 23, "tb_docente": 70, "tb_avaliador": 12, "tb_parecer": 400}
OTHERS = 150


class Maker:
    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)
        self.rows: dict[str, list[dict]] = {}

    def _number(self, column: Column, bounds: tuple[float | None, float | None]) -> Decimal | int:
        if isinstance(column.type, T.DecimalType):
            low = bounds[0] or 0
            high = bounds[1] if bounds[1] is not None else low + 10 ** min(6, column.type.precision - column.type.scale - 1)
            unit = Decimal(1).scaleb(-column.type.scale)
            return (Decimal(str(low)) + Decimal(str(high - low)) * Decimal(self.draw.randrange(1001)) / 1000).quantize(unit)
        if bounds == (None, None):
            return FIRST_YEAR + self.draw.randrange(YEARS)
        return self.draw.randint(int(bounds[0] or 0), int(bounds[1] or 99))

    def _value(self, table: Table, column: Column, n: int, begun: dict):
        name = column.name
        if not column.required and self.draw.randrange(6) == 0:
            return None
        if name in table.references:
            parent, key = table.references[name]
            made = self.rows[parent]
            return made[0 if self.draw.randrange(3) == 0 else self.draw.randrange(len(made))][key]
        if name in table.key:
            return n
        if name in table.unique:
            return str(n).rjust(min(column.max_length, 11), "0")
        if name in table.domains:
            return self.draw.choice(table.domains[name])
        if isinstance(column.type, T.DateType):
            start = next((begun[a] for a, b in table.periods if b == name and begun.get(a)), None)
            return start + timedelta(self.draw.randrange(400)) if start else FIRST_DAY + timedelta(self.draw.randrange(DAYS))
        if isinstance(column.type, T.StringType):
            return f"{name} {n // 2}"[-(column.max_length or 99):]
        return self._number(column, table.ranges.get(name, (None, None)))

    def fill(self, table: Table) -> None:
        rows, keys = [], set()
        for n in range(1, ROWS.get(table.name, OTHERS) + 1):
            row: dict = {}
            for column in table.columns:
                row[column.name] = self._value(table, column, n, row)
            key = tuple(row[c] for c in table.key)
            if key not in keys:
                keys.add(key)
                rows.append(row)
        self.rows[table.name] = rows


def frames(spark: SparkSession, seed: int = 1) -> dict[str, DataFrame]:
    """The tables that reference each other, parents first (the schema lists them in that order)."""
    maker = Maker(seed)
    out = {}
    for name, table in TABLES.items():
        if name[:2] in ("tb", "rt"):
            maker.fill(table)
            out[name] = spark.createDataFrame([tuple(r.values()) for r in maker.rows[name]], table.struct)
    return out


def load(spark: SparkSession, folder: str, seed: int = 1) -> None:
    for table, df in frames(spark, seed).items():
        replace(df, f"{folder}/{table}")
