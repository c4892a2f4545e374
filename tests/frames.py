"""What the tests do with frames. No conftest: two of those may be loaded at once, under one module name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
