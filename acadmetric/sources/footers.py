"""Counts and bounds of stored tables from the footers of their files.

A Parquet footer holds each column's rows, missing values and, for numbers and dates, its smallest and largest value. Spark's second
data source interface answers aggregates of these without reading a data page; it is on in a session of its own that shares the
context, so nobody else's settings change. What footers cannot answer (a filter on data, texts, timestamps) is counted as ever, by
the same expression.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Types whose bounds Spark reads from footers.
BOUNDED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` in which aggregates over Parquet come from footers; its frames are used by themselves."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    beside.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return beside


def read_for_footers(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Tables by name, to be aggregated by the functions below."""
    beside = footer_session(spark)
    return {name: beside.read.parquet(path) for name, path in paths.items()}


def star_paths(folder: str, names: Sequence[str]) -> dict[str, str]:
    return {name: posixpath.join(folder, f"{name}.parquet") for name in names}


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, coluna, total, preenchidas, menor, maior) of the top-level columns of every table.

    ``menor`` and ``maior`` are numbers as doubles, for columns whose bounds footers hold; null for others.
    """
    parts = []
    for name, df in tables.items():
        kinds = {c: k for c, k in df.dtypes if not k.startswith(("array", "map", "struct"))}
        bounded = [c for c, k in kinds.items() if k in BOUNDED and k not in ("date", "boolean")]
        found = df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(kinds)],
                       *[f(c).alias(f"{side}_{c}") for c in bounded for side, f in (("low", F.min), ("high", F.max))])

        def bound(side: str, c: str, known: list[str] = bounded):
            return (F.col(f"{side}_{c}") if c in known else F.lit(None)).cast("double")

        listed = F.explode(F.array(*[
            F.struct(F.lit(c).alias("coluna"), "total", F.col(f"n_{i}").alias("preenchidas"), bound("low", c).alias("menor"),
                     bound("high", c).alias("maior")) for i, c in enumerate(kinds)])).alias("v")
        parts.append(found.select(listed).select(F.lit(name).alias("tabela"), "v.*"))
    return reduce(DataFrame.unionByName, parts)
