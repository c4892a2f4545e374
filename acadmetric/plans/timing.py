"""Summaries of a table of timings (phase, query, milliseconds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.functions.exact import half_up, half_up_mean
from acadmetric.plans.parts import Tables


def timing_summary(t: Tables) -> DataFrame:
    """Runs, mean, sample deviation, minimum and maximum per phase and query."""
    return (
        t["bench_resultado"].groupBy("et_fase", "co_consulta")
        .agg(
            F.count("*").alias("execucoes"),
            F.sum("vl_tempo_ms").alias("s"),
            F.round(F.stddev_samp("vl_tempo_ms"), 3).alias("desvio_ms"),
            F.min("vl_tempo_ms").cast("double").alias("min_ms"),
            F.max("vl_tempo_ms").cast("double").alias("max_ms"),
        )
        .select("et_fase", "co_consulta", "execucoes",
                half_up_mean(F.col("s"), F.col("execucoes"), 3, 3).alias("media_ms"),
                "desvio_ms", "min_ms", "max_ms")
        .orderBy("et_fase", "co_consulta")
    )


def timing_speedup(t: Tables, before: str = "BASELINE", after: str = "INDEXADO") -> DataFrame:
    """Mean time before and after per query, and their quotient.

    One conditional aggregate in place of joining every run of one phase with
    every run of the other, which leaves the means as they are.
    """
    def total(phase: str, name: str):
        return F.sum(F.when(F.col("et_fase") == phase, F.col("vl_tempo_ms"))).alias(name)

    def runs(phase: str, name: str):
        return F.count(F.when(F.col("et_fase") == phase, 1)).alias(name)

    sums = (
        t["bench_resultado"].groupBy("co_consulta")
        .agg(total(before, "s1"), runs(before, "n1"), total(after, "s2"), runs(after, "n2"))
        .filter((F.col("n1") > 0) & (F.col("n2") > 0))
    )
    whole = "decimal(38,0)"
    upper = (F.col("s1") * 1000).cast(whole) * F.col("n2")
    lower = (F.col("s2") * 1000).cast(whole) * F.col("n1")
    return sums.select(
        "co_consulta",
        half_up_mean(F.col("s1"), F.col("n1"), 3, 3).alias("baseline_ms"),
        half_up_mean(F.col("s2"), F.col("n2"), 3, 3).alias("indexado_ms"),
        half_up(upper, lower, 2).alias("speedup"),
    ).orderBy(F.desc_nulls_first("speedup"), "co_consulta")
