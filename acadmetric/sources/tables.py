"""Read and write evaluation tables with declared types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.schema import TABLES
from acadmetric.session import dealt, remember_table


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One evaluation table; types come from the schema, never from inference."""
    return spark.read.schema(TABLES[name].struct).parquet(f"{folder}/{name}")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """The evaluation tables below ``folder``, read lazily."""
    return {name: read_table(spark, folder, name) for name in names}


def active(df: DataFrame) -> DataFrame:
    """Rows not logically deleted."""
    return df.filter(F.col("st_registro_ativo") == "S")


def append(df: DataFrame, path: str) -> DataFrame:
    """Add rows to a stored table and return the table."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace(df: DataFrame, path: str) -> DataFrame:
    """Replace a stored table, so that loading twice equals loading once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_writer(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the earliest by ``order``.

    ``min_by`` keeps one candidate per key before the shuffle, so a key that
    repeats in a third of the rows costs one row per task. ``order`` has to
    decide between any two rows of a key.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    rank = F.struct(*order)
    winner = F.min_by(F.struct(*rest), rank).alias("_row")
    return df.groupBy(*key).agg(winner).select(*key, "_row.*").select(*df.columns)


def insert_ignore(target: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of ``incoming`` that an insert skipping existing keys would add.

    Rows already in ``target`` win; inside ``incoming`` the earliest by
    ``order`` wins. Write the result in append mode.
    """
    fresh = first_writer(incoming, key, order)
    return fresh.join(target.select(*key), list(key), "left_anti")


def lay_out_by_key(df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int | None) -> DataFrame:
    """Store ``df`` for later joins on the columns of ``key``.

    With ``buckets`` the table is bucketed and sorted on the key, so joins on it need no shuffle; a bucket is read by one
    task, so this is the layout for keys without a dominant value. With ``buckets=None`` it is sorted only: joins shuffle,
    and adaptive execution splits a large key. The rebalance hint splits a large key over several writers in both. The
    caller chooses; nothing depends on the data. ``session.drop_written`` drops the table with the application's files.
    """
    spread = df.hint("rebalance", *key)
    writer = spread.write.bucketBy(buckets, *key).sortBy(*key) if buckets else spread.sortWithinPartitions(*key).write
    writer.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)
    remember_table(df.sparkSession, table)
    return df.sparkSession.table(table)


def store_subset(df: DataFrame, keep: Column, partition_by: str, path: str) -> DataFrame:
    """Store only rows that satisfy ``keep``, one folder per value of a code column."""
    kept = df.filter(keep)
    # The writer sorts a task's rows by the code: every code is dealt over many tasks, so that none sorts a code's whole share.
    dealt(kept, F.xxhash64(*kept.columns)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)
