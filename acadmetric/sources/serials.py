"""Surrogate keys that go on over several loads.

A sequence is a folder of reservations. A load first reserves as many numbers as it has rows, then numbers them by prefix sums of
ranges and writes them. A reservation is one file named by the number it follows and created only if it is not there, so of two
writers that read the same end one fails and reads again. Numbers of a load that fails afterwards stay reserved: no number is given
twice, and a gap says that a load failed, as with the sequence of a database.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.operators.ordered import Key, row_numbers
from acadmetric.session import written
from acadmetric.sources.tables import append

_PREFIX = "after-"


def _store(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def last_number(spark: SparkSession, path: str, patience: float = 5.0) -> int:
    """The last number that a sequence has given away; 0 for a new one."""
    store, folder = _store(spark, path)
    if not store.exists(folder):
        return 0
    names = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith(_PREFIX)]
    if not names:
        return 0
    newest = max(names, key=lambda p: p.getName())
    until = time.monotonic() + patience
    while True:
        stream = store.open(newest)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        if text.endswith("\n"):
            return int(text)
        if time.monotonic() > until:
            raise RuntimeError(f"{newest.getName()} in {path} was begun and not finished: no row has a number of it, remove it")
        time.sleep(0.05)


def reserve(spark: SparkSession, path: str, count: int, attempts: int = 100) -> int:
    """Reserve ``count`` numbers and return the first."""
    store, _ = _store(spark, path)
    for _ in range(attempts):
        last = last_number(spark, path)
        if not count:
            return last + 1
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{_PREFIX}{last:019d}")
        try:
            out = store.create(place, False)
        except Py4JJavaError as error:
            if "exist" not in str(error.java_exception).lower():
                raise
            continue  # another writer was first
        out.write(bytearray(f"{last + count}\n".encode()))
        out.close()
        return last + 1
    raise RuntimeError(f"no numbers of {path} after {attempts} attempts")


def append_numbered(df: DataFrame, table: str, sequence: str, name: str, order: Sequence[Key]) -> DataFrame:
    """Append the rows of ``df``, numbered in the order of ``order`` (unique) from the sequence's next number on, as column ``name``.

    The rows are written once before they are counted, so what is counted is what is numbered. No row reserves nothing.
    """
    spark = df.sparkSession
    rows = written(df, "unnumbered")
    first = reserve(spark, sequence, rows.count())
    numbered = row_numbers(rows, order, name).withColumn(name, F.col(name) + (first - 1)).select(name, *df.columns)
    return append(numbered, table)
