"""Stored tables that are read in part: clustered on one key or on several columns, with the bounds of every file.

Beside the files lies ``_bounds``, one row per file: its name, its rows, the smallest and the largest value of each column the
table is clustered on, and of the whole key. A reader that knows bounds opens the files that may hold what it looks for; the
driver compares bounds of files, as many as Spark lists for any table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.operators.ordered import ranged
from acadmetric.session import written
from acadmetric.sources.tables import first_writer

# Ranges in which the keys of an insert are compared with the bounds of files.
INTERVALS = 256


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """One number from several of ``bits`` bits each: highest bits of all first, so near numbers are near in every one."""
    width = len(places)
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, place in enumerate(places):
            own = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total + F.shiftleft(own, bit * width + width - 1 - i)
    return total


def store_interleaved(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6,
                      bloom: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` in ``files`` files so that a filter on any of ``columns`` needs few of them.

    Each column is cut into 2^bits ranges of about as many rows; a row's place is the interleaved bits of its ranges. Equal
    places are parted by a hash of the row, so a combination that a third of the rows share fills several files. Columns
    in ``bloom`` get Bloom filters, by which a reader skips row groups that lack a value inside their bounds.
    """
    placed = df
    for i, c in enumerate(columns):
        placed = ranged(placed, [(c, False)], 1 << bits, f"_place_{i}")
    z = interleaved([F.col(f"_place_{i}") for i in range(len(columns))], bits)
    rows = placed.withColumn("_z", z).drop(*[f"_place_{i}" for i in range(len(columns))])
    dealt = rows.repartitionByRange(files, "_z", F.xxhash64(*df.columns)).sortWithinPartitions("_z", *columns).drop("_z")
    return _stored(dealt, path, columns, bloom)


def store_ordered(df: DataFrame, path: str, key: Sequence[str], files: int) -> DataFrame:
    """Store ``df`` in the order of ``key``: every file holds one range of it."""
    return _stored(df.repartitionByRange(files, *key).sortWithinPartitions(*key), path, key, ())


def _stored(df: DataFrame, path: str, columns: Sequence[str], bloom: Sequence[str]) -> DataFrame:
    spark, before = df.sparkSession, set(file_names(df.sparkSession, path))
    writer = df.write.mode("append")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    added = [f"{path}/{name}" for name in file_names(spark, path) if name not in before]
    if added:
        _bounds_of(spark.read.schema(df.schema).parquet(*added), columns).coalesce(1).write.mode("append").parquet(f"{path}/_bounds")
    return spark.read.schema(df.schema).parquet(path)


def _bounds_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    key = F.struct(*columns)
    sides = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("low", F.min), ("high", F.max))]
    return rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), *sides, F.min(key).alias("low"), F.max(key).alias("high"))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The data files of a stored table; none where there is no table yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    names = (f.getPath().getName() for f in store.listStatus(place) if f.isFile())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def bounds(spark: SparkSession, path: str) -> DataFrame:
    """file, rows, low_<column>, high_<column> of each clustering column, low and high of the key as structs."""
    return spark.read.parquet(f"{path}/_bounds")


def _some_files(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def read_between(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """The rows with ``low <= column <= high``, from the files whose bounds meet that range."""
    meets = (F.col(f"low_{column}") <= F.lit(high)) & (F.col(f"high_{column}") >= F.lit(low))
    names = [r.file for r in bounds(spark, path).filter(meets).select("file").collect()]
    return _some_files(spark, path, names).filter(F.col(column).between(F.lit(low), F.lit(high)))


def files_with(spark: SparkSession, path: str, keys: DataFrame, key: Sequence[str]) -> list[str]:
    """The files whose range of keys meets one of the ranges that ``keys`` fall into.

    The keys are cut into at most INTERVALS ranges; their ends and the bounds of files meet on the driver. Keys with a missing
    part equal nothing.
    """
    known = keys.select(*key).dropna()
    spans = ranged(known, [(c, False) for c in key], INTERVALS).groupBy("_range").agg(
        F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).collect()
    ends = sorted((tuple(s.low), tuple(s.high)) for s in spans)
    highs = [high for _, high in ends]
    found = []
    for r in bounds(spark, path).filter("low IS NOT NULL").select("file", "low", "high").collect():
        low, high = tuple(r.low), tuple(r.high)
        if None in low or None in high:  # not comparable here; Spark decides
            found.append(r.file)
            continue
        at = bisect_left(highs, low)  # the first range that does not end before the file begins
        if at < len(ends) and ends[at][0] <= high:
            found.append(r.file)
    return found


def insert_ignore_ordered(spark: SparkSession, path: str, incoming: DataFrame, key: Sequence[str], order: Sequence[str],
                          files: int = 1) -> DataFrame:
    """Add the rows of ``incoming`` whose key a table stored in key order does not hold yet; the table as it is then.

    Stored rows win; inside ``incoming`` the earliest by ``order`` wins. Only the files that may hold an incoming key are
    read, and of those only the key. One writer at a time: two inserts at once could both add a key.
    """
    columns = spark.read.parquet(path).columns
    fresh = written(first_writer(incoming, key, order), "fresh")
    held = _some_files(spark, path, files_with(spark, path, fresh, key)).select(*key)
    added = fresh.join(held, list(key), "left_anti").select(*columns)
    return store_ordered(added, path, key, files)
