"""What the document operators share: word hashes, column views, bounded samples of labelled rows."""

from __future__ import annotations

import posixpath
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(folder, f"{name}.parquet"))


def vocabulary_file(name: str) -> str:
    """The path of a public tokenizer's file, on whatever machine asks."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read; whatever else the rows carry cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def doc_batches(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of text, so that working arrays stay small."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        sizes = np.array([0 if x is None else x for x in pc.binary_length(text).to_pylist()], np.int64)
        group = np.cumsum(sizes + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of ``rows`` rows, so that only so many are Python objects at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def fold_of(doc_id: int | None, folds: int) -> int:
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


_BINS = 64


def sample_ids(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """The ``per_class`` rows (doc_id, label) of each class that come first by a hash of their id, whatever the number of classes.

    Rows are taken from that part of the hashes in which about four times as many of their class lie. Its bins are counted:
    those wholly among the first are taken as they are, only the one at the border is put in order. So no task gets more rows as
    a class grows. The result is bounded by the number of classes times ``per_class``.
    """
    rows = labelled.select("doc_id", F.col(label).cast("string").alias("label")).dropna().withColumn("place", F.xxhash64("doc_id"))
    counts = rows.groupBy("label").count().filter(F.col("count") > 4 * per_class).collect()
    spread = F.lit(1.0)
    if counts:
        shares = F.create_map(*[x for r in counts for x in (F.lit(r[0]), F.lit(4.0 * per_class / r[1]))])
        spread = F.coalesce(shares[F.col("label")], spread)
    at = (F.col("place").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64) / spread * _BINS
    # As a double the largest hashes are 2 ** 63, so a class that is taken from all hashes has one bin more.
    rows = rows.withColumn("bin", F.floor(at)).filter((F.col("bin") < _BINS) | (spread == 1.0))
    before = Window.partitionBy("label").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # one row per bin
    bins = rows.groupBy("label", "bin").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    some = rows.join(F.broadcast(bins.filter(F.col("before") < per_class)), ["label", "bin"])  # _BINS rows a class
    border = some.filter(F.col("before") + F.col("n") > per_class)
    first = border.withColumn("row", F.row_number().over(Window.partitionBy("label").orderBy("place", "doc_id"))).filter(
        F.col("row") <= F.lit(per_class) - F.col("before"))
    whole = some.filter(F.col("before") + F.col("n") <= per_class)
    return whole.select("doc_id", "label").union(first.select("doc_id", "label")).distinct()


def keep_rows(docs: DataFrame, decide: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows whose text ``decide`` keeps, with all their columns, where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1 << 19):
            yield batch.filter(pa.array(decide(utf8(batch.column(batch.schema.get_field_index("text")))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
