"""Contiguous shards of near equal bytes from global prefix sums.

Rows are range-partitioned by doc_id; each partition sums its own sizes as it streams by. Only the totals of the partitions
meet in one place, where their prefix sums give each partition its base. A row's shard is the target that its middle byte
falls into, so shards are contiguous in doc_id and differ from the mean by less than one row's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadmetric.session import written


def byte_shards(docs: DataFrame, shards: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard (0 to ``shards`` - 1), slot (gapless from 0), and ``carry``.

    Size is the UTF-8 length of the text plus 8; a null text counts as empty. Rows without doc_id come first; rows that
    repeat a doc_id follow one another, by crc32 and size, and equal rows are interchangeable. An empty table gives no row.
    With fewer rows than shards some shards stay empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), *carry)
    rows = rows.repartitionByRange("doc_id", "text_crc32", "size").sortWithinPartitions("doc_id", "text_crc32", "size")
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.LongType()) for n in ("_part", "_row", "_bytes"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, total, part = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            ends = total + np.cumsum(sizes)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(row, row + n)), pa.array(ends - sizes)],
                [*batch.schema.names, "_part", "_row", "_bytes"])
            row, total = row + n, int(ends[-1]) if n else total

    placed = written(rows.mapInArrow(run, schema), "placed")
    totals = placed.groupBy("_part").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = totals.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_rows_before"),
                          F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_bytes_before"),
                          F.sum("s").over(Window.partitionBy()).alias("_total"))
    start = F.col("_bytes") + F.col("_bytes_before")
    shard = F.expr(f"cast(least({shards - 1}, ((2 * _start + size) * {shards}) div (2 * _total)) as int)")
    located = placed.join(F.broadcast(bases), "_part").withColumn("_start", start).withColumn("shard", shard).withColumn(
        "_at", F.col("_row") + F.col("_rows_before"))
    firsts = located.groupBy("shard").agg(F.min("_at").alias("_first"))  # at most ``shards`` rows
    return located.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_at") - F.col("_first")).alias("slot"), *carry)


def write_shards(docs: DataFrame, shards: int, path: str) -> None:
    """The documents with all their columns as Parquet, one folder per shard, and their slot in it.

    Columns of the documents named shard or slot, in any case, are written as given_shard or given_slot.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"given_{c}" if c.lower() in ("shard", "slot") else c) for c in docs.columns])
    placed = byte_shards(docs.select("doc_id", "text", row.alias("document")), shards, ("document",))
    placed.select("document.*", "shard", "slot").write.partitionBy("shard").parquet(path)
