"""Data rules inside a stream: changes are judged against the stored table before they are logged.

A store is a folder. ``changes/batch=<n>`` holds every change of a batch with the rules it breaks, ``log/batch=<n>`` the audit rows of the
accepted ones, and ``ledger/<n>`` says that both are whole. A batch that stops half way has no ledger entry: it runs again with the same
number and rows, as the checkpoint of the stream has it, and replaces its folders. Readers only see batches of the ledger, so every
change is accepted or rejected once, whatever restarts.

The stored table is the newest compacted state, ``base/upto=<n>``, with the accepted changes of the batches after it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampNTZType

from acadmetric.operators.audit import Actor, audit_from_changes, checked_batch
from acadmetric.schema import Table


@dataclass
class CheckedStore:
    path: str
    table: Table
    parents: Mapping[str, DataFrame]  # the tables its references point to
    actor: Actor

    def _files(self, spark: SparkSession, folder: str):
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return place.getFileSystem(context._jsc.hadoopConfiguration()), place

    def _numbers(self, spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
        store, place = self._files(spark, folder)
        if not store.exists(place):
            return []
        names = [f.getPath().getName() for f in store.listStatus(place)]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def committed(self, spark: SparkSession) -> list[int]:
        """The numbers of the batches that are whole."""
        return self._numbers(spark, "ledger")

    def _mark(self, spark: SparkSession, folder: str, number: int) -> None:
        store, place = self._files(spark, f"{folder}/{number}")
        store.create(place, True).close()

    def _feed_schema(self) -> StructType:
        row = self.table.struct
        return StructType([
            StructField("change_id", LongType()), StructField("op", StringType()), StructField("before", row), StructField("after", row),
            StructField("changed_at", TimestampNTZType()), StructField("broken_rules", ArrayType(StringType())), StructField("batch", LongType())])

    def _read(self, spark: SparkSession, folder: str, schema: StructType, numbers: list[int]) -> DataFrame:
        if not numbers:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", f"{self.path}/{folder}")
        return reader.parquet(*[f"{self.path}/{folder}/batch={n}" for n in numbers])

    def changes(self, spark: SparkSession) -> DataFrame:
        """Every change with its batch and ``broken_rules``: accepted changes have an empty list."""
        return self._read(spark, "changes", self._feed_schema(), self.committed(spark))

    def log(self, spark: SparkSession) -> DataFrame:
        """The audit rows of the accepted changes, with their batch."""
        empty = spark.createDataFrame([], StructType(self._feed_schema().fields[:5]))
        schema = audit_from_changes(empty, self.table.name, self.table.key, self.actor).schema.add("batch", LongType())
        return self._read(spark, "log", schema, self.committed(spark))

    def current(self, spark: SparkSession) -> DataFrame:
        """The stored table: the row of each key that the last accepted change of it left behind.

        A change of a key ends the old one. Each key's last state is found inside each task first.
        """
        names, key = [c.name for c in self.table.columns], list(self.table.key)
        compacted = [n for n in self._numbers(spark, "base", "upto=") if n in set(self._numbers(spark, "based"))]
        upto = max(compacted, default=None)
        numbers = [n for n in self.committed(spark) if upto is None or n > upto]
        accepted = self._read(spark, "changes", self._feed_schema(), numbers).filter(F.size("broken_rules") == 0)
        place = F.struct("batch", "change_id", F.col("row").isNotNull().alias("kept"))

        def states(column: str, row) -> DataFrame:
            return accepted.filter(F.col(column).isNotNull()).select(
                *[F.col(f"{column}.{k}").alias(k) for k in key], row.alias("row"), "batch", "change_id")

        gone = F.lit(None).cast(self.table.struct)
        everything = states("after", F.col("after")).unionByName(states("before", gone))
        if upto is not None:
            base = spark.read.schema(self.table.struct).parquet(f"{self.path}/base/upto={upto}")
            everything = everything.unionByName(base.select(
                *key, F.struct(*names).alias("row"), F.lit(-1).cast("long").alias("batch"), F.lit(-1).cast("long").alias("change_id")))
        # The state that a key is left in: of one change, the new row counts rather than the end of the old one.
        last = everything.groupBy(*key).agg(F.max_by(F.struct("row"), place).alias("s"))
        return last.filter("s.row IS NOT NULL").select("s.row.*")

    def compact(self, spark: SparkSession) -> None:
        """Write the state after the last whole batch, so that later batches read only what follows it."""
        numbers = self.committed(spark)
        if numbers:
            self.current(spark).write.mode("overwrite").parquet(f"{self.path}/base/upto={numbers[-1]}")
            self._mark(spark, "based", numbers[-1])

    def accept(self, feed: DataFrame, number: int) -> None:
        """Judge one batch and store what it is; a batch that the ledger has is left alone."""
        spark = feed.sparkSession
        if number in self.committed(spark):
            return
        columns = [f.name for f in self._feed_schema().fields[:5]]
        checked = checked_batch(feed.select(*columns), self.table, self.current(spark), self.parents)
        place = f"{self.path}/changes/batch={number}"
        checked.write.mode("overwrite").parquet(place)
        stored = spark.read.schema(checked.schema).parquet(place).filter(F.size("broken_rules") == 0)
        audit_from_changes(stored, self.table.name, self.table.key, self.actor).write.mode("overwrite").parquet(f"{self.path}/log/batch={number}")
        self._mark(spark, "ledger", number)

    def start(self, feed: DataFrame, only_available: bool = True) -> StreamingQuery:
        """Start judging a streaming feed with columns change_id, op, before, after, changed_at."""
        writer = feed.writeStream.foreachBatch(self.accept).option("checkpointLocation", f"{self.path}/checkpoint")
        return (writer.trigger(availableNow=True) if only_available else writer).start()
