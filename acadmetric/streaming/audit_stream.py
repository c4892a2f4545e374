"""The audit log as a stream: change rows in, log rows appended.

The log derivation keeps no state, so no watermark is involved. Checkpoint and
file sink together write each change once, also when the job restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from acadmetric.operators.audit import Actor, audit_from_changes


def change_stream(spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet",
                  files_per_batch: int = 1000, bytes_per_batch: str | None = None) -> DataFrame:
    """Files of ``folder`` as a stream, including files that arrive later; a backlog is read in batches of bounded size."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    # Spark takes one of the two limits.
    limit = ("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else ("maxFilesPerTrigger", files_per_batch)
    return reader.option(*limit).parquet(folder)


def append_audit_log(feed: DataFrame, table: str, key: Sequence[str], actor: Actor, log_path: str,
                     checkpoint_path: str, only_available: bool = True) -> StreamingQuery:
    """Start appending the log of a streaming change feed.

    The log is stored by audited table, which the volume and sequence reports
    group by, and by date, so that a filter on either reads only its folders.
    """
    writer = (
        audit_from_changes(feed, table, key, actor).withColumn("dia", F.to_date("au_dt_operacao"))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("au_nm_tabela", "dia")
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(availableNow=True) if only_available else writer
    return writer.start(log_path)


def audit_all(spark: SparkSession, folder: str, schema: StructType | str, pattern: str,
              to_feed: Callable[[DataFrame], DataFrame], table: str, key: Sequence[str], actor: Actor,
              log_path: str, checkpoint_path: str) -> DataFrame:
    """Run the stream over everything available and return the stored log."""
    feed = to_feed(change_stream(spark, folder, schema, pattern))
    append_audit_log(feed, table, key, actor, log_path, checkpoint_path).awaitTermination()
    columns = audit_from_changes(to_feed(spark.createDataFrame([], schema)), table, key, actor)
    return spark.read.schema(columns.schema.add("dia", "date")).parquet(log_path)
