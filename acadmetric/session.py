"""Session construction and the shared folder used for written intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  folder: str | None = None) -> SparkSession:
    """A session for tests and the local benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("acadmetric")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Test tables are small: let adaptive execution keep one small partition per core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session inside one process may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="acadmetric-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses, below one folder per application in the shared folder."""
    application = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), "acadmetric", application, f"{label}-{uuid.uuid4().hex}")


# Catalog tables whose files lie in the shared folder, by application.
_tables: dict[str, list[str]] = {}


def remember_table(spark: SparkSession, table: str) -> None:
    """Have :func:`drop_written` drop a catalog table with the files."""
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)


def drop_written(spark: SparkSession) -> None:
    """Remove everything this application has written to the shared folder, and the catalog tables that lie on it.

    Call it when no DataFrame that was built on it is needed any more, at the end of a job as a rule.
    """
    context = spark.sparkContext
    for table in _tables.pop(context.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = context._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_folder(spark), "acadmetric", context.applicationId))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Fixes values that depend on where a row was processed, cuts the lineage,
    and keeps the data when an executor is lost.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Tasks that rows are dealt over by key, at least.
DEALT = 64


def dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` dealt by the hash of ``keys`` over a fixed number of tasks, which are not put together again.

    For groups that are about as many as the rows: put before the grouping, nothing is gathered by the tasks that read, however few
    they are (a file of one row group is one task), and each task holds the groups of its share only. Rows are keys and flags, so a
    quarter of the session's shuffle partitions is enough where that is more.
    """
    return df.repartition(max(DEALT, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4), *keys)
