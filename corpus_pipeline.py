"""A filtering pipeline over ``documents``: quality, toxicity, near duplicates, benchmark passages, then encoding.

Each stage takes the rows its predecessor kept and returns those it keeps, with the columns of ``documents``; the last returns
the encoded documents. Stages are written to the shared folder and read again, so a lost executor repeats one stage at most.
Every stage judges row by row, by the row's own text: rows that repeat a doc_id or lack one go or stay like any other. Null and
empty texts are scored as texts without words, have no near copy and no benchmark passage.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acadmetric.llm.common import table, vocabulary_file
from acadmetric.llm.decontamination import keep_uncontaminated
from acadmetric.llm.near_dedup import keep_one_row_of_each_group
from acadmetric.llm.piece_transducer import round_trips
from acadmetric.llm.quality import fit_quality, keep_rows_of_quality
from acadmetric.llm.toxicity import fit_toxicity, keep_clean_rows
from acadmetric.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (probability of good quality under 0.3) go."""
    return keep_rows_of_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), 0.3)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field rejects (probability of toxicity of 0.5 or more) go."""
    return keep_clean_rows(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return keep_one_row_of_each_group(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any ten words in a row of a benchmark item go."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document: doc_id, n_pieces, ids_crc32, n_chars, same, ids."""
    return round_trips(docs, vocabulary_file("piece_bpe_32k.model"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pieces", pieces),
]

# The stages fit models and follow automata, which SQL cannot express. Tests compare the rows that each stage keeps with plain Python,
# the classifiers' with their models applied text by text.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
