"""The registered queries of the document operators: each runs its operator over a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.llm import checks
from acadmetric.llm.common import fold, table, vocabulary_file
from acadmetric.llm.decontamination import contaminated_documents
from acadmetric.llm.exact_dedup import exact_duplicates
from acadmetric.llm.extraction import extract_pages
from acadmetric.llm.fill_in_middle import digests
from acadmetric.llm.language import fit_language, languages
from acadmetric.llm.lexical_search import ranked
from acadmetric.llm.near_dedup import near_duplicate_groups
from acadmetric.llm.piece_transducer import round_trips
from acadmetric.llm.quality import fit_quality, quality_scores
from acadmetric.llm.sharding import byte_shards
from acadmetric.llm.spot_signatures import alike_groups, compared_with_edits
from acadmetric.llm.token_files import read_token_files, write_token_files
from acadmetric.llm.toxicity import fit_toxicity, toxicity_scores
from acadmetric.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable:
    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add


@query("op1_minhash_near_dedup", checks.NEAR_DEDUP)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(table(spark, folder, "documents"), width=4, percent=80)


@query("op3_benchmark_decontamination", checks.DECONTAMINATION)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = vocabulary_file("word_bpe_49k.json")
    files = write_token_files(table(spark, folder, "documents"), new_path(spark, "tokens"), tokenizer, end_id=1)
    return read_token_files(spark, files, tokenizer)


@query("op8_byte_shards", checks.BYTE_SHARDS)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return byte_shards(table(spark, folder, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _judged(scores: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scores.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


@query("op7_nbsvm_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    return _judged(quality_scores(docs, fit_quality(docs, labels)), 0.3)


@query("op10_crf_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    return _judged(toxicity_scores(docs, fit_toxicity(docs, labels)), 0.5, "spans")


@query("op5_subword_language")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = fit_language(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return languages(docs, model, reject=False).select("doc_id", fold(F.col("doc_id"), 3).eqNullSafe(1).alias("held_out"), "lang_pred", "score")


@query("op6_spot_signatures")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return compared_with_edits(table(spark, folder, "documents"))


@query("spot_signature_classes")
def spot_signature_classes(spark: SparkSession, folder: str) -> DataFrame:
    return alike_groups(table(spark, folder, "documents"), percent=80)


@query("op2_consensus_extraction")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


@query("op9_piece_transducer")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return round_trips(table(spark, folder, "documents"), vocabulary_file("piece_bpe_32k.model"))


@query("op11_exact_dedup", checks.EXACT_DEDUP)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op12_ranked_search", checks.RANKED_SEARCH)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), top=20)


@query("op13_fill_in_middle", checks.FILL_IN_MIDDLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
