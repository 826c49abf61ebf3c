"""The registered queries of this subpackage; ``ORACLES`` has their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import (
    bagminhash,
    embedding_dedup,
    html_text,
    language_id,
    lexical_search,
    merkle,
    mixing,
    packing,
    piece_bpe,
    quality,
    token_files,
    toxicity,
    warc,
)
from cohortry.llm.oracles import ORACLES as ORACLES
from cohortry.llm.ship import ship
from cohortry.plans.durable import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, folder, "embeddings"))


def op2_entropy_balancing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op3_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.revisits(table(spark, folder, "pages"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    ).select("doc_id", "held_out", "score", "predicted", "spans")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_ids(table(spark, folder, "documents"), path)
    return token_files.read_documents(spark, path)


def op7_minimum_cut(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op8_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op9_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op10_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, folder, "documents"))


def op11_dag_descent(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verify_documents(table(spark, folder, "documents"))


def op12_pair_agenda(spark: SparkSession, folder: str) -> DataFrame:
    return piece_bpe.round_trip(table(spark, folder, "documents"))


def op13_blocked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_collision_counting, op2_entropy_balancing, op3_revisits, op4_best_fit_packing,
        op5_toxic_spans, op6_token_files, op7_minimum_cut, op8_string_kernel, op9_weak_supervision,
        op10_bagminhash, op11_dag_descent, op12_pair_agenda, op13_blocked_search,
    )
}
