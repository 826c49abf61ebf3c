"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept; its result is written as Parquet and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``: a rejected
document is gone, and a document that the mix takes twice is there twice.

Rows: a null or empty text is not toxic, but has no words and is rejected by the
quality rules; given to a later stage by itself, it is a duplicate of nothing, is
never taken into the mix, and packs as its end id alone.  Null doc_ids, languages and
sources are kept as they are, a null source being a source of its own.  Texts of any
length are judged, compared and packed whole.  Of rows that are equal the near-dedup
keeps one; all other stages treat repeated rows and doc_ids as documents of their own.
Further columns come along up to the last stage, whatever their names.  An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import bagminhash, mixing, packing, quality, toxicity
from cohortry.llm.ship import ship
from cohortry.llm.stash import stash


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below one half; learnt from the folder's labels."""
    ship(spark)
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are probably good by the others."""
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return bagminhash.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed into sequences."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# The scores, the mixing rates and the packing aren't expressible in SQL;
# tests/llm/test_pipeline.py compares the rows with a brute-force version.
ORACLE_SQL = None
