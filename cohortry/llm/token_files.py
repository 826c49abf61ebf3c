"""Token ids of a corpus in files, with Elias-Fano coded document boundaries.

A folder holds blocks.  A block is a row of Parquet with the concatenated ids of
some consecutive documents as one byte string, the ends of those documents in
Elias-Fano code, and their doc_ids.  Blocks are in ascending doc_id order by
``shard`` and ``block``; ``shard_start`` counts the ids before the block in its
shard.  There is no table of 64-bit offsets: a document's place is selected from
its block's code, plus the start of the block, plus the ids of earlier shards.

Parquet is the container because Spark commits it task by task on any shared
store: a lost executor leaves no half-written file.

Rows: a null text is empty (it still gets its end id); null doc_ids come first;
rows with the same doc_id stay in the order in which they are read; other columns are
ignored; an empty table gives an empty folder.  Texts of any length are encoded
whole; a text longer than a block is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import elias_fano
from cohortry.llm.tokens import TOKENIZER, encoder, text_runs

END_ID = 1
# A block is closed once it holds this many ids.
BLOCK_IDS = 1_000_000

BLOCKS = (
    "shard INT, block INT, shard_start BIGINT, n_ids BIGINT, id_bytes INT, "
    "doc_ids ARRAY<BIGINT>, ends BINARY, ids BINARY"
)
_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()),
        ("n_ids", pa.int64()), ("id_bytes", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.binary()), ("ids", pa.binary()),
    ]
)
DOCUMENTS = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"


def write_ids(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the blocks below ``path``.

    One shuffle, by ranges of doc_id.  The last sort column spreads rows that are
    equal in doc_id over more than one task.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode, end = encoder(tokenizer).encode, np.uint32(end_id).astype("<u4").tobytes()
        ids, doc_ids, waiting, block, start = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            width = 2 if not len(flat) or flat.max() < 1 << 16 else 4
            ends = np.cumsum([len(i) // 4 for i in ids])
            row = {
                "shard": shard, "block": block, "shard_start": start, "n_ids": len(flat),
                "id_bytes": width, "doc_ids": list(doc_ids), "ends": elias_fano.encode(ends),
                "ids": flat.astype(f"<u{width}").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for run in text_runs(texts):
                found = encode(texts[run])
                for key, one in zip(keys[run], found):
                    doc_ids.append(key)
                    ids.append(one + end)
                    waiting += len(one) // 4 + 1
                    if waiting >= block_ids:
                        yield close()
                        ids, doc_ids = [], []
                        waiting, block, start = 0, block + 1, start + waiting
        if ids:
            yield close()

    (
        docs.selectExpr("doc_id", "text", "monotonically_increasing_id() AS _n")
        .repartitionByRange("doc_id", "_n")
        .sortWithinPartitions("doc_id", "_n")
        .select("doc_id", "text")
        .mapInArrow(blocks, BLOCKS)
        .write.parquet(path)
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each shard.  One row per task that wrote, so one window will do."""
    return (
        blocks.groupBy("shard")
        .agg(F.sum("n_ids").alias("_ids"))
        .selectExpr(
            "shard",
            "coalesce(sum(_ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
            " AS first_id",
        )
    )


def unpack_ids(ids: bytes, id_bytes: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{id_bytes}").astype("<u4")


def document_ids(row, index: int) -> tuple[int, np.ndarray]:
    """Place in the shard, and ids, of one document of a block, by ``select``."""
    ends = elias_fano.EliasFano(row["ends"])
    first = ends.select(index - 1) if index else 0
    last = ends.select(index)
    width = row["id_bytes"]
    ids = bytes(memoryview(row["ids"])[first * width : last * width])
    return row["shard_start"] + first, unpack_ids(ids, width)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: its place, its length and a check sum of its ids."""
    blocks = read_blocks(spark, path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in ("doc_ids", "ends", "ids", "id_bytes")}
                ids = unpack_ids(row["ids"].as_py(), row["id_bytes"].as_py())
                ends = elias_fano.EliasFano(row["ends"].as_py()).values()
                starts = np.concatenate(([0], ends[:-1]))
                before = batch.column("first_id")[i].as_py() + batch.column("shard_start")[i].as_py()
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values, pa.array(starts + before), pa.array(ends - starts),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # Bounded: one row per shard, that is per task of the writing job.
    return blocks.join(F.broadcast(shard_starts(blocks)), "shard").mapInArrow(documents, DOCUMENTS)
