"""Packing documents into sequences of fixed length by hierarchical best fit.

Every task packs its pieces by best fit, longest first.  Bins that are nearly
full are emitted.  The others become items of the next round, where fewer tasks
take the items of several, and so on as a tree, until one task is left or merging
no longer helps.  A task of any round holds at most ``ITEMS_PER_TASK`` items on
average, however large the corpus is: where items can't be combined (all of them
longer than half a sequence, say), the tree stops early instead of gathering them.

Rows: a null text is an empty document, which still has its end id; rows with the
same doc_id are separate documents; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import stash
from cohortry.llm.tokens import TOKENIZER, encoder, release_memory, text_runs

CAPACITY = 2048
END_ID = 0
# Bins with at most this many free places are not packed further.
SLACK = 4
ITEMS_PER_TASK = 100_000
# Bytes of text that a worker encodes at once.
RUN_BYTES = 2_000_000
# Tasks of one round whose bins meet in one task of the next.
FAN_IN = 8

PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
_PARTS = (
    "ARRAY<STRUCT<doc_id: BIGINT, piece: INT, start: BIGINT, length: BIGINT,"
    " ids_crc32: BIGINT, offset: BIGINT>>"
)
_ITEMS = f"length BIGINT, parts {_PARTS}"


def cut_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: only documents longer than a sequence are cut.

    ``with_ids`` adds the ids themselves as little-endian unsigned 32-bit bytes.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.uint32(end_id).astype("<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for run in text_runs(texts, RUN_BYTES):
                rows = []
                for key, ids in zip(keys[run], encode(texts[run])):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        row = (key, n, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names
                )
        release_memory()

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = PIECES
    if with_ids:
        names, kinds, schema = [*names, "ids"], [*kinds, pa.binary()], f"{schema}, ids BINARY"
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each item, by best fit with the longest items first.

    Open bins are kept by their free places; the bits of ``free`` tell which free
    counts occur, so the best fit is the lowest set bit from the length on.
    """
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, opened = 0, 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = free >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_free[room].pop()
            if not by_free[room]:
                free &= ~(1 << room)
        else:
            room, number, opened = capacity, opened, opened + 1
        bins[item], places[item] = number, capacity - room
        if room > length:
            by_free[room - length].append(number)
            free |= 1 << (room - length)
    return bins, places


def _pack_tasks(items: DataFrame, capacity: int) -> DataFrame:
    """Each task merges its items into bins; a bin is again an item."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks() if batches else None
        if table is None or table.num_rows == 0:
            return
        lengths = table["length"].to_numpy()
        parts = table["parts"].combine_chunks()
        sizes = np.diff(parts.offsets.to_numpy())
        flat = parts.flatten()
        number, place = best_fit(lengths, capacity)
        by_part = np.repeat(number, sizes)
        offset = flat.field("offset").to_numpy() + np.repeat(place, sizes)
        order = np.lexsort((offset, by_part))
        fields = {f.name: flat.field(f.name) for f in flat.type}
        fields["offset"] = pa.array(offset)
        taken = pa.StructArray.from_arrays(
            [c.take(pa.array(order)) for c in fields.values()], names=list(fields)
        )
        opened = int(number.max()) + 1
        ends = np.cumsum(np.bincount(by_part, minlength=opened))
        packed = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), taken)
        total = np.zeros(opened, np.int64)
        np.add.at(total, number, lengths)
        done = pa.Table.from_arrays([pa.array(total), packed], names=["length", "parts"])
        yield from done.to_batches(max_chunksize=10_000)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        yield from bins(held) if held else ()
        held.clear()
        release_memory()

    return items.mapInArrow(some, _ITEMS)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK,
    items_per_task: int = ITEMS_PER_TASK, fan_in: int = FAN_IN,
) -> DataFrame:
    """Place pieces (the columns of ``cut_documents``) into sequences.

    Adds ``sequence_id`` (any number) and ``offset``, gapless from 0.  Runs a job
    per round of the tree.
    """
    items = pieces.selectExpr(
        "length",
        "array(named_struct('doc_id', doc_id, 'piece', piece, 'start', start, 'length', length,"
        " 'ids_crc32', ids_crc32, 'offset', 0L)) AS parts",
    )
    items = stash(items, "packing-items")
    full = capacity - slack
    done = [items.where(f"length >= {full}")]
    open_items = items.where(f"length < {full}")
    left, tasks = open_items.count(), None
    while left:
        least = -(-left // items_per_task)
        tasks = least if tasks is None else max(least, tasks // fan_in)
        spread = open_items.withColumn("_n", F.expr("xxhash64(monotonically_increasing_id())"))
        packed = stash(
            _pack_tasks(spread.repartition(tasks, "_n").drop("_n"), capacity), "packing-round"
        )
        done.append(packed.where(f"length >= {full}"))
        open_items = packed.where(f"length < {full}")
        before, left = left, open_items.count()
        if tasks == 1 or left > 0.95 * before:
            done.append(open_items)
            break
    bins = reduce(DataFrame.union, done)
    # Numbered before they are taken apart: all parts of a bin get its number.
    numbered = bins.select("parts", F.monotonically_increasing_id().alias("sequence_id"))
    return numbered.select("sequence_id", F.expr("inline(parts)"))


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID
) -> DataFrame:
    """Cut and pack ``docs`` (doc_id, text); one row per piece."""
    return pack(cut_documents(docs, capacity, tokenizer, end_id), capacity)


def sequence_ids(
    docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` as 32-bit bytes.

    Pieces that agree in document, number, length and check sum hold the same ids,
    so repeated rows need no key of their own.  A group has at most ``capacity``
    ids.
    """
    key = ["doc_id", "piece", "length", "ids_crc32"]
    cut = cut_documents(docs, capacity, tokenizer, end_id, with_ids=True)
    known = cut.groupBy(*key).agg(F.min("ids").alias("ids"))
    same = reduce(lambda a, b: a & b, [placed[k].eqNullSafe(known[k]) for k in key])
    return (
        placed.join(known, same)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
        .select("sequence_id", F.expr("unhex(array_join(transform(_p, p -> hex(p.ids)), ''))").alias("ids"))
    )
