"""Comparing the members of buckets in tasks of bounded size.

A bucket may hold any share of all rows.  One with more than ``BLOCK`` members is
cut into blocks by a hash of the member, and each pair of blocks is a group of
its own; so every two members of a bucket meet in exactly one group, and a group
has at most about twice ``BLOCK`` members.  Where members have sizes, a block's sizes
are bounded likewise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
# Pairs looked at in one vectorised step.
PAIRS_AT_ONCE = 100_000


def shared_buckets(
    keyed: DataFrame, keys: list[str], member: str, block: int = BLOCK,
    weight: str = "0", block_weight: int = 1,
) -> DataFrame:
    """Rows of ``keyed`` in buckets with at least two members, once per group.

    Adds ``left`` and ``right``, the group's blocks, and ``mine``, the row's own.  A
    bucket has so many blocks that one holds about ``block`` members and ``weight``s of
    about ``block_weight`` in all, but one member at least.
    """
    sizes = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"), F.sum(F.expr(weight).cast("bigint")).alias("_weight"))
        .where("_size > 1")
    )
    blocks = f"greatest(ceil(_size / {block}), least(_size, ceil(_weight / {block_weight})))"
    return (
        keyed.join(sizes, keys)
        .withColumn("_blocks", F.expr(f"CAST({blocks} AS INT)"))
        .withColumn("mine", F.expr(f"CAST(pmod(xxhash64({member}, 29), _blocks) AS INT)"))
        .withColumn("_other", F.expr("explode(sequence(0, _blocks - 1))"))
        .withColumn("left", F.expr("least(mine, _other)"))
        .withColumn("right", F.expr("greatest(mine, _other)"))
        .drop("_size", "_weight", "_blocks", "_other")
    )


def in_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bring the rows of each group together, one after the other."""
    group = [*keys, "left", "right"]
    return rows.repartition(*group).sortWithinPartitions(*group)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups only, with a group number per row.

    The rows after the last change of the group are kept for the next batch.
    """
    held: list[pa.RecordBatch] = []

    def numbered(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, dtype=bool)
        for name in (*keys, "left", "right"):
            column = table[name].to_numpy()
            change[1:] |= column[1:] != column[:-1]
        return np.cumsum(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        groups = numbered(table)
        cut = int(np.searchsorted(groups, groups[-1]))
        held = table.slice(cut).to_batches()
        if cut:
            yield table.slice(0, cut), groups[:cut]
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def windows(
    first: np.ndarray, end: np.ndarray, most: int = PAIRS_AT_ONCE
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with ``first[i] <= j < end[i]``, in steps of bounded size."""
    sizes = np.maximum(end - first, 0)
    total = np.concatenate(([0], np.cumsum(sizes)))
    for at in range(0, int(total[-1]), most):
        pairs = np.arange(at, min(at + most, int(total[-1])))
        i = np.searchsorted(total, pairs, side="right") - 1
        yield i, first[i] + pairs - total[i]


class Forest:
    """Union of numbered members within a task."""

    def __init__(self, size: int):
        self._parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self._parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def joins(self, a: int, b: int) -> bool:
        """Whether the two were apart; they are together afterwards."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self._parent[max(a, b)] = min(a, b)
        return True
