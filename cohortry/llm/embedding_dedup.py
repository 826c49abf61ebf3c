"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors of one label are projected onto many random lines.  A line is sorted, and
two vectors collide on it if one lies in the window centred on the other.  As a
window on one line holds too many vectors of a large group, each line has a few
further lines, cut into cells at random places, that must agree as well; only
vectors in one cell are sorted and compared.  A pair's collisions are counted
over all ``LINES`` lines, and a pair with at least the calibrated count is
verified by its cosine in double precision.

Calibration: two vectors at the threshold are ``sqrt(2 - 2 cosine)`` apart, so
their projections differ by a normal variable of that deviation, which gives the
chance of a collision; the count is the largest that keeps the chance of missing
such a pair below ``MISS``.  Closer pairs collide more often.

Equal vectors are one class from the start.  The cells' members are compared in
groups of bounded size; a pair is looked at only in the first line it collides on,
so links are counted where they are found: neither pairs nor links are shuffled.
What leaves a task is a number of links per class and the edges of a forest.

Rows: vectors that are null, empty or zero, or hold a null or non-finite number,
and rows without a label, link with nothing; vectors of different length don't
link; repeated rows are vectors of their own; a null vec_id is counted as a link
of others, but has no component of its own; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.buckets import Forest, in_groups, shared_buckets, whole_groups, windows
from cohortry.llm.components import components
from cohortry.llm.stash import stash

LINES = 32
CELL_LINES = 6
# In deviations of the difference of two vectors at the threshold.
CELL_WIDTH = 5.0
WINDOW = 3.5
MISS = 5e-4
SEED = 20


class Lines:
    """The random lines for vectors of one length."""

    def __init__(self, length: int, threshold: float):
        rng = np.random.default_rng([SEED, length])
        self._lines = rng.standard_normal((length, LINES * (CELL_LINES + 1)))
        self._shift = rng.random((LINES, CELL_LINES))
        self._mixers = rng.integers(1, 1 << 62, (LINES, CELL_LINES), dtype=np.int64) * 2 + 1
        self.deviation = math.sqrt(2 - 2 * threshold)
        self.window = WINDOW * self.deviation

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and line: the cell, as a number, and the place on the line."""
        spots = (unit @ self._lines).reshape(len(unit), LINES, CELL_LINES + 1)
        cells = np.floor(spots[:, :, 1:] / (CELL_WIDTH * self.deviation) + self._shift)
        with np.errstate(over="ignore"):
            mixed = (cells.astype(np.int64) * self._mixers).sum(axis=2)
        mixed ^= mixed >> 29
        return mixed, spots[:, :, 0]


def collision_chance() -> float:
    """Chance that two vectors at the threshold collide on a line."""
    w = CELL_WIDTH
    miss = math.erfc(w / math.sqrt(2))
    cell = 1 - miss - 2 / (math.sqrt(2 * math.pi) * w) * (1 - math.exp(-w * w / 2))
    return cell**CELL_LINES * math.erf(WINDOW / math.sqrt(2))


def collisions_needed() -> int:
    """The largest count that misses a pair at the threshold less often than ``MISS``."""
    p, missed = collision_chance(), 0.0
    for count in range(LINES + 1):
        missed += math.comb(LINES, count) * p**count * (1 - p) ** (LINES - count)
        if missed > MISS:
            return max(1, count)
    return LINES


def _units(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    """Vectors of length 1.  Scaled by a power of two first, which changes no digit, so
    that the squares of the largest and smallest doubles neither over- nor underflow."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    found = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    found = np.ldexp(found, -np.frexp(np.abs(found).max(axis=1, initial=0))[1][:, None])
    return found / np.sqrt(np.einsum("ij,ij->i", found, found))[:, None]


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _cells(classes: DataFrame, threshold: float) -> DataFrame:
    """One row per class and line: the cell it lies in."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                for length, rows in _by_length(part.column("length").to_numpy()):
                    chosen = part.take(pa.array(rows))
                    cell, _ = Lines(length, threshold).project(_units(chosen.column("vector"), length))
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(chosen.column("label_no").to_numpy(), LINES)),
                            pa.array(np.full(n * LINES, length, np.int32)),
                            pa.array(np.tile(np.arange(LINES, dtype=np.int32), n)),
                            pa.array(cell.ravel()),
                            pa.array(np.repeat(chosen.column("class_no").to_numpy(), LINES)),
                        ],
                        names=["label_no", "length", "line", "cell", "class_no"],
                    )

    return classes.select("class_no", "label_no", "length", "vector").mapInArrow(
        cells, "label_no BIGINT, length INT, line INT, cell BIGINT, class_no BIGINT"
    )


_FOUND = "class_no BIGINT, links BIGINT, other BIGINT"
_KEYS = ["label_no", "length", "line", "cell"]


def _links(members: DataFrame, threshold: float) -> DataFrame:
    """Links per class and the edges of a forest, from whole groups."""
    needed = collisions_needed()

    def compare(
        length: int, line: np.ndarray, table: pa.Table, groups: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        unit = _units(table["vector"], length)
        lines = Lines(length, threshold)
        cells, spots = lines.project(unit)
        own = spots[np.arange(len(unit)), line]
        # Sorted by group and place; a window never reaches into the next group.
        key = groups * (4.0 * np.abs(spots).max() + 4 * lines.window) + own
        order = np.argsort(key, kind="stable")
        key = key[order]
        end = np.searchsorted(key, key + lines.window, side="right")
        mine, left, right = (table[n].to_numpy() for n in ("mine", "left", "right"))
        copies, number = table["copies"].to_numpy(), table["class_no"].to_numpy()
        links = np.zeros(len(unit), np.int64)
        forest, edges = Forest(len(unit)), []
        for a, b in windows(np.arange(len(unit)) + 1, end):
            i, j = order[a], order[b]
            apart = (left[i] == right[i]) | (mine[i] != mine[j])
            i, j = i[apart], j[apart]
            hit = (cells[i] == cells[j]) & (np.abs(spots[i] - spots[j]) <= lines.window)
            fit = (hit.sum(axis=1) >= needed) & (hit.argmax(axis=1) == line[i])
            i, j = i[fit], j[fit]
            linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[linked], j[linked]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            edges += [(x, y) for x, y in zip(i.tolist(), j.tolist()) if forest.joins(x, y)]
        found = np.flatnonzero(links)
        ends = np.array(edges, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((number[found], number[ends[:, 0]]))),
                pa.array(np.concatenate((links[found], np.zeros(len(ends), np.int64)))),
                pa.array(
                    np.concatenate((number[found], number[ends[:, 1]])),
                    mask=np.arange(len(found) + len(ends)) < len(found),
                ),
            ],
            names=["class_no", "links", "other"],
        )

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, _KEYS):
            for length, rows in _by_length(table["length"].to_numpy()):
                chosen = table.take(pa.array(rows))
                yield from compare(length, chosen["line"].to_numpy(), chosen, group[rows])

    return in_groups(members, _KEYS).mapInArrow(groups, _FOUND)


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.98, block: int | None = None
) -> DataFrame:
    """Links, component and verdict of each row of (vec_id, embedding, label)."""
    rows = vectors.select(
        "vec_id", F.col("label").alias("_label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    comparable = """_label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0
        AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))
        AND exists(vector, x -> x <> 0)"""
    rows = rows.withColumn("_valid", F.coalesce(F.expr(comparable), F.lit(False)))
    marks = [
        F.when(F.col("_valid"), F.xxhash64(F.lit(seed), "vector")).alias(f"_mark{seed}")
        for seed in (0, 1)
    ]
    key = ["_label", "_mark0", "_mark1"]
    marked = rows.select("vec_id", "_label", "vector", "_valid", *marks)
    # The hot group of a third of all rows is folded before the shuffle.
    classes = (
        marked.where("_valid")
        .groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("first_id"),
            F.any_value("vector").alias("vector"),
        )
    )
    classes = stash(
        classes.select(
            F.monotonically_increasing_id().alias("class_no"), F.xxhash64("_label").alias("label_no"),
            F.size("vector").alias("length"), *key, "copies", "first_id", "vector",
        ),
        "vector-classes",
    )
    more = {} if block is None else {"block": block}
    cells = stash(_cells(classes, threshold), "vector-cells")
    members = shared_buckets(cells, _KEYS, "class_no", **more).join(
        classes.select("class_no", "copies", "vector"), "class_no"
    )
    found = stash(_links(members, threshold), "vector-links")
    direct = found.groupBy("class_no").agg(F.sum("links").alias("links"))
    parts = components(found.where("other IS NOT NULL").selectExpr("class_no AS a", "other AS b"))
    joined = (
        classes.select("class_no", *key, "copies", "first_id")
        .join(direct, "class_no", "left")
        .join(parts.withColumnRenamed("node", "class_no"), "class_no", "left")
        .withColumn("component", F.coalesce("component", "class_no"))
    )
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    described = joined.join(least, "component").selectExpr(
        "_label AS _l", "_mark0 AS _m0", "_mark1 AS _m1",
        "copies - 1 + coalesce(links, 0) AS n_links", "component_id",
    )
    same = F.expr("_label = _l AND _mark0 = _m0 AND _mark1 = _m1")
    return (
        marked.select("vec_id", *key)
        .join(described, same, "left")
        .selectExpr(
            "vec_id",
            "coalesce(n_links, 0) AS n_links",
            "IF(vec_id IS NULL, NULL, coalesce(component_id, vec_id)) AS component_id",
            "coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept",
        )
    )
