"""Near-duplicate documents by the weighted Jaccard similarity of their shingles.

A document is a multiset of five-word shingles.  Two are linked if the shingles
they share, with repetitions, are at least 80 % of those in either.

Signatures are BagMinHash: a shingle of weight ``w`` owns the interval [0, w) of a
line, on which a Poisson process drops points over time; each point falls on a
random one of the signature's components, and a component keeps its earliest
point.  The line is cut into [0, 1), [1, 2), [2, 4), [4, 8), ..., each with a
process of its own that depends on the shingle alone; in the last interval that
``w`` reaches into, points beyond ``w`` are left out.  So two documents draw the
same points wherever both weights reach, and a component agrees with probability
equal to the weighted Jaccard similarity.  Points come in order of time, and a
process stops once it is later than all components, so that long texts cost
little more than one point per shingle.

Signatures are cut into bands.  Documents with equal shingle multisets are one
class from the start.  Classes that share a band are compared by their signatures
in groups of bounded size; a pair is looked at only in the first band it shares.
The first round sends on a forest of the likeliest pairs of each group to be
verified by their shingles, which joins most copies.  The second verifies every
likely pair that still lies in two different components, inside the groups: the
shingles go to the few members that need it, and only links leave.  So thousands
of near copies never become a table of their pairs, and no likely pair of
different components stays unverified.

Rows: documents without words (null texts too) are similar to nothing; rows
without doc_id are matched as exact copies only, and are kept only where no row
with an id has the same shingles; repeated rows are exact copies, of which the one
with the smallest doc_id is kept; other columns are ignored; an empty table gives
an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.buckets import Forest, in_groups, shared_buckets, whole_groups, windows
from cohortry.llm.components import components
from cohortry.llm.shingles import counted, mix, shingle_hashes
from cohortry.llm.stash import stash
from cohortry.llm.tokens import release_memory, text_runs
from cohortry.plans.sizes import broadcast_if_small

SIMILAR_PCT = 80
BANDS = 25
BAND_ROWS = 5
COMPONENTS = BANDS * BAND_ROWS
# A pair is likely if at least this many components agree: five deviations below
# the mean of a pair at the threshold.
LIKELY = 78
# Likely pairs that a task holds before it adds the best of them to its forest.
PAIRS_HELD = 1_000_000
# Bytes kept of a shingle's hash for verifying.
HASH_BYTES = 6
# Bytes of shingles that a group holds while its pairs are verified, or two documents.
GROUP_BYTES = 32 << 20
# Bytes of text that a worker cuts into shingles at once.
RUN_BYTES = 1_000_000
# Pairs of sketches that a worker compares at once.
SKETCH_PAIRS = 20_000
# Likely pairs that are Python numbers at once.
ENDS_AT_ONCE = 20_000
# Bytes of shingles that a worker numbers at once, or those of one group.
NUMBERED_BYTES = 4 << 20


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, COMPONENTS) 64-bit values: the earliest point of each component.

    ``hashes``, ``owner`` and ``weight`` list the different shingles of n
    documents.  Components of documents without shingles are 0.
    """
    # One process per shingle and interval that its weight reaches into.
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    item = np.repeat(np.arange(len(hashes)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1)
    seed = mix(hashes[item] ^ mix(level.astype(np.uint64)))
    owner, weight = owner[item], weight[item]
    time = np.zeros(len(item))
    best = np.full(n * COMPONENTS, np.inf)
    point = np.zeros(n * COMPONENTS, dtype=np.uint64)
    drawn = np.uint64(0)
    while len(seed):
        drawn += np.uint64(1)
        first = mix(seed + mix(np.full(1, drawn * np.uint64(2)))[0])
        second = mix(first)
        uniform = ((first >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        time = time - np.log(uniform) / width
        spot = low + ((second >> np.uint64(32)).astype(np.int64) * width >> 32)
        inside = np.flatnonzero(spot < weight)
        place = owner[inside] * COMPONENTS + (
            (second[inside] & np.uint64(0xFFFFFFFF)) % np.uint64(COMPONENTS)
        ).astype(np.int64)
        np.minimum.at(best, place, time[inside])
        earliest = inside[time[inside] == best[place]]
        point[place[time[inside] == best[place]]] = first[earliest]
        latest = best.reshape(n, COMPONENTS).max(axis=1)
        going = time < latest[owner]
        seed, time, owner, weight = seed[going], time[going], owner[going], weight[going]
        low, width = low[going], width[going]
    return point.reshape(n, COMPONENTS)


_SIGNED = "doc_id BIGINT, mark0 BIGINT, mark1 BIGINT, n BIGINT, sketch BINARY"


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary array from the rows of a contiguous byte matrix."""
    width = rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]
    )


def _multiset_marks(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a document's multiset of shingles."""
    marks = []
    with np.errstate(over="ignore"):
        for salt in (1, 2):
            total = np.zeros(n, dtype=np.uint64)
            np.add.at(total, owner, mix(hashes ^ np.uint64(salt << 60)))
            marks.append(total.view(np.int64))
    return marks[0], marks[1]


def _encoded(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).fill_null(b"").to_pylist()


def sign(docs: DataFrame) -> DataFrame:
    """Marks of the multiset, number of shingles and sketch (a byte per component)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for run in text_runs(texts, RUN_BYTES):
                part = _encoded(texts[run])
                hashes, owner = shingle_hashes(part)
                marks = _multiset_marks(hashes, owner, len(part))
                each, of, count, _ = counted(hashes, owner)
                found = signatures(each, of, count, len(part))
                sketch = (found & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[run], pa.array(marks[0]), pa.array(marks[1]),
                        pa.array(np.bincount(owner, minlength=len(part))), _binary(sketch),
                    ],
                    names=["doc_id", "mark0", "mark1", "n", "sketch"],
                )
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(signed, _SIGNED)


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(flat.to_pylist()), np.uint8).reshape(-1, COMPONENTS)


def _bands(classes: DataFrame) -> DataFrame:
    """One row per class and band: the band's number and its bytes, as one key."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _sketches(batch.column("sketch")).reshape(-1, BANDS, BAND_ROWS).astype(np.int64)
            key = np.tile(np.arange(BANDS), (len(parts), 1))
            for k in range(BAND_ROWS):
                key = (key << 8) | parts[:, :, k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel()),
                    pa.array(np.repeat(batch.column("class_no").to_numpy(), BANDS)),
                ],
                names=["band", "class_no"],
            )

    return classes.select("class_no", "sketch").mapInArrow(bands, "band BIGINT, class_no BIGINT")


_GROUP = ["band", "left", "right"]


def _likely(
    table: pa.Table, group: np.ndarray, component: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Agreement and places of the likely pairs of different component, in steps.

    A pair counts in the first band it shares only.
    """
    sketch = _sketches(table["sketch"])
    own = (table["band"].to_numpy() >> (8 * BAND_ROWS)).astype(np.int64)
    mine, left, right = (table[n].to_numpy() for n in ("mine", "left", "right"))
    end = np.searchsorted(group, group, side="right")
    for i, j in windows(np.arange(len(group)) + 1, end, SKETCH_PAIRS):
        apart = (left[i] == right[i]) | (mine[i] != mine[j])
        apart &= component[i] != component[j]
        i, j = i[apart], j[apart]
        same = sketch[i] == sketch[j]
        agree = same.sum(axis=1)
        likely = np.flatnonzero(agree >= LIKELY)
        shared = same[likely].reshape(-1, BANDS, BAND_ROWS).all(axis=2)
        likely = likely[shared.argmax(axis=1) == own[i[likely]]]
        yield agree[likely], i[likely], j[likely]


def _pair_batch(number: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    i, j = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    ends = np.minimum(number[i], number[j]), np.maximum(number[i], number[j])
    return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b"])


class _Held:
    """Likely pairs of a task, in nine bytes each, until the best join a forest."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, agree: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        self._parts.append((agree.astype(np.uint8), i.astype(np.int32), j.astype(np.int32)))
        self.size += len(agree)

    def join(self, forest: Forest) -> list[tuple[int, int]]:
        """The pairs that join two trees, those that agree most first; none stay held."""
        if not self.size:
            return []
        agree, i, j = (np.concatenate(parts) for parts in zip(*self._parts))
        self._parts, self.size = [], 0
        order = np.argsort(np.uint8(COMPONENTS) - agree, kind="stable")
        joined = []
        for at in range(0, len(order), ENDS_AT_ONCE):
            some = order[at : at + ENDS_AT_ONCE]
            ends = zip(i[some].tolist(), j[some].tolist())
            joined += [(x, y) for x, y in ends if forest.joins(x, y)]
        return joined


def _likeliest_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes: per group a forest of the pairs that agree most."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, ["band"]):
            number = table["class_no"].to_numpy()
            forest, held = Forest(len(group)), _Held()
            for found in _likely(table, group, number):
                held.add(*found)
                if held.size > PAIRS_HELD:
                    yield _pair_batch(number, held.join(forest))
            if held.size:
                yield _pair_batch(number, held.join(forest))
        release_memory()

    return in_groups(members, ["band"]).mapInArrow(pairs, "a BIGINT, b BIGINT").distinct()


def _with_likely_others(members: DataFrame) -> DataFrame:
    """The rows that form a likely pair with a row of another component."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, ["band"]):
            marked = np.zeros(len(group), dtype=bool)
            for _, i, j in _likely(table, group, table["component"].to_numpy()):
                marked[i] = marked[j] = True
            slim = table.select([*_GROUP, "mine", "class_no", "component"])
            yield from slim.filter(pa.array(marked)).to_batches()
        release_memory()

    schema = "band BIGINT, left INT, right INT, mine INT, class_no BIGINT, component BIGINT"
    return in_groups(members, ["band"]).mapInArrow(some, schema)


def _group_runs(table: pa.Table, group: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Slices of whole groups with at most ``NUMBERED_BYTES`` of shingles, or of one group."""
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group)).tolist()
    held = np.cumsum(pc.binary_length(table["shingles"]).to_numpy())
    start = last = before = 0
    for end in ends:
        if last > start and held[end - 1] - before > NUMBERED_BYTES:
            yield table.slice(start, last - start), group[start:last]
            start, before = last, held[last - 1]
        last = end
    yield table.slice(start), group[start:]


def _numbered(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of all multisets, end to end, as small numbers; each one's size; how many differ."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    sizes = pc.binary_length(flat).to_numpy().astype(np.int64) // HASH_BYTES
    start = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset]
    hashes = _spread(flat.buffers()[2][start : start + int(sizes.sum()) * HASH_BYTES])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    new = np.zeros(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    del hashes
    ids = np.empty(len(order), np.int32)
    ids[order] = np.cumsum(new, dtype=np.int32)
    return ids, sizes, int(new.sum()) + 1


def _linked_components(members: DataFrame) -> DataFrame:
    """Verified pairs (a, b) that link different components, a forest per group.

    All likely pairs are verified where they meet, so only links leave the task.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = (run for whole in whole_groups(batches, ["band"]) for run in _group_runs(*whole))
        for table, group in runs:
            number, component = (table[n].to_numpy() for n in ("class_no", "component"))
            ids, sizes, different = _numbered(table["shingles"])
            first = np.cumsum(sizes) - sizes
            flags = np.zeros(different, dtype=np.int64)
            forest, found = Forest(len(group)), []
            # Rows of one component are together from the start.
            for rows in np.split(
                order := np.argsort(component, kind="stable"),
                np.flatnonzero(np.diff(component[order])) + 1,
            ):
                for row in rows[1:].tolist():
                    forest.joins(int(rows[0]), row)
            for _, i, j in _likely(table, group, component):
                cuts = np.flatnonzero(np.diff(i)) + 1
                for others in np.split(np.arange(len(i)), cuts):
                    if not len(others):
                        continue
                    one, many = int(i[others[0]]), j[others]
                    flags[ids[first[one] : first[one] + sizes[one]]] = 1
                    n = sizes[many]
                    starts = np.cumsum(n) - n
                    spots = np.arange(int(n.sum())) + np.repeat(first[many] - starts, n)
                    shared = np.add.reduceat(flags[ids[spots]], starts)
                    flags[ids[first[one] : first[one] + sizes[one]]] = 0
                    alike = 100 * shared >= SIMILAR_PCT * (sizes[one] + n - shared)
                    found += [(one, x) for x in many[alike].tolist() if forest.joins(one, x)]
            yield _pair_batch(number, found)
        release_memory()

    return in_groups(members, ["band"]).mapInArrow(pairs, "a BIGINT, b BIGINT").distinct()


def _multisets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The shingles of the given classes: sorted hashes of shingle and repetition.

    The text is that of the class's first document; should that doc_id occur with
    other texts too, the marks tell which one is meant.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for run in text_runs(texts, RUN_BYTES):
                part = _encoded(texts[run])
                hashes, owner = shingle_hashes(part)
                mark0, mark1 = _multiset_marks(hashes, owner, len(part))
                each, of, count, repetition = counted(hashes, owner)
                whole = mix(np.repeat(each, count) ^ mix(repetition.astype(np.uint64)))
                whole &= np.uint64((1 << 8 * HASH_BYTES) - 1)
                of = np.repeat(of, count)
                whole = whole[np.lexsort((whole, of))]
                raw = whole.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
                ends = np.cumsum(np.bincount(of, minlength=len(part))) * HASH_BYTES
                meant = (mark0 == batch.column("mark0")[run].to_numpy()) & (
                    mark1 == batch.column("mark1")[run].to_numpy()
                )
                sets = pa.array([raw[a:b] for a, b in zip([0, *ends[:-1]], ends)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class_no")[run], sets], names=["class_no", "shingles"]
                ).filter(pa.array(meant))
        release_memory()

    wanted = classes.select("class_no", "mark0", "mark1", F.col("first_id").alias("_first"))
    # Texts stay where they are, if the classes are counted to be few; else those that
    # are not wanted are left out by Spark's own runtime filter before the shuffle.
    return (
        docs.select("doc_id", "text")
        .join(broadcast_if_small(wanted), F.expr("doc_id = _first"))
        .select("class_no", "mark0", "mark1", "text")
        .mapInArrow(shingles, "class_no BIGINT, shingles BINARY")
        .groupBy("class_no")
        .agg(F.any_value("shingles").alias("shingles"))
    )


def _spread(raw: bytes | pa.Buffer) -> np.ndarray:
    """The hashes of a multiset, as 64-bit numbers."""
    cut = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    return np.pad(cut, ((0, 0), (0, 8 - HASH_BYTES))).view("<u8").ravel()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose multisets of shingles overlap enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = _spread(x.as_buffer()), _spread(y.as_buffer())
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= SIMILAR_PCT * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        release_memory()

    right = sets.selectExpr("class_no AS b", "shingles AS y")
    left = sets.selectExpr("class_no AS a", "shingles AS x")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(
        verify, "a BIGINT, b BIGINT"
    )


def near_duplicates(docs: DataFrame, block: int | None = None) -> DataFrame:
    """Class, component and verdict of each row of (doc_id, text).

    ``class_id`` is the smallest doc_id with the same shingles, ``component_id``
    the smallest reachable by links; ``kept`` marks one row per component.
    """
    docs = docs.select("doc_id", "text")
    signed = stash(sign(docs), "signatures")
    key = ["mark0", "mark1"]
    classes = (
        signed.where("n > 0")
        .groupBy(*key)
        .agg(
            F.min("doc_id").alias("first_id"), F.any_value("n").alias("n"),
            F.any_value("sketch").alias("sketch"),
        )
        .select(F.monotonically_increasing_id().alias("class_no"), *key, "first_id", "n", "sketch")
    )
    classes = stash(classes, "classes")
    more = {} if block is None else {"block": block}
    comparable = classes.where("first_id IS NOT NULL")
    members = stash(
        shared_buckets(_bands(comparable), ["band"], "class_no", **more), "band-members"
    )
    sketches = classes.select("class_no", "sketch")
    first = stash(_likeliest_pairs(members.join(sketches, "class_no")), "pairs")

    def multisets(wanted: DataFrame) -> DataFrame:
        chosen = classes.drop("sketch").join(wanted.distinct(), "class_no", "left_semi")
        return stash(_multisets(docs, stash(chosen, "wanted")), "multisets")

    ends = first.selectExpr("explode(array(a, b)) AS class_no")
    found = stash(_verified(first, multisets(ends)), "verified")
    parts = components(found).withColumnRenamed("node", "class_no")
    labelled = members.join(parts, "class_no", "left").withColumn(
        "component", F.coalesce("component", "class_no")
    )
    mixed = (
        labelled.groupBy(*_GROUP)
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where("_low < _high")
        .select(*_GROUP)
    )
    apart = labelled.join(mixed, _GROUP, "left_semi").join(sketches, "class_no")
    apart = stash(_with_likely_others(apart), "likely-members")
    sets = multisets(apart.select("class_no"))
    # Met anew in groups whose shingles have a bounded size.
    sized = apart.select("band", "class_no", "component").distinct().join(classes.select("class_no", "n"), "class_no")
    apart = shared_buckets(
        sized, ["band"], "class_no", **more, weight=f"n * {HASH_BYTES}", block_weight=GROUP_BYTES // 2
    ).drop("n")
    rest = apart.join(sketches, "class_no").join(sets, "class_no")
    found = stash(found.union(_linked_components(rest)), "links")

    parts = components(found).withColumnRenamed("node", "class_no")
    joined = classes.drop("sketch").join(parts, "class_no", "left").withColumn(
        "component", F.coalesce("component", "class_no")
    )
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    described = joined.join(least, "component").selectExpr(
        "mark0 AS _m0", "mark1 AS _m1", "first_id AS class_id", "component_id"
    )
    rows = signed.select("doc_id", "n", *key)
    return rows.join(
        described, F.expr("n > 0 AND mark0 = _m0 AND mark1 = _m1"), "left"
    ).selectExpr(
        "doc_id",
        "IF(n > 0, class_id, doc_id) AS class_id",
        "IF(n > 0, component_id, doc_id) AS component_id",
        "n = 0 OR coalesce(doc_id = component_id, doc_id IS NULL AND component_id IS NULL) AS kept",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group of near duplicates, with all its columns.

    It is the one with the smallest doc_id.  Rows are written once with a number
    of their own, so that repeated doc_ids and null ones do no harm.
    """
    row = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))
    rows = stash(row.withColumn("_row", F.monotonically_increasing_id()), "numbered-documents")
    found = near_duplicates(rows.selectExpr("_row AS doc_id", "_doc.text AS text"))
    named = found.selectExpr("doc_id AS _row", "component_id").join(
        rows.selectExpr("_row", "_doc.doc_id AS doc_id"), "_row"
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    first = named.groupBy("component_id").agg(F.min_by("_row", order).alias("_row"))
    return rows.join(first.select("_row"), "_row", "left_semi").select("_doc.*")
