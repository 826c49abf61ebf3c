"""Ranked lexical search of a query set over all documents, by dense blocks.

Items are the queries.  Their terms make a compact vocabulary; a task multiplies a
tile of that vocabulary (items by terms, ones where an item has the term) with a tile
of document impacts (terms by documents) by BLAS, and keeps the best documents of
every item.  An impact is a whole number, and a column tile is cut so narrow that no
partial sum of a product reaches 2**53: float64 sums are then exact in any order, and
the tiles are added up as 64-bit integers.

Steps, each a Spark job over whole texts:

1. items become term sets; only vocabularies of bounded size reach the workers.
   A larger query set is worked through in groups of items, by a hash of the item.
2. texts are cut into terms once, in Arrow; what is stored per document is its
   number of terms and the counts of the vocabulary's terms.
3. document frequencies, the number of documents and of terms are sums over that.
4. tasks multiply tiles and keep the best per item; a window over salted items, then
   over items, merges them.  Equal scores go by doc_id, also at the edge of a tile.

Rows: items of one item_id are one item with the terms of all its rows, null being an
item_id like others; an item without terms, or whose terms no document holds, has no
rows.  A null or empty text has no term and is no document of the counts.  Documents
with equal doc_ids are documents of their own, in any order among equal scores; a null
doc_id comes first.  Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import keep_columns, stash
from cohortry.llm.tokens import text_runs

# Fixed value: what separates terms, as in the contract; the rest are terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes and number of the different (item, term) pairs that one pass holds.
PASS_BYTES = 32 << 20
PASS_PAIRS = 1_000_000
# Documents of a tile, and its most terms.
TILE_DOCS = 512
TILE_TERMS = 2048
# Items of a tile.
TILE_ITEMS = 512
# Parts in which the best documents of an item are merged first.
SALTS = 32

COUNTED = "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, counts ARRAY<BIGINT>"
BEST = "item INT, doc_id BIGINT, score BIGINT, part INT"


def cut(texts: pa.Array) -> pa.ListArray:
    """The terms of each text; empty strings may stand before and after them."""
    return pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)


def item_terms(items: DataFrame) -> DataFrame:
    """Different (item_id, term) pairs."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in text_runs(batch.column(1)):
                words = cut(batch.column(1)[run])
                keys = batch.column(0)[run].take(pc.list_parent_indices(words))
                yield pa.RecordBatch.from_arrays([keys, words.flatten()], names=["item_id", "term"])

    return (
        items.selectExpr("CAST(item_id AS BIGINT) AS item_id", "text")
        .mapInArrow(split, "item_id BIGINT, term STRING")
        .where("term <> ''")
        .distinct()
    )


def count_terms(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document: its number of terms, and the counts of the vocabulary's terms."""
    known = pa.array(vocabulary, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in text_runs(batch.column(1)):
                words = cut(batch.column(1)[run])
                bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
                flat = words.flatten()
                real = np.concatenate(([0], np.cumsum(pc.not_equal(flat, "").to_numpy(False))))
                total = real[bounds[1:]] - real[bounds[:-1]]
                term = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy()
                place = np.flatnonzero(term >= 0)
                doc = np.searchsorted(bounds, place, side="right") - 1
                key, times = np.unique(doc * max(1, len(known)) + term[place], return_counts=True)
                ends = np.searchsorted(key, np.arange(len(total) + 1) * max(1, len(known)))
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
                    for values, kind in ((key % max(1, len(known)), pa.int32()), (times, pa.int64()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[run], pa.array(total, pa.int64()), *lists],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(count, COUNTED)


class Best:
    """The best documents of every item so far."""

    def __init__(self, items: int, top: int):
        self._top = top
        self._found = [(np.empty(0, np.int64),) * 3 for _ in range(items)]

    def add(self, first: int, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        """Take in a tile of scores (items by documents).

        A document below the score of an item's last place is left out; those that
        equal it stay until the order by doc_id decides.  ``known`` is 0 for a null
        doc_id, which sorts first.
        """
        for i in np.flatnonzero(scores.max(axis=1, initial=0) > 0):
            old_scores, old_known, old_docs = self._found[first + i]
            least = old_scores[-1] if len(old_scores) == self._top else 1
            new = np.flatnonzero(scores[i] >= max(1, least))
            if not len(new):
                continue
            joined = [
                np.concatenate(pair)
                for pair in ((old_scores, scores[i][new]), (old_known, known[new]), (old_docs, docs[new]))
            ]
            order = np.lexsort((joined[2], joined[1], -joined[0]))[: self._top]
            self._found[first + i] = tuple(column[order] for column in joined)

    def rows(self, part: int) -> pa.RecordBatch:
        sizes = [len(found[0]) for found in self._found]
        scores, known, docs = (np.concatenate(column) for column in zip(*self._found))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array(docs, pa.int64(), mask=known == 0), pa.array(scores, pa.int64()),
                pa.array(np.full(len(docs), part), pa.int32()),
            ],
            names=["item", "doc_id", "score", "part"],
        )


def terms_per_product(weights: np.ndarray) -> int:
    """Terms of a column tile, so that no sum of impacts reaches 2**53.

    The part of an impact that depends on the document is below 1,000,000.
    """
    largest = max(1, int(weights.max(initial=1))) * 1_000_000
    if largest >= 1 << 53:
        raise ValueError("a single impact cannot be held exactly")
    return min(TILE_TERMS, ((1 << 53) - 1) // largest)


def score_tile(has: np.ndarray, weights: np.ndarray, doc: np.ndarray, term: np.ndarray,
               count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Scores (items by documents) of one tile of documents.

    ``has`` is items by terms; ``doc``, ``term`` and ``count`` list the terms of the
    documents, ``length`` is the documents' m.
    """
    impact = weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * length[doc]))
    present, column = np.unique(term, return_inverse=True)
    scores = np.zeros((len(has), len(length)), np.int64)
    width = terms_per_product(weights)
    for first in range(0, len(present), width):
        inside = (column >= first) & (column < first + width)
        impacts = np.zeros((min(width, len(present) - first), len(length)))
        impacts[column[inside] - first, doc[inside]] = impact[inside]
        scores += (has[:, present[first : first + width]] @ impacts).astype(np.int64)
    return scores


def best_documents(counted: DataFrame, members: list[np.ndarray], weights: np.ndarray, n_docs: int,
                   n_terms: int, top: int) -> DataFrame:
    """Every task's best documents of every item (numbered by place in ``members``)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = []
        for first in range(0, len(members), TILE_ITEMS):
            part = members[first : first + TILE_ITEMS]
            # Compact: the terms of these items only.
            own, place = np.unique(np.concatenate(part), return_inverse=True)
            has = np.zeros((len(part), len(own)))
            has[np.repeat(np.arange(len(part)), [len(m) for m in part]), place] = 1
            where = np.full(len(weights), -1)
            where[own] = np.arange(len(own))
            tiles.append((first, has, weights[own], where))
        best = Best(len(members), top)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                rows = batch.slice(at, TILE_DOCS)
                terms, counts = rows.column(2), rows.column(3)
                doc = pc.list_parent_indices(terms).to_numpy()
                term, count = terms.flatten().to_numpy(), counts.flatten().to_numpy()
                length = 50 + (50 * rows.column(1).to_numpy() * n_docs) // n_terms
                keys = pc.fill_null(rows.column(0), 0).to_numpy()
                known = pc.is_valid(rows.column(0)).to_numpy(False).astype(np.int64)
                for first, has, own_weights, where in tiles:
                    inside = where[term] >= 0
                    if inside.any():
                        scores = score_tile(
                            has, own_weights, doc[inside], where[term[inside]], count[inside], length
                        )
                        best.add(first, scores, keys, known)
        yield best.rows(TaskContext.get().partitionId())

    return counted.where("size(terms) > 0").mapInArrow(search, BEST)


def _merged(best: DataFrame, top: int) -> DataFrame:
    order = "ORDER BY score DESC, doc_id"
    return (
        best.selectExpr("*", f"row_number() OVER (PARTITION BY item, part % {SALTS} {order}) AS _place")
        .where(f"_place <= {top}")
        .selectExpr("item", "doc_id", "score", f"row_number() OVER (PARTITION BY item {order}) AS rank")
        .where(f"rank <= {top}")
    )


def _search_pass(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame | None:
    """One group of items, whose (item_id, term) pairs are known to be few."""
    found = pairs.toArrow()
    if not found.num_rows:
        return None
    spark = docs.sparkSession
    terms = found["term"].combine_chunks().dictionary_encode()
    keys = found["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    place = keys.indices.to_numpy()
    order = np.argsort(place, kind="stable")
    members = np.split(
        terms.indices.to_numpy()[order], np.cumsum(np.bincount(place, minlength=len(keys.dictionary)))[:-1]
    )
    vocabulary = terms.dictionary.to_pylist()

    counted = stash(count_terms(docs, vocabulary), "term-counts")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms:
        return None
    frequency = np.zeros(len(vocabulary))
    # At most a row per term of the vocabulary.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * frequency + 1))).astype(np.int64)
    best = stash(best_documents(counted, members, weights, n_docs, n_terms, top), "best-documents")
    names = spark.createDataFrame(
        [(i, key) for i, key in enumerate(keys.dictionary.to_pylist())], "item INT, item_id BIGINT"
    )
    # The items of one pass: bounded as their pairs are.
    return (
        _merged(best, top)
        .join(F.broadcast(names), "item")
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )


def search(docs: DataFrame, items: DataFrame, top: int = 50, pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """The ``top`` documents of each item, as (item_id, rank, doc_id, score)."""
    docs = keep_columns(docs, "doc_id", "text")
    pairs = stash(item_terms(keep_columns(items, "item_id", "text")), "item-terms")
    n, size = pairs.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))
    ).first()
    groups = max(1, -(-n // pass_pairs), -(-size // PASS_BYTES))
    passes = (
        _search_pass(docs, pairs.where(f"pmod(xxhash64(item_id), {groups}) = {g}"), top)
        for g in range(groups)
    )
    found = [p for p in passes if p is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")
    return reduce(DataFrame.unionAll, found)
