"""Exact distinct counts that merge: sets of dense ids as bitmaps.

A distinct count over months cannot be added up to quarters, because a customer of two
months counts once.  Sets can: a set is stored as bitmaps of 32,768 ids each, per group
and bucket, and the set of a quarter is the bitwise or of its months.  Building, merging
and counting are Spark's own bitmap aggregates, which combine before the shuffle; no row
is multiplied per distinct column, as a count of several distinct columns would do.

Ids must be dense, or bitmaps would hold a few bits each.  ``KeyNumbers`` gives every
key of a column a number once; keys of later batches continue.  Orders of one month thus
fill few buckets, and customers at most all buckets once a month.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.plans.durable import store
from cohortry.plans.identity import NumberedTable
from cohortry.plans.ledger import Ledger


class KeyNumbers:
    """Dense numbers for the values of a key column, kept below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._table = NumberedTable(spark, path, ["key"], "number")
        self._spark = spark

    def extend(self, keys: DataFrame, batch: str) -> None:
        """Number the values of the only column of ``keys`` that have no number yet.

        ``batch`` names the delivery; one that comes again adds nothing.
        """
        name = keys.columns[0]
        new = keys.where(F.col(name).isNotNull()).select(F.col(name).alias("key")).distinct()
        if self._table.entries():
            new = new.join(self.frame(), "key", "left_anti")
        self._table.append(new, batch)

    def frame(self) -> DataFrame:
        """``key`` and ``number`` of all keys so far."""
        return self._table.read().select("key", "number")


def build_sets(rows: DataFrame, groups: Sequence[str], numbers: Mapping[str, str]) -> DataFrame:
    """Sets of dense numbers per group: groups, ``what``, ``bucket`` and ``bits``.

    ``numbers`` maps the name of a set to its number column; a NULL is in no set.
    """
    entries = F.array(
        *[F.struct(F.lit(what).alias("what"), F.col(column).cast("bigint").alias("_n")) for what, column in numbers.items()]
    )
    return (
        rows.select(*groups, F.inline(entries))
        .where("_n IS NOT NULL")
        .groupBy(*groups, "what", F.bitmap_bucket_number("_n").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits"))
    )


def merge_sets(sets: DataFrame, groups: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """The unions of the sets per coarser group (or of the same group in several parts)."""
    named = groups if isinstance(groups, Mapping) else {g: F.col(g) for g in groups}
    return sets.groupBy(*[c.alias(n) for n, c in named.items()], "what", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )


def count_sets(sets: DataFrame, groups: Sequence[str], whats: Sequence[str]) -> DataFrame:
    """Distinct values per group: a column per name in ``whats``.

    A group and bucket must have one row, as ``build_sets`` and ``merge_sets`` give.
    """
    counted = [
        F.coalesce(F.sum(F.when(F.col("what") == what, F.bitmap_count("bits"))), F.lit(0)).alias(what)
        for what in whats
    ]
    return sets.groupBy(*groups).agg(*counted)


class SalesSets:
    """Sums, order sets and customer sets per month and state, kept below ``path``.

    Each delivery of order lines is read once.  Reports over any months, quarters or
    states read the stored sets, whose size follows the keys and not the lines.
    """

    GROUPS = ("month", "region", "state")
    WHATS = ("orders", "customers")

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._log = Ledger(spark, f"{self._path}/log")
        self._numbers = {
            what: KeyNumbers(spark, f"{self._path}/keys/{what}") for what in self.WHATS
        }

    def _entries(self) -> list[dict]:
        return [self._log.read(number) for number in self._log.numbers()]

    def append(self, orders: DataFrame, customers: DataFrame, batch: str) -> None:
        """Bring in a delivery of order lines; one that comes again changes nothing."""
        if batch in {entry["key"] for entry in self._entries()}:
            return
        places = customers.select("customer_id", "region", "state")
        # One row per order and customer before anything is joined.
        lines = (
            orders.groupBy(F.trunc("order_date", "month").alias("month"), "order_id", "customer_id")
            .agg(*[F.sum(c).alias(c) for c in ("sales", "profit", "discount")], F.count("discount").alias("discounts"))
            .join(places, "customer_id", "left")
        )
        lines, _ = store(lines)
        numbered = lines
        for what, column in (("orders", "order_id"), ("customers", "customer_id")):
            self._numbers[what].extend(lines.select(column), batch)
            known = self._numbers[what].frame().select(
                F.col("key").alias(f"_key_{what}"), F.col("number").alias(f"_{what}")
            )
            numbered = numbered.join(known, F.col(column) == F.col(f"_key_{what}"), "left")
        folder = f"batches/{uuid.uuid4().hex}"
        build_sets(numbered, self.GROUPS, {w: f"_{w}" for w in self.WHATS}).write.parquet(
            f"{self._path}/{folder}/sets"
        )
        lines.groupBy(*self.GROUPS).agg(
            *[F.sum(c).alias(c) for c in ("sales", "profit", "discount", "discounts")]
        ).write.parquet(f"{self._path}/{folder}/sums")
        for _ in range(20):
            entries, numbers = self._entries(), self._log.numbers()
            if batch in {entry["key"] for entry in entries}:
                return
            if self._log.commit((numbers[-1] if numbers else 0) + 1, {"key": batch, "folder": folder}):
                return
        raise RuntimeError("other writers took every number that was tried")

    def _read(self, part: str) -> DataFrame:
        folders = [f"{self._path}/{entry['folder']}/{part}" for entry in self._entries()]
        if not folders:
            raise LookupError(f"no order lines were brought in at {self._path}")
        return self._spark.read.parquet(*folders)

    def by(self, groups: Mapping[str, Column]) -> DataFrame:
        """Sums and exact distinct orders and customers per group.

        ``groups`` names expressions over month, region and state.
        """
        sums = self._read("sums").groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
            *[F.sum(c).alias(c) for c in ("sales", "profit", "discount", "discounts")]
        )
        counts = count_sets(merge_sets(self._read("sets"), groups), list(groups), self.WHATS)
        same = [sums[n].eqNullSafe(F.col(f"_g_{n}")) for n in groups]
        counts = counts.select(*[F.col(n).alias(f"_g_{n}") for n in groups], *self.WHATS)
        return sums.join(counts, same, "left").select(
            *groups, "sales", "profit", "discount", "discounts",
            *[F.coalesce(w, F.lit(0)).alias(w) for w in self.WHATS],
        )
