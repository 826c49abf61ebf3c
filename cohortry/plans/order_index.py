"""Ranks that follow inserts, from a stored index of the sort order.

The index holds the rows per different key, cut into ranges of the first order
column, and within each range the rows that come before a key.  A rank is that, plus
the rows of the ranges before.  Rows that come in later are counted per key and change
only the ranges their keys lie in: those are read, merged and written anew, all other
ranges stay as they are and merely start later.

A key that a third of the rows share is one row of the index.  Ranges never cut a
value of the first column, so equal keys are always in one range.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.plans.ledger import Ledger
from cohortry.plans.selection import literal
from cohortry.plans.sizes import broadcast_if_small

# Ranges of a new index.
RANGES = 256


class OrderIndex:
    """Competition ranks by ``order``, kept below ``path``.

    ``order`` lists ``(column, descending)``; the first column must be a number, date or
    time.  ``ranks`` maps a rank column to the columns it is ranked within (none: over
    all rows).  NULLs sort lowest.  One writer at a time; a second one is refused.
    """

    def __init__(
        self, spark: SparkSession, path: str, order: Sequence[tuple[str, bool]],
        ranks: Mapping[str, Sequence[str]], ranges: int = RANGES,
    ):
        self._spark, self._path, self._ranges = spark, path.rstrip("/"), ranges
        self._order, self._ranks = list(order), {n: list(w) for n, w in ranks.items()}
        self._log = Ledger(spark, f"{self._path}/log")
        columns = [c for c, _ in order]
        self._groups = sorted({c for within in self._ranks.values() for c in within})
        self._keys = [*self._groups, *[c for c in columns if c not in self._groups]]

    def _range(self, bounds: list[str], kind: str) -> Column:
        """The range of a row: how many bounds lie below its first column."""
        values = ", ".join(literal(b, kind) for b in bounds)
        first = self._order[0][0]
        below = f"size(filter(CAST(array({values}) AS ARRAY<{kind}>), b -> b < {first}))"
        return F.expr(f"IF({first} IS NULL, -1, {below})").cast("int")

    def _counted(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self._keys).agg(F.count(F.lit(1)).alias("_n"))

    def _before(self, name: str) -> Column:
        """Rows of the range, and of the group ranked within, with an earlier key."""
        within = ", ".join(["_range", *self._ranks[name]])
        sort = ", ".join(f"{c} {'DESC' if d else 'ASC'}" for c, d in self._order)
        window = f"OVER (PARTITION BY {within} ORDER BY {sort} RANGE BETWEEN"
        return F.expr(
            f"sum(_n) {window} UNBOUNDED PRECEDING AND CURRENT ROW)"
            f" - sum(_n) {window} CURRENT ROW AND CURRENT ROW)"
        ).alias(f"_before_{name}")

    def _write(self, counted: DataFrame) -> tuple[str, list[int]]:
        """Write whole ranges to a new folder; the folder and the ranges in it."""
        folder = f"ranges/{uuid.uuid4().hex}"
        where = f"{self._path}/{folder}"
        indexed = counted.select("_range", *self._keys, "_n", *[self._before(n) for n in self._ranks])
        indexed.repartition("_range").write.partitionBy("_range").parquet(where)
        # At most one row per range.
        found = self._spark.read.parquet(where).select("_range").distinct().collect()
        return folder, sorted(r["_range"] for r in found)

    def build(self, rows: DataFrame) -> None:
        """Index all rows anew, with ranges that hold about as many rows each."""
        first = self._order[0][0]
        kind = dict(rows.dtypes)[first]
        shares = [i / self._ranges for i in range(1, self._ranges)]
        found = rows.agg(F.percentile_approx(first, shares, 10 * self._ranges).alias("b")).first()["b"]
        bounds = sorted({b for b in found or () if b is not None})
        bounds = [str(b) for b in bounds]
        counted = self._counted(rows).withColumn("_range", self._range(bounds, kind))
        self._commit(bounds, kind, counted.schema, {}, counted)

    def insert(self, rows: DataFrame) -> list[int]:
        """Bring in further rows; returns the ranges that were read and written anew."""
        number, entry = self._latest()
        new = self._counted(rows).withColumn("_range", self._range(entry["bounds"], entry["kind"]))
        new = new.select("_range", *self._keys, "_n")
        # At most one row per range.
        changed = sorted(r["_range"] for r in new.select("_range").distinct().collect())
        if not changed:
            return []
        kept = {int(r): f for r, f in entry["ranges"].items() if int(r) not in changed}
        old = [self._stored(entry, [r]) for r in changed if str(r) in entry["ranges"]]
        parts = [part.select("_range", *self._keys, "_n") for part in old]
        merged = (
            reduce(DataFrame.unionByName, parts, new).groupBy("_range", *self._keys).agg(F.sum("_n").alias("_n"))
        )
        self._commit(entry["bounds"], entry["kind"], new.schema, kept, merged, number)
        return changed

    def _commit(self, bounds, kind, schema, kept, counted, after: int | None = None) -> None:
        folder, written = self._write(counted)
        ranges = {**{str(r): f for r, f in kept.items()}, **{str(r): folder for r in written}}
        number = after if after is not None else (self._log.numbers() or [0])[-1]
        names = [f.name for f in schema.fields]
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        entry = {"bounds": bounds, "kind": kind, "ranges": ranges,
                 "columns": [[n, types[n]] for n in names if n in (*self._keys, "_n")]}
        if not self._log.commit(number + 1, entry):
            raise RuntimeError("another writer has changed the index meanwhile; insert again")

    def _latest(self) -> tuple[int, dict]:
        found = self._log.latest()
        if found is None:
            raise LookupError(f"no index was built at {self._path}")
        return found

    def _stored(self, entry: dict, ranges: Sequence[int]) -> DataFrame:
        """The index rows of some ranges; only their folders are read."""
        by_folder: dict[str, list[int]] = {}
        for r in ranges:
            by_folder.setdefault(entry["ranges"][str(r)], []).append(r)
        columns = ", ".join(
            [*[f"`{n}` {k}" for n, k in entry["columns"]], *[f"_before_{n} BIGINT" for n in self._ranks], "_range INT"]
        )
        schema = StructType.fromDDL(columns)
        frames = [
            self._spark.read.schema(schema).option("basePath", f"{self._path}/{folder}").parquet(
                *[f"{self._path}/{folder}/_range={r}" for r in chosen]
            )
            for folder, chosen in by_folder.items()
        ]
        return reduce(DataFrame.unionByName, frames)

    def index(self) -> DataFrame:
        """Every different key with its ranks: the key columns and the rank columns."""
        _, entry = self._latest()
        stored = self._stored(entry, sorted(map(int, entry["ranges"])))
        # Ranges ascend with the first column; a descending order walks them backwards.
        step = "DESC" if self._order[0][1] else "ASC"
        found = stored
        for name, within in self._ranks.items():
            group = f"PARTITION BY {', '.join(within)} " if within else ""
            starts = stored.groupBy("_range", *within).agg(F.sum("_n").alias("_rows")).selectExpr(
                "_range AS _r", *[f"{c} AS _w_{c}" for c in within],
                f"""coalesce(sum(_rows) OVER ({group}ORDER BY _range {step}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _start_{name}""",
            )
            same = " AND ".join(["_range = _r", *[f"{c} <=> _w_{c}" for c in within]])
            # One row per range, or per range and group.
            starts = starts if within else F.broadcast(starts)
            found = found.join(starts, F.expr(same)).drop("_r", *[f"_w_{c}" for c in within])
        return found.select(
            *self._keys, *[(F.col(f"_start_{n}") + F.col(f"_before_{n}") + 1).alias(n) for n in self._ranks]
        )

    def rank(self, rows: DataFrame) -> DataFrame:
        """``rows``, all of which the index holds, with their rank columns."""
        ranks = self.index()
        keyed = ranks.select(*[F.col(c).alias(f"_k_{c}") for c in self._keys], *self._ranks)
        same = " AND ".join(f"{c} <=> _k_{c}" for c in self._keys)
        return rows.join(broadcast_if_small(keyed), F.expr(same)).select(
            *[f"`{c}`" for c in rows.columns], *self._ranks
        )
