"""Dense ids that continue from batch to batch.

A numbered table is a folder:

    batches/<id>/rows       the rows of one batch, sorted, with their place
    batches/<id>/slices     per sorted range, the rows that lie in ranges before it
    log/<number>            a small file: which batch is ``number``, and its first id

A batch is written once, in order; its log entry then gives it the ids after the
highest one so far.  An id is the batch's first id, plus the rows of earlier ranges,
plus the place in the range, so it never changes once the entry is committed, and no
row is rewritten when a batch comes later.  The entry carries the batch's own key:
a batch that is appended again, after a failure or by mistake, is found there and
keeps its ids.

Ties in the order are broken by the place of the row in the batch as it arrived (file
and row in it), which costs nothing and is the same when a task is run again.  It also
spreads rows that are equal in everything over several ranges.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from cohortry.plans.durable import scratch_path
from cohortry.plans.ledger import Ledger

# monotonically_increasing_id(): partition number above, place in it below.
_PLACE_BITS = 33
_TRIES = 20

_SPOT = StructField("_spot", LongType())
_SLICES = StructType([StructField("_slice", IntegerType()), StructField("_before", LongType())])


class NumberedTable:
    """A table below ``path`` whose rows get the ids 1, 2, ... in column ``name``.

    ``order`` sorts the rows within a batch.  All batches have the same columns.
    """

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str], name: str):
        self._spark, self._path, self._order, self._name = spark, path.rstrip("/"), list(order), name
        self._log = Ledger(spark, f"{self._path}/log")

    def entries(self) -> list[dict]:
        """The committed batches in order: key, folder, first id and number of rows."""
        return [self._log.read(number) for number in self._log.numbers()]

    def high_water(self) -> int:
        """The highest id given out so far."""
        found = self._log.latest()
        return found[1]["first"] + found[1]["rows"] - 1 if found else 0

    def _write(self, batch: DataFrame) -> tuple[str, int]:
        """Write the batch in order; returns its folder and number of rows.

        One shuffle: the ranges.  The batch is first written as it comes, so that the
        place of a row is fixed before anything is sampled or sorted by it.
        """
        folder = f"batches/{uuid.uuid4().hex}"
        where = f"{self._path}/{folder}"
        arrived, counted = scratch_path(self._spark, "arrived"), Observation()
        batch.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(arrived)
        tie = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
        order = [*map(F.col, self._order), F.col("_file"), F.col("_row")]
        (
            self._spark.read.schema(batch.schema).parquet(arrived)
            .select("*", tie[0].alias("_file"), tie[1].alias("_row"))
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .select(*_names(batch), F.monotonically_increasing_id().alias("_spot"))
            .write.parquet(f"{where}/rows")
        )
        sizes = (
            self._spark.read.schema(StructType([_SPOT])).parquet(f"{where}/rows")
            .groupBy(_slice().alias("_slice"))
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        # One row per range: bounded by the number of shuffle partitions.
        sizes.selectExpr(
            "_slice",
            """coalesce(sum(_n) OVER (ORDER BY _slice
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before""",
        ).coalesce(1).write.parquet(f"{where}/slices")
        return folder, counted.get["rows"]

    def append(self, batch: DataFrame, key: str) -> DataFrame:
        """Number a batch and return it with its ids.

        ``key`` names the batch.  If it was appended before, nothing is written and
        the rows come back as they were numbered then.
        """
        clash = {"_file", "_row", "_spot", "_slice", "_before", self._name} & set(batch.columns)
        if clash:
            raise ValueError(f"columns of the batch cannot be called {', '.join(sorted(clash))}")
        written = None
        for _ in range(_TRIES):
            known = {entry["key"]: entry for entry in self.entries()}
            if key in known:
                return self._read(known[key], batch.schema)
            written = written or self._write(batch)
            numbers = self._log.numbers()
            # The first id follows from the entry just read; should another batch be
            # committed in between, this number is taken and the next try reads again.
            last = self._log.read(numbers[-1]) if numbers else {"first": 1, "rows": 0}
            entry = {
                "key": key, "folder": written[0], "first": last["first"] + last["rows"],
                "rows": written[1], "schema": batch.schema.json(),
            }
            if self._log.commit((numbers[-1] if numbers else 0) + 1, entry):
                return self._read(entry, batch.schema)
        raise RuntimeError("other writers took every number that was tried")

    def _read(self, entry: dict, schema: StructType) -> DataFrame:
        where = f"{self._path}/{entry['folder']}"
        rows = self._spark.read.schema(StructType([*schema.fields, _SPOT])).parquet(f"{where}/rows")
        slices = self._spark.read.schema(_SLICES).parquet(f"{where}/slices")
        number = F.lit(entry["first"]) + F.col("_before") + F.col("_spot").bitwiseAND((1 << _PLACE_BITS) - 1)
        # One row per range: bounded by the number of shuffle partitions.
        return rows.withColumn("_slice", _slice()).join(F.broadcast(slices), "_slice").select(
            number.alias(self._name), *[f"`{n}`" for n in schema.fieldNames()]
        )

    def read(self) -> DataFrame:
        """All batches committed so far, with their ids."""
        entries = self.entries()
        if not entries:
            raise LookupError(f"no batch was appended at {self._path}")
        frames = [
            self._read(entry, StructType.fromJson(json.loads(entry["schema"]))) for entry in entries
        ]
        found = frames[0]
        for frame in frames[1:]:
            found = found.unionByName(frame)
        return found


def number_rows(frame: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Dense 1..N numbers in ``order``, for one batch that nothing follows.

    Runs jobs when called; rows that are equal in ``order`` are numbered as they come.
    """
    path = scratch_path(frame.sparkSession, "numbered")
    return NumberedTable(frame.sparkSession, path, order, name).append(frame, "all")


def _names(frame: DataFrame) -> list[str]:
    return [f"`{name}`" for name in frame.columns]


def _slice() -> Column:
    return F.shiftright("_spot", _PLACE_BITS).cast("int")
