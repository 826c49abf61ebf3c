"""Joining a large table per key when a few keys hold much of it.

AQE splits skewed joins, but not when an aggregate on the same key sits right on
top of the join, because splitting would break the partitioning it relies on.
These helpers split the hot keys beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task can take without trouble.
SLICE_ROWS = 1_000_000
# A hot key holds more than this share of all rows, so there are at most as many
# hot keys, whatever the data, and their list can always be broadcast.
MAX_KEYS = 10_000


class HotKeys:
    """The keys with more rows than one slice, and their number of slices."""

    def __init__(self, counts: DataFrame, key: str, rows: str, slice_rows: int = SLICE_ROWS):
        self.key = key
        total = counts.agg(F.coalesce(F.sum(rows), F.lit(0))).scalar()
        least = F.greatest(F.lit(slice_rows).cast("bigint"), (total / MAX_KEYS).cast("bigint"))
        self.slices = counts.where(F.col(rows) > least).selectExpr(
            f"{key} AS _hot", f"CAST(ceil({rows} / {slice_rows}) AS INT) AS _slices"
        )

    def _marked(self, frame: DataFrame) -> DataFrame:
        return frame.join(F.broadcast(self.slices), F.col(self.key) == F.col("_hot"), "left")

    def spread(self, frame: DataFrame, by: str) -> DataFrame:
        """Add ``_salt``: rows of a hot key fall into its slices by a hash of ``by``."""
        salt = f"CAST(pmod(xxhash64({by}), coalesce(_slices, 1)) AS INT) AS _salt"
        return self._marked(frame).selectExpr(*frame.columns, salt)

    def repeat(self, frame: DataFrame) -> DataFrame:
        """Add ``_salt``: one copy of a hot key's row for each of its slices."""
        salts = "explode(sequence(0, coalesce(_slices, 1) - 1)) AS _salt"
        return self._marked(frame).selectExpr(*frame.columns, salts)
