"""Broadcast hints that rest on a counted size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Most rows and bytes to broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
# Counted for a value of a fixed width, and on top of the bytes of a text.
_VALUE_BYTES = 16


def broadcast_if_small(frame: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast if ``counted`` has few rows and bytes, else leave it to Spark.

    ``counted`` should be checkpointed, so that counting it is cheap, and have at
    least as many rows as ``frame``; it is ``frame`` itself by default.  AQE alone
    would find out too late: by then it has shuffled the large side already.
    """
    counted = frame if counted is None else counted
    size = F.lit(_VALUE_BYTES * len(frame.columns))
    for field in counted.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    row = (
        counted.limit(BROADCAST_ROWS + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(size.cast("bigint")).alias("bytes"))
        .first()
    )
    small = row["rows"] <= BROADCAST_ROWS and (row["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(frame) if small else frame
