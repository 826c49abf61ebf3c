"""Cutting lineage with tables in the shared folder, and small column helpers.

The shared folder is the one ``spark.checkpoint.dir`` names.  A written table
survives lost executors, is compressed, and can be read again column by column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from cohortry.plans.durable import scratch_path


def stash(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` below the shared folder and read it back.

    The caller's schema is given for reading, so that no job infers it and an
    empty table keeps its columns.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def keep_columns(frame: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with working columns."""
    return frame.select(*[f"`{name}`" for name in names])


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
