"""Load checks: keys, references and value domains, as counts.

Spark does not enforce constraints, so each check is a job with one result row
per constraint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cohortry.plans.durable import store
from cohortry.plans.identity import NumberedTable, number_rows


# Words of 64 parent keys that are sent to every task: 16 MB.
MEMBER_WORDS = 1_000_000


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    )


def check_primary_key(frame: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Rows, rows with a NULL in the key, repeated keys and the rows holding them."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = ~missing & (F.col("_rows") > 1)
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_rows"))), F.lit(0)).alias("repeated_rows"),
    )


def key_words(parent: DataFrame, key: str) -> DataFrame:
    """The integer keys of a table as sets of 64 consecutive keys: ``_word`` and ``_bits``.

    Exact, and a 64th of the rows where keys are dense.  Store it to check several
    children, or each new batch of one, without reading the parent again.
    """
    return (
        parent.where(F.col(key).isNotNull())
        .select(F.col(key).cast("bigint").alias("_k"))
        .groupBy(F.expr("shiftright(_k, 6)").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(_k & 63 AS INT)))").alias("_bits"))
    )


def _without_members(child: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of ``child`` whose ``_key`` is in no word; members stay where they are."""
    # Counted by the caller: at most MEMBER_WORDS rows of two numbers.
    return (
        child.join(F.broadcast(words), F.expr("shiftright(_key, 6) = _word"), "left")
        .where("_bits IS NULL OR shiftright(_bits, CAST(_key & 63 AS INT)) & 1 = 0")
        .select("_key")
    )


def orphans(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, words: DataFrame | None = None
) -> DataFrame:
    """Keys of the child that the parent lacks, with their rows; NULL passes.

    Integer keys are looked up in the parent's ``key_words`` where they lie, so that
    only rows without a parent are shuffled.  Other keys, and parents with more than
    ``MEMBER_WORDS`` words, take an anti-join; the child is counted per key before, so
    hot keys are one row.  ``child`` may be the new rows of a table only.
    """
    types = {f.name: f.dataType for f in (*child.schema.fields, *parent.schema.fields)}
    own = child.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    if isinstance(types[key], IntegralType) and isinstance(types[parent_key], IntegralType):
        words, n = store(key_words(parent, parent_key)) if words is None else (words, words.count())
        if n <= MEMBER_WORDS:
            own = _without_members(own.select(F.col("_key").cast("bigint").alias("_key")), words)
            return own.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"))
    per_key = own.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_key).alias("_parent_key"))
    return per_key.join(known, F.col("_key") == F.col("_parent_key"), "left_anti")


def check_foreign_key(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str,
    words: DataFrame | None = None,
) -> DataFrame:
    """Orphaned keys and the rows holding them; ``words`` are stored ``key_words``."""
    return orphans(child, key, parent, parent_key, words).agg(
        F.lit(name).alias("constraint_name"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
    )


def check_domain(
    frame: DataFrame, name: str, domains: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per column: rows outside its list of values, and rows without a value.

    All columns are checked in one scan.
    """
    counts = []
    for column, values in domains.items():
        outside = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        counts.append(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.count_if(outside).alias("outside_rows"),
                F.count_if(F.col(column).isNull()).alias("null_rows"),
            )
        )
    return frame.agg(F.array(*counts).alias("_checks")).select(F.inline("_checks"))


EVENT_ORDER = ("event_date", "user_id", "event_type")


def event_table(spark: SparkSession, path: str) -> NumberedTable:
    """The stored events below ``path``; a new batch continues the event ids."""
    return NumberedTable(spark, path, EVENT_ORDER, "event_id")


def assign_event_id(events: DataFrame) -> DataFrame:
    """Dense 1..N event ids in the order of date, user and type, for one load.

    ``event_table`` keeps ids over several loads.
    """
    return number_rows(events, EVENT_ORDER, "event_id")
