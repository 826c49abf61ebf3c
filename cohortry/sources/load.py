"""Reading delimited files and normalising text once, at load.

A malformed line either ends the load, or is put aside with its reason
(``load_with_rejects``).  Both ways parse the text once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortry.functions.buckets import first_match
from cohortry.plans import publishing
from cohortry.plans.durable import freeze, scratch_path
from cohortry.plans.sizes import broadcast_if_small
from cohortry.sources.schemas import (
    CONTRACTS,
    EVENT_DOMAINS,
    SALES_FLAT,
    SHIP_MODES,
    SUBSCRIBERS,
    USER_DOMAINS,
    YES_NO,
)

# Text the churn reports compare with a literal.
SUBSCRIBER_TEXT = {
    "churn": YES_NO,
    "tech_support": (*YES_NO, "No internet service"),
    "online_security": (*YES_NO, "No internet service"),
    "contract": CONTRACTS,
}
ORDER_TEXT = {"ship_mode": SHIP_MODES, "returned": YES_NO}
# Group keys without a documented domain.
SUBSCRIBER_KEYS = ("payment_method", "internet_service")
SALES_KEYS = ("segment", "region", "state", "city", "category", "sub_category", "product_name")

# Working columns of a load: the malformed line, and the file it came from.
_LINE, _FILE = "_malformed_line", "_malformed_file"
# Stands after the last value while a malformed line is looked at.
_END = "\x01end\x01"


def canonical(column: Column, domain: Sequence[str]) -> Column:
    """Spell a value the way its domain does, ignoring case and end spaces.

    Values outside the domain only lose their end spaces.
    """
    trimmed = F.rtrim(column)
    cases = [(F.lower(trimmed) == value.lower(), value) for value in domain]
    return first_match(cases, trimmed)


def normalised_columns(schema: StructType, domains: Mapping[str, Sequence[str]]) -> list[Column]:
    """Every text column trimmed, and respelled where its domain is known."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name)
        if field.name in domains:
            value = canonical(value, domains[field.name])
        elif isinstance(field.dataType, StringType):
            value = F.rtrim(value)
        columns.append(value.alias(field.name))
    return columns


def normalise_text(frame: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Trim every text column and respell those with a known domain, so that the
    reports can compare bytes."""
    return frame.select(*normalised_columns(frame.schema, domains))


def one_spelling(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spell every value of the columns in one way, ignoring case and end spaces.

    The most frequent spelling stands for all, of equally frequent ones the last
    by code point.  Runs a job when called: one aggregate over all columns, which
    keeps the values with more than one spelling.
    """
    texts = ", ".join(
        f"struct('{c}' AS _column, lower(rtrim({c})) AS _value, rtrim({c}) AS _text)" for c in columns
    )
    counted = (
        frame.selectExpr(f"inline(array({texts}))")
        .where("_text IS NOT NULL")
        .groupBy("_column", "_value", "_text")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    odd = freeze(
        counted.groupBy("_column", "_value")
        .agg(
            F.count(F.lit(1)).alias("_spellings"),
            F.max_by("_text", F.struct("_rows", "_text")).alias("_one"),
        )
        .where("_spellings > 1")
        .select("_column", "_value", "_one")
    )
    order = frame.columns
    for name in columns:
        own = odd.where(F.col("_column") == name).select("_value", "_one")
        trimmed = F.rtrim(F.col(name))
        frame = (
            frame.join(broadcast_if_small(own), F.lower(trimmed) == F.col("_value"), "left")
            .withColumn(name, F.coalesce("_one", trimmed))
            .select(*order)
        )
    return frame


def read_delimited(
    spark: SparkSession, path: str, schema: StructType, **options
) -> DataFrame:
    """Read a delimited file with a header under a declared schema.

    Columns are matched by position, no type is inferred, and a malformed record
    stops the load instead of turning into NULLs.
    """
    settings = {"header": True, "mode": "FAILFAST", "enforceSchema": True, **options}
    return spark.read.schema(schema).options(**settings).csv(path)


class TooManyRejected(ValueError):
    """A load met more malformed lines than it was allowed to put aside."""


@dataclass(frozen=True)
class Load:
    """A load that put malformed lines aside.

    ``rows`` are the good rows, ``rejected`` has ``file``, ``line`` and ``reason`` of
    each malformed line, and ``n_rows`` and ``n_rejected`` count them.
    """

    rows: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int

    def reasons(self) -> DataFrame:
        """Rejected lines per reason."""
        return self.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))

    def publish_rejected(self, path: str) -> publishing.Version:
        """Publish the rejected lines and their counts, as a version of their own."""
        return publishing.publish(
            {"rejected_lines": self.rejected, "rejected_reasons": self.reasons()}, path
        )


def _reason(line: str, schema: StructType, options: Mapping[str, object]) -> Column:
    """Why a line is malformed: its number of values, or each value of another type.

    The line is cut again, as text and for malformed lines only.  A mark at its end
    shows how many values come before, empty ones included.
    """
    kept = {k: str(v) for k, v in options.items() if k in ("sep", "delimiter", "quote", "escape")}
    separator = kept.get("sep", kept.get("delimiter", ","))
    names = [f"v{i}" for i in range(len(schema) + 1)]
    marked = F.concat(F.col(line), F.lit(separator + _END))
    values = F.from_csv(marked, ", ".join(f"{n} STRING" for n in names), {**kept, "mode": "PERMISSIVE"})
    whole = F.equal_null(values[names[-1]], F.lit(_END))
    # The mark is a value of its own, unless an open quote has taken it in.
    before = F.array(*[F.coalesce(values[n], F.lit("")) for n in names])
    early = ~whole & F.array_contains(before, _END)
    taken = F.exists(before, lambda v: F.endswith(v, F.lit(_END)) & (v != _END))
    found = [F.when(early, "too few values").when(taken, "open quote").when(~whole, "too many values")]
    for name, field in zip(names, schema.fields):
        value = values[name]
        if not isinstance(field.dataType, StringType):
            odd = (F.trim(value) != "") & value.try_cast(field.dataType).isNull()
            found.append(F.when(whole & odd, f"{field.name}: not {field.dataType.simpleString()}"))
    return F.coalesce(F.nullif(F.concat_ws("; ", *found), F.lit("")), F.lit("malformed"))


def load_with_rejects(
    spark: SparkSession, path: str, schema: StructType,
    domains: Mapping[str, Sequence[str]] | None = None, max_rejected: int | None = None, **options,
) -> Load:
    """Load a delimited file; malformed lines are put aside instead of ending the load.

    The text is parsed once, into parquet below the shared folder, which also counts
    good and malformed lines; everything after that reads the parquet.  More than
    ``max_rejected`` malformed lines are an error; their number is in its message.
    """
    if {_LINE, _FILE} & set(schema.fieldNames()):
        raise ValueError(f"columns cannot be called {_LINE} or {_FILE}")
    settings = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}
    parsed = read_delimited(spark, path, StructType([*schema.fields, StructField(_LINE, StringType())]), **settings)
    good = F.col(_LINE).isNull()
    counted = Observation()
    staged = scratch_path(spark, "loaded")
    (
        parsed.select("*", F.col("_metadata.file_path").alias(_FILE))
        .observe(counted, F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"))
        .select(*normalised_columns(schema, domains or {}), _LINE, F.when(~good, F.col(_FILE)).alias(_FILE))
        .write.parquet(staged)
    )
    n_rows, n_rejected = counted.get["rows"], counted.get["rejected"]
    if max_rejected is not None and n_rejected > max_rejected:
        raise TooManyRejected(f"{n_rejected} malformed lines in {path}, {max_rejected} are allowed")
    stored = spark.read.schema(
        StructType([*schema.fields, StructField(_LINE, StringType()), StructField(_FILE, StringType())])
    ).parquet(staged)
    rejected = stored.where(~good).select(
        F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), _reason(_LINE, schema, options).alias("reason")
    )
    return Load(stored.where(good).drop(_LINE, _FILE), rejected, n_rows, n_rejected)


def _load_strictly(
    spark: SparkSession, path: str, schema: StructType, domains: Mapping[str, Sequence[str]], **options
) -> DataFrame:
    """Parse the text once into parquet; a malformed line ends the load at once."""
    typed = normalise_text(read_delimited(spark, path, schema, **options), domains)
    staged = scratch_path(spark, "loaded")
    typed.write.parquet(staged, compression="zstd")
    return spark.read.schema(typed.schema).parquet(staged)


def load_subscribers(spark: SparkSession, path: str, **options) -> DataFrame:
    """The 21-column subscriber table from a delimited file; a bad line ends the load."""
    rows = _load_strictly(spark, path, SUBSCRIBERS, SUBSCRIBER_TEXT, **options)
    return one_spelling(rows, SUBSCRIBER_KEYS)


def load_sales_flat(spark: SparkSession, path: str, **options) -> DataFrame:
    """The flat sales file, ready for ``split_star_schema``; a bad line ends the load."""
    return one_spelling(_load_strictly(spark, path, SALES_FLAT, ORDER_TEXT, **options), SALES_KEYS)


def load_subscribers_with_rejects(
    spark: SparkSession, path: str, max_rejected: int | None = None, **options
) -> Load:
    """The subscriber table, with malformed lines put aside."""
    found = load_with_rejects(spark, path, SUBSCRIBERS, SUBSCRIBER_TEXT, max_rejected, **options)
    return replace(found, rows=one_spelling(found.rows, SUBSCRIBER_KEYS))


def load_sales_flat_with_rejects(
    spark: SparkSession, path: str, max_rejected: int | None = None, **options
) -> Load:
    """The flat sales file, with malformed lines put aside."""
    found = load_with_rejects(spark, path, SALES_FLAT, ORDER_TEXT, max_rejected, **options)
    return replace(found, rows=one_spelling(found.rows, SALES_KEYS))


def normalise_orders(orders: DataFrame) -> DataFrame:
    return normalise_text(orders, ORDER_TEXT)


def normalise_users(users: DataFrame) -> DataFrame:
    return normalise_text(users, USER_DOMAINS)


def normalise_events(events: DataFrame) -> DataFrame:
    return normalise_text(events, EVENT_DOMAINS)
