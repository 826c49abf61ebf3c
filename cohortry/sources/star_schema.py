"""Splitting a flat sales file into customers, products, orders and returns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.sources.schemas import (
    SALES_CUSTOMERS,
    SALES_ORDERS,
    SALES_PRODUCTS,
    SALES_RETURNS,
)


@dataclass(frozen=True)
class StarSchema:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    returns: DataFrame
    conflicts: DataFrame


def _dimension(flat: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per key: the smallest combination of its attributes.

    ``_variants`` counts the combinations in the flat file.  The lines are first
    reduced to distinct combinations, which a hash aggregate does before the
    shuffle; the smallest one is then picked among few rows.
    """
    return (
        flat.where(F.col(key).isNotNull())
        .select(key, *attributes)
        .distinct()
        .groupBy(key)
        .agg(F.min(F.struct(*attributes)).alias("_first"), F.count(F.lit(1)).alias("_variants"))
        .select(key, "_first.*", "_variants")
    )


def split_star_schema(flat: DataFrame) -> StarSchema:
    """Split a flat line-grain file; keys with several spellings are counted."""
    people = _dimension(flat, "customer_id", SALES_CUSTOMERS.fieldNames()[1:])
    goods = _dimension(flat, "product_id", SALES_PRODUCTS.fieldNames()[1:])
    returned = (
        flat.where(F.col("returned").isNotNull())
        .select("order_id", "returned")
        .distinct()
        .groupBy("order_id")
        .agg(F.max("returned").alias("returned"))
    )

    def report(name: str, dimension: DataFrame) -> DataFrame:
        return dimension.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("keys"),
            F.count_if(F.col("_variants") > 1).alias("conflicting_keys"),
        )

    return StarSchema(
        customers=people.drop("_variants"),
        products=goods.drop("_variants"),
        orders=flat.select(*SALES_ORDERS.fieldNames()),
        returns=returned.select(*SALES_RETURNS.fieldNames()),
        conflicts=report("customers", people).unionByName(report("products", goods)),
    )


def stage_flat(flat: DataFrame, path: str) -> DataFrame:
    """Write the flat file as parquet and read it back, to split from.

    The four tables each read the flat lines; a text file would be parsed, and a
    join worked out, once for each of them.  Compressed with zstd, as the names and
    categories of the dimensions repeat on every line.
    """
    flat.write.parquet(path, compression="zstd")
    return flat.sparkSession.read.schema(flat.schema).parquet(path)


def save_star_schema(star: StarSchema, folder: str) -> None:
    """Write the four tables as parquet below ``folder``.

    Orders are written in ranges of the order date, so that a date filter skips
    files and row groups by their statistics.  The order id takes part in the
    range, so that a day with many lines can fill more than one file.
    """
    by_date = ["order_date", "order_id"]
    star.orders.repartitionByRange(*by_date).sortWithinPartitions(*by_date).write.mode(
        "overwrite"
    ).parquet(f"{folder}/orders")
    for name in ("customers", "products", "returns"):
        getattr(star, name).write.mode("overwrite").parquet(f"{folder}/{name}")
