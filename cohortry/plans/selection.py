"""The rows at given places of an order, without sorting the table.

A place is narrowed down by histograms.  A round counts, in one scan with a partial
aggregate, the rows per bucket of the value range that holds the place; the bucket
that holds it is the next round's range.  A value that many rows share soon fills a
range of its own, and the search goes on in the key that breaks its ties.  Once few
rows are left, those alone are sorted.  Searches in several orders share their scans.

Buckets are cut by arithmetic that never turns two values around, and ranges are the
smallest and largest values found in a bucket, so places are exact for every type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Buckets of a range; a round sends at most so many rows per open range to the driver.
BUCKETS = 2048
# Rows left in all ranges that are then sorted.
FEW_ROWS = 100_000
# Text is compared by so many bytes at a time.
_CHUNK = 7


def literal(value: Any, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


@dataclass(frozen=True)
class Order:
    """A sort order: one column, NULLs lowest, ties by a unique key in ascending order."""

    column: str
    descending: bool


def _comparable(column: str, kind: DataType) -> tuple[str, str]:
    """SQL of a number (or text) that sorts as the column does, and its type."""
    if isinstance(kind, StringType):
        return column, "STRING"
    if isinstance(kind, DecimalType):
        return column, kind.simpleString()
    if isinstance(kind, (DoubleType, FloatType)):
        return f"CAST({column} AS DOUBLE)", "DOUBLE"
    if isinstance(kind, (IntegralType, BooleanType)):
        return f"CAST({column} AS BIGINT)", "BIGINT"
    if isinstance(kind, DateType):
        return f"CAST(unix_date({column}) AS BIGINT)", "BIGINT"
    if isinstance(kind, TimestampType):
        return f"unix_micros({column})", "BIGINT"
    if isinstance(kind, TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', {column})", "BIGINT"
    raise TypeError(f"{column} has a type without an order that can be searched: {kind.simpleString()}")


def _level(column: str, kind: DataType) -> str:
    """0 for NULL and 2 for other values; infinities and NaN have levels of their own."""
    if isinstance(kind, (DoubleType, FloatType)):
        return (
            f"CASE WHEN {column} IS NULL THEN 0 WHEN isnan({column}) THEN 4"
            f" WHEN {column} = double('infinity') THEN 3 WHEN {column} = double('-infinity') THEN 1 ELSE 2 END"
        )
    return f"IF({column} IS NULL, 0, 2)"


def _chunk(text: bytes) -> int:
    return int.from_bytes(text[:_CHUNK].ljust(_CHUNK, b"\0"), "big")


def _bucket(value: str, kind: str, low: Any, high: Any) -> str:
    """SQL of the bucket of a value between ``low`` and ``high``, which are different.

    ``low`` and ``high`` never share a bucket, so a round always narrows the range.
    """
    if kind == "STRING":
        a, b = low.encode(), high.encode()
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        first, last = _chunk(a[same:]), _chunk(b[same:])
        number = (
            f"CAST(conv(rpad(hex(substring(CAST({value} AS BINARY), {same + 1}, {_CHUNK})),"
            f" {2 * _CHUNK}, '0'), 16, 10) AS BIGINT)"
        )
        if first == last:
            return f"IF({value} > {literal(low, kind)}, 1L, 0L)"
        return f"CAST(({number} - {first}L) * {(BUCKETS - 1) / (last - first)!r}D AS BIGINT)"
    if kind == "DOUBLE":
        half = max(abs(low), abs(high)) > 1e300
        scale = "0.5D * " if half else ""
        width = high / 2 - low / 2 if half else high - low
        share = f"({scale}{value} - {scale}{literal(low, kind)}) / {literal(width, kind)}"
    elif kind == "BIGINT" and high - low < 1 << 53:
        share = f"CAST({value} - {literal(low, kind)} AS DOUBLE) / {high - low}D"
    else:
        first, last = float(low), float(high)
        if first == last:
            # Too close for doubles: halve the range exactly.
            middle = low + (high - low) / 2 if isinstance(low, Decimal) else (low + high) // 2
            return f"IF({value} > {_cut(middle, low, kind)}, 1L, 0L)"
        share = f"(CAST({value} AS DOUBLE) - {first!r}D) / {last - first!r}D"
    return f"least({BUCKETS - 1}L, greatest(0L, CAST({share} * {BUCKETS - 1} AS BIGINT)))"


def _cut(middle: Any, low: Any, kind: str) -> str:
    """``middle`` cut down to the decimals of its type, which is never below ``low``."""
    if isinstance(low, Decimal):
        scale = int(kind.rstrip(")").split(",")[1])
        text = format(middle, "f")
        whole, _, part = text.partition(".")
        cut = Decimal(f"{whole}.{part[:scale]}" if scale else whole)
        return literal(format(max(cut, low), "f"), kind)
    return literal(middle, kind)


@dataclass
class _Range:
    """The rows that may hold a place: those that meet ``fixed`` and lie in low..high."""

    order: int
    part: int = 0
    fixed: tuple[str, ...] = ()
    low: Any = 0
    high: Any = 4
    before: int = 0
    rows: int = 0
    places: list[int] = field(default_factory=list)


class _Search:
    def __init__(self, frame: DataFrame, key: str, orders: Sequence[Order]):
        types = {f.name: f.dataType for f in frame.schema.fields}
        self._frame, self._key, self._orders, self._types = frame, key, orders, types
        key_value, key_kind = _comparable(key, types[key])
        # Per order: level, value and key, as (SQL, type, column of the answer).
        self._parts = [
            (
                (_level(o.column, types[o.column]), "INT", "_level"),
                (*_comparable(o.column, types[o.column]), f"_order{j}"),
                (key_value, key_kind, "_order_key"),
            )
            for j, o in enumerate(orders)
        ]

    def _settled(self, r: _Range) -> bool:
        return r.part == 3

    def _condition(self, r: _Range) -> str:
        limits = list(r.fixed)
        if r.part < 3 and r.low is not None:
            value, kind, _ = self._parts[r.order][r.part]
            limits.append(f"{value} BETWEEN {literal(r.low, kind)} AND {literal(r.high, kind)}")
        return " AND ".join(f"({x})" for x in limits) or "true"

    def _fix(self, r: _Range) -> _Range:
        """Go on to the next part of the order once all rows agree in this one."""
        value, kind, _ = self._parts[r.order][r.part]
        fixed = (*r.fixed, f"{value} = {literal(r.low, kind)}")
        # Levels but the middle one have a single value, which need not be searched.
        skipped = int(r.part == 0 and r.low != 2)
        return replace(r, part=r.part + 1 + skipped, fixed=fixed, low=None, high=None)

    def _round(self, ranges: list[_Range]) -> list[_Range]:
        """One scan: every open range becomes the buckets that hold its places."""
        entries, open_text = [], set()
        for number, r in enumerate(ranges):
            if self._settled(r):
                continue
            value, kind, column = self._parts[r.order][r.part]
            if kind == "STRING":
                open_text.add(column)
            known = r.low is not None and r.low != r.high
            bucket = _bucket(value, kind, r.low, r.high) if known and r.part else value if known else "0L"
            columns = [f"'_range', {number}", f"'_bucket', CAST({bucket} AS BIGINT)"]
            level, _, key_part = self._parts[r.order]
            columns += [f"'{level[2]}', {level[0]}", f"'{key_part[2]}', {key_part[0]}"]
            for j, (_, (sql, k, name), _) in enumerate(self._parts):
                columns.append(f"'{name}', {sql if j == r.order else f'CAST(NULL AS {k})'}")
            entries.append(f"IF({self._condition(r)}, named_struct({', '.join(columns)}), NULL)")
        rows = self._frame.selectExpr(f"inline(array_compact(array({', '.join(entries)})))")
        kinds = {name: kind for parts in self._parts for _, kind, name in parts}
        # A smallest text makes Spark sort before it aggregates, so text is only asked
        # for once a search has come to it, and few rows are left.
        kept = [n for n, kind in kinds.items() if kind != "STRING" or n in open_text]
        found = (
            rows.groupBy("_range", "_bucket")
            .agg(
                F.count(F.lit(1)).alias("_rows"),
                *[F.min(n).alias(f"{n}_low") for n in kept],
                *[F.max(n).alias(f"{n}_high") for n in kept],
            )
            .collect()
        )
        narrowed = [r for r in ranges if self._settled(r)]
        for number, r in enumerate(ranges):
            if not self._settled(r):
                narrowed += self._narrow(r, [row for row in found if row["_range"] == number], kept)
        return narrowed

    def _narrow(self, r: _Range, buckets: list[Row], kept: list[str]) -> list[_Range]:
        descending = self._orders[r.order].descending and r.part < 2
        buckets.sort(key=lambda row: row["_bucket"], reverse=descending)
        found, before = [], r.before
        for row in buckets:
            places = [p for p in r.places if before <= p < before + row["_rows"]]
            if places:
                column = self._parts[r.order][r.part][2]
                part = replace(
                    r, low=row[f"{column}_low"], high=row[f"{column}_high"], before=before,
                    rows=row["_rows"], places=places,
                )
                # All rows agree: go on to what comes next in the order.
                while part.part < 3 and part.low == part.high:
                    part = self._fix(part)
                    if part.part < 3:
                        column = self._parts[part.order][part.part][2]
                        if column not in kept:
                            break
                        part = replace(part, low=row[f"{column}_low"], high=row[f"{column}_high"])
                found.append(part)
            before += row["_rows"]
        return found

    def _read(self, ranges: list[_Range]) -> list[tuple[int, int, Row]]:
        """Sort the few rows of the ranges; (order, place, row) for every place."""
        entries = []
        for number, r in enumerate(ranges):
            values = ", ".join(
                f"'_value{j}', "
                + (o.column if j == r.order else f"CAST(NULL AS {self._types[o.column].simpleString()})")
                for j, o in enumerate(self._orders)
            )
            # Ascending with the order: NULLs first, or last if it is descending.
            first = f"int({self._orders[r.order].column} IS {'' if self._orders[r.order].descending else 'NOT '}NULL)"
            entries.append(
                f"IF({self._condition(r)}, named_struct('_range', {number}, '_level', {first}, {values},"
                f" '_key', {self._key}), NULL)"
            )
        sort = ", ".join(
            ["_level", *[f"_value{j} {'DESC' if o.descending else 'ASC'}" for j, o in enumerate(self._orders)], "_key"]
        )
        wanted = " OR ".join(
            f"(_range = {number} AND {p - r.before} BETWEEN _upto - _n AND _upto - 1)"
            for number, r in enumerate(ranges) for p in r.places
        )
        columns = ["_range", "_level", *[f"_value{j}" for j in range(len(self._orders))], "_key"]
        rows = (
            self._frame.selectExpr(f"inline(array_compact(array({', '.join(entries)})))")
            .groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("_n"))
            .selectExpr(
                "*",
                f"""sum(_n) OVER (PARTITION BY _range ORDER BY {sort}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto""",
            )
            .where(wanted)
            .collect()
        )
        return [
            (r.order, p, row)
            for number, r in enumerate(ranges) for p in r.places for row in rows
            if row["_range"] == number and row["_upto"] - row["_n"] <= p - r.before < row["_upto"]
        ]

    def run(self, total: int, places: Mapping[int, list[int]]) -> list[tuple[int, int, Row]]:
        ranges = [_Range(j, rows=total, places=list(p)) for j, p in places.items() if p]
        if not ranges:
            return []
        # Rows that agree in everything are one row when they are read.
        while (open_ := [r for r in ranges if not self._settled(r)]) and sum(r.rows for r in open_) > FEW_ROWS:
            ranges = self._round(ranges)
        return self._read(ranges)


def rows_at(
    frame: DataFrame, key: str, orders: Sequence[Order], places: Mapping[int, list[int]], total: int
) -> list[tuple[int, int, Row]]:
    """(order, place, row) for the 0-based places that are asked for in each order.

    ``total`` is the number of rows of ``frame``, which must not change meanwhile.  A
    row has ``_level`` (0 or 1, where NULLs lie), ``_value<order>`` and ``_key``.
    """
    return _Search(frame, key, orders).run(total, places)

