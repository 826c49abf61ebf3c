"""Row numbers, tiles and ranks over tables too large for one sorted task.

A window without ``partitionBy`` sends every row to one task.  Here the order
comes from Spark's own range partitioning instead: each range is sorted on its
own, and a running total over the *ranges* (one row per partition) turns the
place in a range into a place in the table.

The ranged rows are checkpointed before anything counts them.  Range bounds are
sampled, so a second run of the same plan could cut the ranges elsewhere; the
checkpoint makes the count and the numbering see the same ranges, also after an
executor is lost.  The functions therefore run jobs when called, not only when
their result is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.plans.durable import freeze, store
from cohortry.plans.selection import Order, literal, rows_at
from cohortry.plans.sizes import broadcast_if_small

# monotonically_increasing_id(): partition number above, place in it below.
_PLACE_BITS = 33
# Equal rows that are numbered as one part.
_PART_ROWS = 100_000


def _ranged(frame: DataFrame, *order: str | Column) -> DataFrame:
    """Range-partition and sort; adds ``_slice`` and the 0-based ``_place`` in it."""
    located = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .selectExpr("*", "monotonically_increasing_id() AS _spot")
    )
    return freeze(located).selectExpr(
        *frame.columns,
        f"CAST(shiftright(_spot, {_PLACE_BITS}) AS INT) AS _slice",
        f"_spot & {(1 << _PLACE_BITS) - 1}L AS _place",
    )


def _rows_before(rows: str, *group: str) -> str:
    """SQL for the rows of a group that lie in earlier slices."""
    within = f"PARTITION BY {', '.join(group)} " if group else ""
    return (
        f"coalesce(sum({rows}) OVER ({within}ORDER BY _slice"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )


def add_row_number(frame: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Dense 1..N numbers in ``order``; equal rows are numbered in any order.

    Runs jobs when called.  Rows equal in every column are counted first, so a row
    that makes up a third of the table is a few parts of bounded size; only the
    different rows are range-partitioned and checkpointed, once.  Parts of one row
    may lie in different ranges.  Columns must be of types that can be grouped.
    """
    parts = (
        frame.groupBy(*frame.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .selectExpr("*", f"explode(sequence(0, (_n - 1) div {_PART_ROWS})) AS _part")
        .selectExpr(
            *frame.columns, "_part", f"least({_PART_ROWS}, _n - _part * {_PART_ROWS}) AS _rows",
            f"xxhash64({', '.join(frame.columns)}) AS _tie",
        )
    )
    placed = _ranged(parts, *order, "_tie", "_part")
    offsets = (
        placed.groupBy("_slice")
        .agg(F.sum("_rows").alias("_size"))
        .selectExpr("_slice", f"{_rows_before('_size')} AS _offset")
    )
    # One row per range partition: bounded by the shuffle partition count.
    return (
        placed.selectExpr(
            "*",
            """coalesce(sum(_rows) OVER (PARTITION BY _slice ORDER BY _place
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before""",
        )
        .join(F.broadcast(offsets), "_slice")
        .selectExpr(*frame.columns, "_offset + _before AS _start", "explode(sequence(1, _rows)) AS _nth")
        .selectExpr(f"_start + _nth AS {name}", *frame.columns)
    )


def add_tiles(
    frame: DataFrame,
    key: str,
    scores: Mapping[str, tuple[str, bool]],
    tiles: int = 5,
) -> DataFrame:
    """NTILE scores for several columns at once, ties broken by ``key``.

    ``scores`` maps a new column to ``(source column, descending)``; values are
    ordered in their own type.  ``key`` must be a unique integer or text column.
    NULLs sort lowest.  Runs jobs when called.

    Only the first row of each tile has to be known: ``len(scores) * (tiles-1)``
    cut rows, which ``plans.selection`` finds without sorting the table.  The scores
    are then comparisons against those cuts, so the table is not shuffled either.
    The rows are written once, so that cuts and scores are of one moment.
    """
    frozen, total = store(frame)
    types = {f.name: f.dataType.simpleString() for f in frozen.schema.fields}
    named = list(scores.items())
    # The first (total % tiles) tiles hold one row more than the others.
    firsts = {
        tile * (total // tiles) + min(tile, total % tiles) for tile in range(1, tiles)
    }
    places = sorted(p for p in firsts if p < total)
    orders = [Order(column, descending) for _, (column, descending) in named]
    cut_rows = rows_at(frozen, key, orders, {i: places for i in range(len(named))}, total)

    columns = []
    for i, (name, (column, descending)) in enumerate(named):
        score = "1"
        for order, place, row in cut_rows:
            if order == i:
                # Tiles that begin at the same row, of a table with few rows.
                weight = sum(
                    tile * (total // tiles) + min(tile, total % tiles) == place
                    for tile in range(1, tiles)
                )
                value = literal(row[f"_value{i}"], types[column])
                cut_key = literal(row["_key"], types[key])
                own = f"int({column} IS {'' if descending else 'NOT '}NULL)"
                later = "<" if descending else ">"
                score += (
                    f" + {weight} * int({own} > {row['_level']} OR ({own} = {row['_level']} AND"
                    f" (coalesce({column} {later} {value}, false)"
                    f" OR ({column} <=> {value} AND {key} >= {cut_key}))))"
                )
        columns.append(f"{score} AS {name}")
    return frozen.selectExpr("*", *columns)


def add_ranks(
    frame: DataFrame,
    order: Sequence[tuple[str, bool]],
    ranks: Mapping[str, Sequence[str]],
    sizes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Competition ranks (1, 1, 3, ...) by ``order``.

    ``order`` lists ``(column, descending)``.  ``ranks`` maps a new column to the
    columns it is ranked within (empty: over the whole table).  ``sizes`` maps a
    rank column to the name of a column that takes its group's row count.

    Rows are first counted per distinct key, so a key shared by a third of the
    table is one row afterwards; ranks are running counts over the distinct
    keys, joined back to the rows.

    Runs jobs when called.  The rows are checkpointed first, and both counted and
    joined from that copy, so ranks and rows are of one moment; pass only the
    columns that are needed.
    """
    frame = freeze(frame)
    sizes = sizes or {}
    order_columns = [column for column, _ in order]
    group_columns = sorted({c for within in ranks.values() for c in within})
    key_columns = group_columns + [c for c in order_columns if c not in group_columns]
    sort = [F.desc(c) if descending else F.asc(c) for c, descending in order]
    sort_sql = ", ".join(f"{c} {'DESC' if descending else 'ASC'}" for c, descending in order)

    # Equal keys must share a range for every rank, so the range order may start
    # with the groups only if all ranks are within those groups.
    grouped = all(set(within) == set(group_columns) for within in ranks.values())
    bounds = ([F.asc(c) for c in group_columns] if grouped else []) + sort
    keys = freeze(
        frame.groupBy(*key_columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .repartitionByRange(*bounds)
        .selectExpr("*", "spark_partition_id() AS _slice")
    )

    ranked, outputs = keys, []
    # Whole-table ranks first: their hash on the range also serves the others.
    for name, within in sorted(ranks.items(), key=lambda item: len(item[1])):
        group = ", ".join(["_slice", *within])
        offsets = (
            keys.groupBy(*within, "_slice")
            .agg(F.sum("_n").alias("_rows"))
            .selectExpr(
                "_slice AS _g_slice",
                *[f"{c} AS _g_{c}" for c in within],
                f"{_rows_before('_rows', *within)} AS _offset",
                f"sum(_rows) OVER (PARTITION BY {', '.join(within) or 'NULL'}) AS _size_{name}",
            )
        )
        if not within:
            # One row per range partition: bounded by the shuffle partition count.
            offsets = F.broadcast(offsets)
        same_group = " AND ".join(
            ["_slice = _g_slice", *[f"{c} <=> _g_{c}" for c in within]]
        )
        # Peers are a frame of the running sum's own window, so one sort serves both.
        window = f"PARTITION BY {group} ORDER BY {sort_sql} RANGE BETWEEN"
        ranked = (
            ranked.selectExpr(
                "*",
                f"sum(_n) OVER ({window} UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto",
                f"sum(_n) OVER ({window} CURRENT ROW AND CURRENT ROW) AS _peers",
            )
            .join(offsets, F.expr(same_group))
            .selectExpr(*ranked.columns, f"_size_{name}", f"_offset + _upto - _peers + 1 AS {name}")
        )
        outputs.append(name)
        if name in sizes:
            outputs.append(f"_size_{name} AS {sizes[name]}")

    lookup = ranked.selectExpr(*[f"{c} AS _k_{c}" for c in key_columns], *outputs)
    same_key = " AND ".join(f"{c} <=> _k_{c}" for c in key_columns)
    return frame.join(broadcast_if_small(lookup, keys), F.expr(same_key)).drop(*[f"_k_{c}" for c in key_columns])
