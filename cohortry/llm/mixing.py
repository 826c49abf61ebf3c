"""Mixing sources to target weights by entropy balancing.

A document is taken at a rate between 0 and 3 times.  Among all rates that give a
source its target of words, those nearest to taking each document once (in
relative entropy) have the form ``min(3, exp(tilt * size / mean size))``, with one
tilt per source: the dual of the convex problem has one variable per constraint.
Newton steps find all tilts at once; a step is one aggregate over the counts per
source and size, kept inside a bracket that halves where a step would leave it.

Rates are then rounded to whole copies.  Every document gets the whole part of
its rate; the words still missing are filled by one more copy of the documents
with the smallest ``hash / fraction``, up to the place where the source's words
are used up, and at last by single documents that fit the remaining gap.  Rows
equal in source, doc_id and size have one place in that order; where the words
are used up among them, as many of them get the copy as fit.  The result depends
on the rows only, so reruns agree.

Rows: a null text has no words; documents without words are never taken and
change nothing; a null source is a source of its own, the last; rows with the
same doc_id are separate documents; other columns are ignored by ``mix`` and kept
by ``mixed_documents``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import stash
from cohortry.plans.ordering import add_row_number

# Fixed values of the mix: weights in source order, repeating, and most copies.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
NEWTON_STEPS = 40
CLOSE = 1e-5
# Rounding narrows the cut down by this many bits of the place, this many times.
CELL_BITS, PASSES = 8, 4
PLACE_BITS = CELL_BITS * PASSES
GAP_ROUNDS = 6

# Equal rows agree in these, besides the source.
_GROUP = ("key", "doc_id", "size")

_SIZE = r"size(filter(split(text, r'[\x20\x09-\x0D]+'), w -> w <> ''))"


def sizes(docs: DataFrame, *also: str) -> DataFrame:
    """Words per document, over the whole text, and a hash that tells texts of one doc_id apart."""
    return docs.select(
        "doc_id", "source", F.expr(f"CAST(coalesce({_SIZE}, 0) AS BIGINT)").alias("size"),
        F.xxhash64("text").alias("_text"), *also,
    )


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Words to take per source, from (source, source_size); adds ``target``.

    Shares by weight stop at ``MOST_COPIES`` times a source's words; the excess is
    shared again among the others until no share is above.  Each turn is one
    aggregate, and a source once stopped stays so.
    """
    ordered = add_row_number(
        per_source.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_n"
    )
    listed = ", ".join(map(str, weights))
    weighed = stash(
        ordered.selectExpr(
            "source", "source_size",
            f"CAST(element_at(array({listed}), CAST((_n - 1) % {len(weights)} AS INT) + 1) AS DOUBLE)"
            " AS weight",
        ),
        "source-weights",
    )
    most = f"CAST({MOST_COPIES} * source_size AS DOUBLE)"
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, stopped = 0.0, -1
    while True:
        at_most = f"weight * {unit!r}D >= {most}"
        row = weighed.agg(
            F.expr(f"coalesce(sum(CASE WHEN {at_most} THEN {most} END), 0)").alias("fixed"),
            F.expr(f"coalesce(sum(CASE WHEN NOT ({at_most}) THEN weight END), 0)").alias("weights"),
            F.expr(f"count_if({at_most})").alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["weights"]:
            break
        stopped = row["stopped"]
        unit = max(unit, (total - row["fixed"]) / row["weights"])
    return weighed.selectExpr(
        "source", "source_size", f"least(weight * {unit!r}D, {most}) AS target"
    )


def _same_source(left: DataFrame, right: DataFrame):
    return left["source"].eqNullSafe(right["source"])


def tilts(counts: DataFrame, wanted: DataFrame, steps: int = NEWTON_STEPS) -> DataFrame:
    """The tilt per source, from (source, size, n) and the targets.

    Both inputs should be stored.  The tilts are written after every step.
    """
    cap = f"{MOST_COPIES}D"
    state = wanted.join(
        counts.groupBy(counts["source"].alias("_s")).agg(
            F.expr("sum(size * n) / greatest(sum(n), 1)").alias("mean")
        ),
        wanted["source"].eqNullSafe(F.col("_s")),
    ).selectExpr(
        "source", "target", "source_size", "mean",
        # A source to be taken fully has no finite tilt.
        f"target >= {MOST_COPIES} * source_size AS full",
        "0D AS tilt", "-1e6D AS low", "1e6D AS high", "false AS close",
    )
    state = stash(state, "tilts")
    for _ in range(steps):
        rate = f"least({cap}, exp(least(tilt * size / mean, 50D)))"
        words = counts.join(state.where("NOT full AND NOT close"), _same_source(counts, state)).select(
            state["source"].alias("_s"),
            F.expr(f"n * size * {rate}").alias("_w"),
            F.expr(f"IF({rate} < {cap}, n * size * {rate} * size / mean, 0D)").alias("_d"),
        )
        sums = words.groupBy("_s").agg(F.sum("_w").alias("_w"), F.sum("_d").alias("_d"))
        moved = state.join(sums, state["source"].eqNullSafe(F.col("_s")), "left").selectExpr(
            "*",
            f"close OR full OR abs(_w - target) <= {CLOSE} * target AS _close",
            "IF(_w > target, least(high, tilt), high) AS _high",
            "IF(_w < target, greatest(low, tilt), low) AS _low",
            "tilt - (_w - target) / nullif(_d, 0D) AS _step",
        )
        # Outside the bracket: halve it, or widen fast while a side is open.
        halved = """CASE WHEN _low <= -1e6D THEN least(2 * tilt, tilt - 1)
                         WHEN _high >= 1e6D THEN greatest(2 * tilt, tilt + 1)
                         ELSE (_low + _high) / 2 END"""
        state = stash(
            moved.selectExpr(
                "source", "target", "source_size", "mean", "full",
                f"""CASE WHEN _close THEN tilt
                         WHEN _step > _low AND _step < _high THEN _step ELSE {halved} END AS tilt""",
                "coalesce(_low, low) AS low", "coalesce(_high, high) AS high",
                "coalesce(_close, true) AS close",
            ),
            "tilts",
        )
        if state.where("NOT close").isEmpty():
            break
    return state.select("source", "source_size", "target", "mean", "full", "tilt")


def _cut_cells(waiting: DataFrame, cuts: DataFrame, bits: int) -> DataFrame:
    """Narrow each source's cut, a cell of places without their last ``bits + CELL_BITS``
    bits, to one without the last ``bits``, by the words before it."""
    inside = waiting.join(cuts, waiting["source"].eqNullSafe(cuts["source"])).where(
        f"shiftright(place, {bits + CELL_BITS}) = cell"
    )
    cells = inside.groupBy(
        cuts["source"].alias("source"), "need", F.expr(f"shiftright(place, {bits})").alias("cell")
    ).agg(F.sum("size").alias("words"))
    # At most 2 ** CELL_BITS rows per source.
    return _crossing(cells, "cell").selectExpr("source", "c.need - c.before AS need", "c.cell AS cell")


def _crossing(parts: DataFrame, order: str) -> DataFrame:
    """The part, by ``order``, in which each source's words reach ``need``, as ``c``."""
    before = parts.selectExpr(
        "*",
        f"""sum(words) OVER (PARTITION BY source ORDER BY {order}
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - words AS before""",
    )
    columns = [F.col(c) for c in before.columns if c != "source"]
    return before.where("before + words >= need").groupBy("source").agg(
        F.min_by(F.struct(*columns), order).alias("c")
    )


def _extra_copies(split: DataFrame) -> DataFrame:
    """Rows of ``split``, with ``extra``: whether the row gets one more copy.

    Every source's missing words are filled in the order of (place, key, doc_id,
    size).  Equal rows are one group there; the one in which the words are used up
    gets as many copies as fit, its rows being numbered.
    """
    open_words = "coalesce(sum(CASE WHEN fraction > 0 THEN size END), 0)"
    wanted = stash(
        split.groupBy("source").agg(
            F.expr("max(target) - sum(whole * size)").alias("need"),
            F.expr(open_words).alias("open"),
        ),
        "mix-cuts",
    )
    waiting = split.where("fraction > 0").select("source", "size", "place")
    cuts = wanted.where("need > 0 AND need < open").selectExpr("source", "need", "0L AS cell")
    for done in range(1, PASSES + 1):
        cuts = stash(_cut_cells(waiting, cuts, PLACE_BITS - CELL_BITS * done), "mix-cuts")

    # The last cell holds few groups, one as a rule, but any number of equal rows.
    last = split.where("fraction > 0").join(
        cuts.selectExpr("source AS _s", "need", "cell"),
        F.expr("source <=> _s AND place = cell"),
    )
    groups = last.groupBy("source", "need", "place", F.struct(*_GROUP).alias("at")).agg(
        F.sum("size").alias("words")
    )
    edges = stash(
        _crossing(groups, "at").selectExpr(
            "source AS _s", "c.place AS _place", "c.at AS _at",
            "CAST(floor((c.need - c.before) / c.at.size) AS BIGINT) AS _fit",
        ),
        "mix-edges",
    )
    at = F.struct(*_GROUP)
    edge = split.where("fraction > 0").join(edges.where("_fit > 0"), F.expr("source <=> _s")).where(
        (F.col("place") == F.col("_place")) & (at == F.col("_at"))
    )
    edge = stash(edge.select("source", "_fit", "_text", "_row"), "mix-edge-rows")
    order = ["source", "_text", "_row"]
    numbered = stash(add_row_number(edge, order, "_n"), "mix-edge-numbers")
    first = numbered.groupBy(F.col("source").alias("_s")).agg(F.min("_n").alias("_first"))
    fitting = numbered.join(first, F.expr("source <=> _s")).where("_n - _first < _fit")

    filled = wanted.join(edges, wanted["source"].eqNullSafe(edges["_s"]), "left").select(
        wanted["source"].alias("_s"), F.expr("need > 0 AND need >= open").alias("_all"), "_place", "_at"
    )
    before = (F.col("place") < F.col("_place")) | ((F.col("place") == F.col("_place")) & (at < F.col("_at")))
    return (
        split.join(filled, split["source"].eqNullSafe(F.col("_s")))
        .join(fitting.select(F.col("_row").alias("_fits")), F.expr("_row = _fits"), "left")
        .withColumn(
            "extra",
            (F.col("fraction") > 0)
            & (F.col("_all") | F.coalesce(before, F.lit(False)) | F.col("_fits").isNotNull()),
        )
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Copies of each document: size, source_size, target, copies and taken words."""
    numbered = sizes(docs).withColumn("_row", F.monotonically_increasing_id())
    return _mix(stash(numbered, "sizes"), weights).drop("_row")


def _mix(numbered: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``mix`` for stored rows of (_row, doc_id, source, size, _text)."""
    # One row per source and size: far fewer than documents, wherever they lie.
    counts = stash(
        numbered.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts"
    )
    per_source = counts.groupBy("source").agg(F.expr("sum(size * n)").alias("source_size"))
    found = stash(tilts(counts, targets(per_source, weights)), "mix-tilts")

    narrow = numbered
    rate = f"IF(full, {MOST_COPIES}D, least({MOST_COPIES}D, exp(least(tilt * size / mean, 50D))))"
    rated = narrow.join(found, _same_source(narrow, found)).select(
        "_row", "_text", "doc_id", narrow["source"], "size", "target", F.expr(rate).alias("rate")
    )
    # Order of the extra copies: hash / fraction, brought into [0, 1).
    split = rated.selectExpr(
        "_row", "_text", "doc_id", "source", "size", "target",
        "CAST(IF(size > 0, floor(rate), 0) AS BIGINT) AS whole",
        "IF(size > 0, rate - floor(rate), 0D) AS fraction",
        "(xxhash64(doc_id, size, 71) & 9007199254740991L) / 9007199254740992D AS u",
    ).selectExpr("*", "IF(fraction > 0, u / (u + fraction), 2D) AS key").selectExpr(
        "*", f"least({2**PLACE_BITS - 1}L, CAST(floor(key * {2**PLACE_BITS}D) AS BIGINT)) AS place"
    )
    split = stash(split, "mix-rates")
    taken = _extra_copies(split).selectExpr(
        "_row", "doc_id", "source", "size", "target", "whole + IF(extra, 1L, 0L) AS copies"
    )
    taken = stash(taken, "mix-copies")

    # Close the remaining gap, at most one copy of one document per source a round.
    for _ in range(GAP_ROUNDS):
        gaps = taken.groupBy("source").agg(
            F.expr("max(target) - sum(copies * size)").alias("gap")
        ).select(F.col("source").alias("_s"), "gap")
        candidates = taken.join(gaps, taken["source"].eqNullSafe(F.col("_s"))).where(
            f"""size > 0 AND size < 2 * abs(gap)
                AND IF(gap > 0, copies < {MOST_COPIES}, copies > 0)"""
        )
        picked = candidates.groupBy("source").agg(
            F.min_by(
                F.struct("_row", F.expr("CAST(sign(gap) AS INT)").alias("sign")),
                F.struct(F.expr("abs(size - abs(gap))"), "doc_id", "_row"),
            ).alias("p")
        )
        picked = stash(picked.selectExpr("p._row AS _picked", "p.sign AS _sign"), "mix-picked")
        if picked.isEmpty():
            break
        taken = stash(
            taken.join(picked, F.expr("_row = _picked"), "left").selectExpr(
                "_row", "doc_id", "source", "size", "target", "copies + coalesce(_sign, 0) AS copies"
            ),
            "mix-copies",
        )
    total = found.select(F.col("source").alias("_s"), "source_size")
    return taken.join(total, taken["source"].eqNullSafe(F.col("_s"))).selectExpr(
        "doc_id", "source", "size", "source_size", "target", "copies", "copies * size AS taken",
        "_row",
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    The rows are written once with a number, so that the copies found for a row
    can be joined back to that very row.
    """
    whole = docs.select("doc_id", "source", "text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))
    numbered = sizes(whole, "_doc").withColumn("_row", F.monotonically_increasing_id())
    numbered = stash(numbered, "mix-documents")
    mixed = _mix(numbered.drop("_doc"), weights).where("copies > 0").select("_row", "copies")
    return (
        numbered.select("_row", "_doc")
        .join(mixed, "_row")
        .select("_doc", F.expr("explode(sequence(1, copies))").alias("_copy"))
        .select("_doc.*")
    )
