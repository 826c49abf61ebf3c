"""A content-addressed manifest of a dataset, and proofs read from its records.

The rows of a group (``lang``) are the leaves of a binary tree in ``doc_id`` order,
and the groups' roots are the leaves of a tree on top.  The manifest stores, for a
digest, the children below it: a record holds a block of ``2 ** DIGIT_BITS`` leaves
with the levels between them and the block's own root, so that one record answers
one *digit* of a leaf's rank.

A proof is found by going down.  All requests start at the root; a step joins the
nodes that are wanted with the records of their digests, turns to the child that the
next rank digit names and collects the children that were not selected.  Nodes are
joined, not requests: however many leaves are asked for, a node is visited once a
step, so the root is no hot key, and the rows of all steps together are fewer than
twice the leaves.  The collected segments run from the root to the leaf; reversed
they are the proof.

Hashes are computed once per row from the text where it lies; only 32 byte digests
are sorted and shuffled.  Blocks, and the requests for one block, have a fixed
number of leaves, so a language that holds a third of the rows is as many blocks
more.

Rows: any column may be null, and is part of the leaf as such; null doc_ids come
first, and a null ``lang`` is a group of its own, before all others; rows with equal
doc_ids are ordered by their leaf, so rows equal in every column are interchangeable
(their blocks may have equal digests, which are stored once); an empty text differs
from a null one; texts of any length are hashed whole; columns other than the five
are ignored; an empty table has no root and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import keep_columns, stash

# Rank bits that one record answers: a block has 256 leaves, about 16 KB of digests.
DIGIT_BITS = 8
# monotonically_increasing_id(): partition number above, place in it below.
_PLACE_BITS = 33

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(**changed: str) -> str:
    """SQL of a row's digest: each field as byte count, colon and value, or a dash."""
    parts = []
    for name in FIELDS:
        value = f"CAST({changed.get(name, f'`{name}`')} AS STRING)"
        parts.append(f"IF({value} IS NULL, '-', concat(octet_length({value}), ':', {value}))")
    return f"unhex(sha2(concat({', '.join(parts)}), 256))"


def _hash(text: str) -> str:
    return f"unhex(sha2({text}, 256))"


def _hex(digest: str) -> str:
    return f"lower(hex({digest}))"


def _ranked(frame: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows of ``group`` with ``rank`` in it and ``leaves``, the size of the group.

    The ranges are written before they are counted: bounds are sampled, so a second
    run of the plan could cut elsewhere.  A row meets the numbers of its group by range
    and group, so a group that fills many ranges is no hot key.
    """
    located = stash(
        frame.repartitionByRange("group", *order)
        .sortWithinPartitions("group", *order)
        .selectExpr("*", "monotonically_increasing_id() AS _spot"),
        name,
    ).selectExpr("*", f"shiftright(_spot, {_PLACE_BITS}) AS _slice")
    parts = (
        located.groupBy("_slice", "group")
        .agg(F.min("_spot").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .selectExpr(
            "_slice AS _s", "group AS _g", "_first",
            """coalesce(sum(_n) OVER (PARTITION BY group ORDER BY _slice
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before""",
            "sum(_n) OVER (PARTITION BY group) AS leaves",
        )
    )
    return located.join(parts, F.expr("_slice = _s AND group = _g")).selectExpr(
        *frame.columns, "_before + _spot - _first AS rank", "leaves"
    )


# Levels of a tree over so many leaves.
_DEPTH = "IF(leaves > 1, length(bin(leaves - 1)), 0)"


@dataclass(frozen=True)
class Tree:
    """``roots`` (group, digest, depth) and the records of each step, bottom first.

    Records have ``digest`` and ``levels``: the block's leaves, then the levels above
    them up to the children of the block's root.
    """

    roots: DataFrame
    records: list[DataFrame]


def _rounds(depth: str) -> str:
    """Steps from the root to a leaf; a tree of one leaf takes one, without turns."""
    return f"greatest(1, CAST(ceil({depth} / {DIGIT_BITS}) AS INT))"


def build_tree(leaves: DataFrame, name: str) -> Tree:
    """The tree of every group from (group, rank, leaves, digest) rows."""
    deepest = leaves.agg(F.expr(f"max({_DEPTH})")).first()[0] or 0
    steps = max(1, -(-deepest // DIGIT_BITS))
    nodes = leaves.selectExpr("group", "rank", f"{_DEPTH} AS depth", "digest")
    records, roots = [], []
    for step in range(steps):
        blocks = (
            nodes.where(f"{_rounds('depth')} > {step}")
            .groupBy("group", F.expr(f"shiftright(rank, {DIGIT_BITS})").alias("rank"), "depth")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("_members"))
            .selectExpr(
                "group", "rank", "depth", "transform(_members, m -> m.digest) AS level0",
                f"least({DIGIT_BITS}, depth - {step * DIGIT_BITS}) AS lift",
            )
        )
        for j in range(DIGIT_BITS):
            pair = _hash(
                f"concat({_hex(f'level{j}[2 * i]')}, coalesce({_hex(f'get(level{j}, 2 * i + 1)')}, ''))"
            )
            blocks = blocks.selectExpr(
                "*",
                f"""IF(lift > {j}, transform(sequence(0, (size(level{j}) + 1) div 2 - 1), i -> {pair}),
                    level{j}) AS level{j + 1}""",
            )
        every = ", ".join(f"level{j}" for j in range(DIGIT_BITS))
        made = stash(
            blocks.selectExpr(
                "group", "rank", "depth", f"level{DIGIT_BITS}[0] AS digest",
                f"slice(array({every}), 1, lift) AS levels", "level0[0] AS leaf",
            ),
            f"{name}-step-{step}",
        )
        # Equal digests have equal children, so one record stands for all.
        records.append(made.groupBy("digest").agg(F.any_value("levels").alias("levels")))
        roots.append(made.where(f"{_rounds('depth')} = {step + 1}").select("group", "digest", "depth"))
        nodes = made.select("group", "rank", "depth", "digest")
    return Tree(reduce(DataFrame.unionAll, roots), records)


# The children not selected on the way to leaf ``pos`` of a block, top down; null
# where a node has one child only.  ``left`` says that they lie to the left.
_SEGMENT = """transform(reverse(levels), (level, up) -> named_struct(
    'digest', get(level, CAST(shiftright(pos, size(levels) - 1 - up) ^ 1 AS INT)),
    'left', shiftright(pos, size(levels) - 1 - up) & 1 = 1))"""


def descend(tree: Tree, start: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (group, rank, more columns) with their ``path`` from the root down.

    ``start`` has (group, digest, depth, path) per group: its root, and the path that
    led there; its other columns come along.  A group or rank that the tree does not
    have gives no row.
    """
    steps = len(tree.records)
    along = [c for c in start.columns if c not in ("group", "digest", "depth", "path")]
    frontier = None
    for step in reversed(range(steps)):
        arriving = start.where(f"{_rounds('depth')} = {step + 1}").selectExpr(
            "group", "0L AS rank", "digest", "path", *along
        )
        frontier = arriving if frontier is None else frontier.unionByName(arriving)
        bits = (step + 1) * DIGIT_BITS
        wanted = requests.selectExpr("group", f"shiftright(rank, {bits}) AS rank").distinct()
        known = (
            frontier.join(wanted, ["group", "rank"], "left_semi")
            .join(tree.records[step], "digest")
            .select("group", "rank", "path", "levels", "digest", *along)
        )
        if step:
            frontier = stash(
                known.selectExpr("*", "posexplode(levels[0]) AS (pos, child)").selectExpr(
                    "group", f"shiftleft(rank, {DIGIT_BITS}) + pos AS rank", "child AS digest",
                    f"concat(path, {_SEGMENT}) AS path", *along,
                ),
                f"frontier-{step}",
            )
    more = [c for c in requests.columns if c not in ("group", "rank")]
    mask = (1 << DIGIT_BITS) - 1
    # At most a block's leaves meet in a row: ranks are unique within a group.
    asked = requests.groupBy(
        "group", F.expr(f"shiftright(rank, {DIGIT_BITS})").alias("rank")
    ).agg(
        F.collect_list(
            F.struct(F.expr(f"CAST(rank & {mask} AS INT)").alias("pos"), F.col("rank").alias("_rank"), *more)
        ).alias("_asked")
    )
    return (
        known.drop("digest")
        .join(asked, ["group", "rank"])
        .selectExpr("group", "path", "levels", *along, "inline(_asked)")
        .where("pos = 0 OR (size(levels) > 0 AND pos < size(levels[0]))")
        .selectExpr("group", "_rank AS rank", *along, *more, f"concat(path, {_SEGMENT}) AS path")
    )


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (group, rank, leaves, doc_id, digest, tampered), trees and ``root``."""

    leaves: DataFrame
    groups: Tree
    top: Tree
    top_leaves: DataFrame


def build_manifest(docs: DataFrame) -> Manifest:
    """Leaves, group trees and the tree over the groups' roots.

    ``tampered`` is the digest of the row with one more in ``n_chars``, for the rows
    whose doc_id has a check sum that 7 divides, and the row's own digest for others.
    """
    one_more = _leaf(n_chars="(n_chars + 1)")
    hashed = stash(
        keep_columns(docs, *FIELDS).selectExpr(
            "coalesce(concat('=', lang), '') AS group", "doc_id", f"{_leaf()} AS digest",
            f"""CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 = 0 AND n_chars IS NOT NULL
                THEN {one_more} END AS changed""",
        ),
        "leaves",
    )
    ranked = _ranked(hashed, "leaf-ranks", "doc_id", "digest")
    groups = build_tree(ranked, "groups")
    # One constant group, ordered by the name of the language; null was made ''.
    top_leaves = _ranked(
        groups.roots.selectExpr("'' AS group", "group AS name", "digest", "depth"), "top-ranks", "name"
    )
    return Manifest(ranked, groups, build_tree(top_leaves, "top"), top_leaves)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Per request (group, rank, more columns): ``subroot``, ``root`` and ``path``.

    ``path`` has the unselected children from the leaf up, through the group's root to
    the root of all.
    """
    top_start = manifest.top.roots.selectExpr(
        "group", "digest", "depth", "digest AS root",
        "CAST(array() AS ARRAY<STRUCT<digest: BINARY, left: BOOLEAN>>) AS path",
    )
    to_groups = descend(
        manifest.top, top_start, manifest.top_leaves.selectExpr("group", "rank", "name", "digest AS subroot", "depth")
    ).selectExpr("name AS group", "subroot AS digest", "depth", "path", "subroot", "root")
    return descend(manifest.groups, to_groups, requests).selectExpr("* EXCEPT (path)", "reverse(path) AS path")


def fold(leaf: str) -> str:
    """SQL of the root that a leaf and the siblings of ``path`` lead to, as hex text."""
    one = f"""CASE WHEN s.digest IS NULL THEN sha2(acc, 256)
        WHEN s.left THEN sha2(concat({_hex('s.digest')}, acc), 256)
        ELSE sha2(concat(acc, {_hex('s.digest')}), 256) END"""
    return f"aggregate(path, {_hex(leaf)}, (acc, s) -> {one})"


PROOF = f"""sha2(array_join(transform(filter(path, s -> s.digest IS NOT NULL),
    s -> {_hex('s.digest')}), ''), 256)"""


def verify_documents(docs: DataFrame) -> DataFrame:
    """Every row's leaf, roots and proof, and whether its (tampered) form still fits."""
    manifest = build_manifest(docs)
    requests = manifest.leaves.select("group", "rank", "doc_id", "digest", "changed")
    return (
        prove(manifest, requests)
        .selectExpr(
            "doc_id", f"{_hex('digest')} AS leaf", f"{_hex('subroot')} AS subroot",
            f"{_hex('root')} AS root", f"{PROOF} AS proof_sha256",
            f"{fold('coalesce(changed, digest)')} AS folded_root",
        )
        .selectExpr("*", "folded_root = root AS verified")
    )
