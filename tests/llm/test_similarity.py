from __future__ import annotations

import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortry.llm import bagminhash, embedding_dedup
from cohortry.llm.buckets import Forest, shared_buckets, windows
from cohortry.llm.components import components
from cohortry.llm.shingles import counted, shingle_hashes


def smallest_reachable(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    links = [(0, 1), (1, 0), (1, 1), (5, 9), (9, 7)] + chain
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    found = components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    expected = smallest_reachable(400, links)
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert {(r["node"], r["component"]) for r in found} == {(x, expected[x]) for x in ends}
    assert len(found) == len(ends)


def test_components_of_nothing(spark):
    empty = spark.createDataFrame([], "a BIGINT, b BIGINT")
    assert components(empty).collect() == []


def test_windows_list_every_pair_once():
    first, end = np.array([1, 2, 3, 4]), np.array([4, 2, 4, 3])
    pairs = [p for i, j in windows(first, end) for p in zip(i.tolist(), j.tolist())]
    assert pairs == [(0, 1), (0, 2), (0, 3), (2, 3)]


VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, class_no STRING"


def cosine_links(rows):
    good = {}
    for i, (_, vector, label, _) in enumerate(rows):
        if label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        v = np.array(vector, dtype=np.float32).astype(float)
        if v.any():
            good[i] = (label, len(v), v / np.sqrt(v @ v))
    return [
        (i, j) for i in good for j in good
        if i < j and good[i][:2] == good[j][:2] and good[i][2] @ good[j][2] >= 0.98
    ]


@pytest.mark.parametrize("block", [None, 16])
def test_near_duplicate_vectors(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    centres = rng.standard_normal((4, 24))
    for k in range(120):  # near copies of a few vectors, near the threshold
        v = centres[k % 4] + 0.14 * rng.standard_normal(24)
        rows.append((1000 + k, v.astype(np.float32).tolist(), k % 2, "x"))
    for k in range(60):
        rows.append((k, rng.standard_normal(24).astype(np.float32).tolist(), k % 3, None))
    rows += [(2000 + k, rows[0][1], 0, "copy") for k in range(40)]
    rows += [(3000, None, 0, ""), (3001, [], 0, ""), (3002, [0.0] * 24, 0, ""), (3003, rows[0][1], None, "")]
    rows += [(3004, [float("nan")] + [1.0] * 23, 0, ""), (3005, [None] + [1.0] * 23, 0, "")]
    rows += [(3006, [float("inf")] * 24, 0, ""), (3007, [1.0, 2.0], 0, ""), (3008, [2.0, 4.0], 0, "")]
    rows += [(2000, rows[0][1], 0, "repeated")]
    links = cosine_links(rows)
    degree = Counter(x for pair in links for x in pair)
    ids = [r[0] for r in rows]
    group = smallest_reachable(len(rows), links)
    least = {}
    for i, g in enumerate(group):
        least[g] = min(least.get(g, ids[i]), ids[i])
    expected = sorted(
        (ids[i], degree[i], least[group[i]], ids[i] == least[group[i]]) for i in range(len(rows))
    )
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    found = embedding_dedup.near_duplicate_vectors(frame, block=block)
    assert found.columns[:4] == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect())) == expected


def test_links_of_the_largest_and_smallest_doubles(spark):
    rows = [(1, [1.0, 2.0], 1, ""), (2, [3.0, 6.0], 1, "")]
    rows += [(10, [1e-200, 2e-200], 2, ""), (11, [2e-200, 2e-200], 2, "")]
    scales = [1.0, 1e200, 1e160, 1e-200, 5e-324 * 2**20, 1.7e308 / 2]
    rows += [(20 + k, [x, 2 * x, -x], 3, "") for k, x in enumerate(scales)]
    frame = spark.createDataFrame(rows, VECTORS.replace("FLOAT", "DOUBLE"))
    found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicate_vectors(frame).collect()}
    assert found == {1: 1, 2: 1, 10: 0, 11: 0, **{20 + k: 5 for k in range(6)}}


def test_buckets_are_cut_by_members_and_by_weight(spark):
    keyed = spark.range(400).selectExpr("0 AS k", "id AS m", "IF(id < 5, 1000, 1) AS w").unionByName(
        spark.range(3).selectExpr("1 AS k", "id AS m", "9000 AS w")
    )
    found = shared_buckets(keyed, ["k"], "m", block=100, weight="w", block_weight=500).collect()
    groups = {}
    for r in found:
        groups.setdefault((r["k"], r["left"], r["right"]), []).append(r)
    met = Counter()
    for (k, left, right), members in groups.items():
        for a, b in itertools.combinations(sorted(members, key=lambda r: r["m"]), 2):
            if left == right or a["mine"] != b["mine"]:
                met[k, a["m"], b["m"]] += 1
    # Every two members meet once, also where a member alone is beyond the bound.
    assert len(met) == 400 * 399 // 2 + 3 and set(met.values()) == {1}
    assert max(len(g) for g in groups.values()) < 200
    assert {r["right"] for r in found if r["k"] == 1} <= {0, 1, 2}


def test_null_ids_and_no_vectors(spark):
    rows = [(None, [1.0, 0.0], 1, ""), (4, [1.0, 0.0], 1, ""), (None, [0.0, 1.0], 1, "")]
    found = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(map(str, found)) == sorted(
        [
            "Row(vec_id=None, n_links=0, component_id=None, kept=False)",
            "Row(vec_id=None, n_links=1, component_id=None, kept=False)",
            "Row(vec_id=4, n_links=1, component_id=4, kept=True)",
        ]
    )
    empty = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.near_duplicate_vectors(empty).collect() == []


def test_calibrated_count_keeps_the_recall():
    p, n = embedding_dedup.collision_chance(), embedding_dedup.collisions_needed()
    rng = np.random.default_rng(2)
    missed = (rng.random((20_000, embedding_dedup.LINES)) < p).sum(axis=1) < n
    assert n > 1 and missed.mean() < 4 * embedding_dedup.MISS


def multiset(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if k else Counter()


def near_copy_rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(90)] = rng.choice(vocabulary)
        rows.append((k, " ".join(words)))
    for k in range(100, 125):
        rows.append((k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a b"), (204, "a  b"), (205, "b a")]
    rows += [(206, rows[5][1]), (207, "x y z q r " * 30), (208, "x y z q r " * 28), (209, "x y z q r " * 20)]
    rows += [(210, "long " + "word another " * 20_000), (211, "long " + "word another " * 20_000)]
    return rows


def jaccard_components(rows):
    sets = [multiset(text) for _, text in rows]
    links = []
    for i in range(len(sets)):
        for j in range(i):
            shared, every = sum((sets[i] & sets[j]).values()), sum((sets[i] | sets[j]).values())
            if every and 100 * shared >= 80 * every:
                links.append((j, i))
    return smallest_reachable(len(rows), links)


@pytest.mark.parametrize("block,group_bytes", [(None, None), (8, None), (None, 3000)])
def test_near_duplicate_documents(make_docs, monkeypatch, block, group_bytes):
    if group_bytes:
        monkeypatch.setattr(bagminhash, "GROUP_BYTES", group_bytes)
    rows = near_copy_rows()
    group = jaccard_components(rows)
    expected = [(rows[i][0], rows[g][0], i == g) for i, g in enumerate(group)]
    docs = make_docs(rows).withColumnRenamed("source", "class_no")
    found = bagminhash.near_duplicates(docs, block=block)
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in found.collect()]
    assert sorted(got) == sorted(expected)


def test_kept_rows_with_repeated_and_null_ids(make_docs):
    text = " ".join(f"t{k}" for k in range(40))
    rows = [(1, text), (1, text), (1, "other words here now"), (None, text), (None, None), (None, None), (9, text + " z")]
    kept = bagminhash.kept_documents(make_docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str)
    assert found == sorted([(1, text), (1, "other words here now"), (None, None), (None, None)], key=str)
    empty = make_docs(rows).where("doc_id = -1")
    assert bagminhash.kept_documents(empty).collect() == []


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    shares = []
    for trial in range(40):
        salt = np.uint64(rng.integers(1, 1 << 62))
        a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
        found = bagminhash.signatures(
            np.concatenate((hashes ^ salt, hashes ^ salt)), np.repeat([0, 1], 60),
            np.concatenate((a, b)), 2,
        )
        shares.append((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(shares)) < 0.02


def test_shingles_are_counted_per_text():
    texts = [b"a b c d e f", b"", b"a b", b"a b c d e", b" a b\nc\td e ", b"r r r r r r r"]
    hashes, owner = shingle_hashes(texts)
    assert np.bincount(owner, minlength=6).tolist() == [2, 0, 1, 1, 1, 3]
    each, of, count, _ = counted(hashes, owner)
    by_text = [set(each[of == i].tolist()) for i in range(6)]
    assert by_text[3] == by_text[4] and by_text[3] < by_text[0]
    assert count[of == 5].tolist() == [3]


class _Captured:
    """Takes the place of a frame, and keeps the function that tasks would run."""

    def select(self, *_):
        return self

    def distinct(self):
        return self

    def mapInArrow(self, function, _):
        self.function = function
        return self


def _hot_groups(groups: int, members: int) -> pa.RecordBatch:
    """Groups of one band, whose members all agree in 105 components or more."""
    rng = np.random.default_rng(7)
    sketches = np.tile(rng.integers(0, 256, bagminhash.COMPONENTS, dtype=np.uint8), (members, 1))
    for row in sketches:
        row[5 + rng.choice(bagminhash.COMPONENTS - 5, 10, replace=False)] = rng.integers(0, 256, 10)
    shared = rng.integers(0, 1 << 40, 60)
    sets = [
        np.unique(np.append(shared, rng.integers(0, 1 << 40, 1 + k % 40))).astype("<u8")
        .view(np.uint8).reshape(-1, 8)[:, : bagminhash.HASH_BYTES].tobytes()
        for k in range(members)
    ]
    n = groups * members
    place = np.repeat(np.arange(groups, dtype=np.int32), members)
    band = np.full(n, int.from_bytes(bytes(sketches[0, :5]), "big"))
    number = np.tile(np.arange(members), groups)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(band), pa.array(place), pa.array(place), pa.array(place), pa.array(number),
            pa.array(number), pa.array([r.tobytes() for r in sketches] * groups, pa.binary()),
            pa.array(sets * groups, pa.binary()),
        ],
        names=["band", "left", "right", "mine", "class_no", "component", "sketch", "shingles"],
    )


def _task(monkeypatch, step):
    monkeypatch.setattr(bagminhash, "in_groups", lambda members, _: members)
    return step(_Captured()).function


def test_likely_pairs_of_a_hot_group_take_little_memory(monkeypatch):
    task, batch = _task(monkeypatch, bagminhash._likeliest_pairs), _hot_groups(1, 600)
    tracemalloc.start()
    found = [p for b in task(iter([batch])) for p in zip(*(c.to_pylist() for c in b.columns))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # A forest of all 600, the pairs themselves are 179,700.
    assert len(found) == len(set(found)) == 599
    assert peak < 25_000_000


def test_shingles_are_numbered_for_some_groups_at_once(monkeypatch):
    batch = _hot_groups(6, 50)
    task = _task(monkeypatch, bagminhash._linked_components)

    def links() -> set[tuple[int, int]]:
        return {p for b in task(iter([batch])) for p in zip(*(c.to_pylist() for c in b.columns))}

    sets = [set(np.frombuffer(r.as_py(), "V6").tolist()) for r in batch.column("shingles")[:50]]
    alike = {
        (a, b) for a in range(50) for b in range(a + 1, 50)
        if 100 * len(sets[a] & sets[b]) >= bagminhash.SIMILAR_PCT * len(sets[a] | sets[b])
    }

    def parts(pairs: set[tuple[int, int]]) -> list[int]:
        forest = Forest(50)
        for a, b in pairs:
            forest.joins(a, b)
        return [forest.find(k) for k in range(50)]

    together = links()
    assert together <= alike and parts(together) == parts(alike)
    numbered, real = [], bagminhash._numbered
    monkeypatch.setattr(bagminhash, "_numbered", lambda c: numbered.append(len(c)) or real(c))
    monkeypatch.setattr(bagminhash, "NUMBERED_BYTES", 50_000)
    some = links()
    assert some <= alike and parts(some) == parts(alike)
    assert sum(numbered) == 300 and len(numbered) > 1 and all(n % 50 == 0 for n in numbered)
