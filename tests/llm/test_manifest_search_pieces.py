from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.llm import lexical_search, merkle, piece_bpe
from cohortry.llm.tokens import text_runs

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- manifest


def leaf(row, n_chars):
    values = (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return found


def siblings(tree, place):
    found = []
    for level in tree[:-1]:
        other = place ^ 1
        found.append((level[other] if other < len(level) else None, place & 1))
        place >>= 1
    return found


def expected_proofs(rows):
    groups = defaultdict(list)
    for row in rows:
        n = row["n_chars"]
        if n is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["doc_id"] is not None:
            n += 1
        key = (row["doc_id"] is not None, row["doc_id"] or 0)
        groups[row["lang"]].append((key, leaf(row, row["n_chars"]), leaf(row, n), row["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:2])
        trees[name] = levels([x[1] for x in groups[name]])
    top = levels([trees[name][-1][0] for name in names])
    root, found = top[-1][0], []
    for place, name in enumerate(names):
        for i, (_, own, tampered, doc_id) in enumerate(groups[name]):
            path = siblings(trees[name], i) + siblings(top, place)
            acc = tampered
            for other, left in path:
                acc = sha(acc) if other is None else sha(other + acc) if left else sha(acc + other)
            proof = sha("".join(other for other, _ in path if other))
            found.append((doc_id, own, trees[name][-1][0], root, proof, acc, acc == root))
    return sorted(found, key=str)


def proofs(frame):
    return sorted((tuple(r) for r in merkle.verify_documents(frame).collect()), key=str)


def test_manifest_equals_the_brute_force_version(spark):
    rows = [(i, f"text {i}", ["en", "de", "fr"][i % 3], "web", i) for i in range(700)]
    rows += [(i, "", None, None, None) for i in range(700, 703)]
    rows += [(800, None, "a lone one", "x", 5), (801, "long " * 50_000, "", "x", None)]
    rows += [(None, "no id", "en", "web", 3), (-7, "é 日本", "日本", "ü", 3), (7, "again", "en", "web", 1)]
    frame = spark.createDataFrame(rows, DOCS)
    assert proofs(frame) == expected_proofs(frame.collect())


def test_manifest_of_equal_rows_and_clashing_columns(spark):
    """Equal rows have equal blocks, which are stored once."""
    rows = [(5, "same", "en", "web", 4)] * 1500 + [(9, "other", "en", "web", 4)]
    frame = spark.createDataFrame(rows, DOCS).repartition(4)
    for name in ("group", "rank", "digest", "leaves", "path", "_at", "level0"):
        frame = frame.withColumn(name, F.lit("x"))
    assert proofs(frame) == expected_proofs([dict(zip(DOCS_NAMES, r)) for r in rows])


DOCS_NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def test_manifest_of_an_empty_table_and_of_one_row(spark):
    assert proofs(spark.createDataFrame([], DOCS)) == []
    [row] = proofs(spark.createDataFrame([(1, "a", None, None, 1)], DOCS))
    # The leaf is the root, and the proof is empty.
    assert row[1] == row[2] == row[3] == row[5] and row[4] == sha("") and row[6]


def test_single_leaves_are_proved(spark):
    rows = [(i, f"t{i}", "en" if i % 4 else "de", None, i) for i in range(1200)]
    manifest = merkle.build_manifest(spark.createDataFrame(rows, DOCS))
    wanted = spark.createDataFrame([("=en", 0), ("=en", 899), ("=de", 7), ("=de", 5000), ("=xx", 0)], "group STRING, rank BIGINT")
    found = merkle.prove(manifest, wanted).join(manifest.leaves, ["group", "rank"]).selectExpr(
        "group", "rank", f"{merkle.fold('digest')} = lower(hex(root)) AS fits",
        f"{merkle.fold('subroot')} = lower(hex(root)) AS wrong",
    )
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == [("=de", 7, True, False), ("=en", 0, True, False), ("=en", 899, True, False)]


# ---- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def expected_ranks(docs, items, top):
    cut = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    lengths = [sum(c.values()) for _, c in cut]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in cut for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id] |= set(terms(text))
    found = []
    for item_id, words in asked.items():
        scored = []
        for (doc_id, counts), n in zip(cut, lengths):
            if n:
                m = 100 - 50 + (50 * n * n_docs) // n_terms
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
                    for t in words if t in counts
                )
                if score > 0:
                    scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], start=1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=str)


def ranks(spark, docs, items, top, **options):
    docs = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").withColumn("score", F.lit("x"))
    docs = docs.withColumn("term", F.lit(1)).withColumn("item_id", F.lit(2)).repartition(4)
    items = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("doc_id", F.lit(1))
    return sorted((tuple(r) for r in lexical_search.search(docs, items, top, **options).collect()), key=str)


def test_search_equals_the_brute_force_version(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "GAMMA", "été", "Ünder", "x1", "日本", "the", "of", "rare"]
    docs = [(i, " ".join(rng.choice(words[:9], rng.integers(0, 30)))) for i in range(300)]
    docs += [(i, docs[5][1]) for i in range(400, 460)]  # ties beyond the last rank
    docs += [(7, docs[7][1]), (None, docs[5][1]), (500, None), (501, ""), (502, "--- !!"), (503, "a\x00b the\nthe")]
    docs += [(504, "alpha " * 40_000)]
    items = [(1, "Alpha beta été"), (2, "gamma the the THE"), (2, "x1"), (None, "日本 of"), (4, None), (5, "--"),
             (6, "rare absent"), (7, "b a"), (8, "of")]
    assert ranks(spark, docs, items, 20) == expected_ranks(docs, items, 20)
    # Two items a pass, and narrow tiles.
    monkeypatch.setattr(lexical_search, "TILE_DOCS", 16)
    assert ranks(spark, docs, items, 20, pass_pairs=4) == expected_ranks(docs, items, 20)


def test_narrow_tiles_give_the_same_scores():
    rng = np.random.default_rng(4)
    has = (rng.random((9, 70)) < 0.3).astype(float)
    weights = rng.integers(0, 40_000, 70)
    doc, term = np.nonzero(rng.random((40, 70)) < 0.2)
    count, length = rng.integers(1, 9, len(doc)), rng.integers(50, 400, 40)
    whole = lexical_search.score_tile(has, weights, doc, term, count, length)
    impact = weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * length[doc]))
    plain = np.zeros((9, 40), np.int64)
    for d, t, x in zip(doc, term, impact):
        plain[:, d] += (has[:, t] > 0) * x
    assert (whole == plain).all()
    lexical_search.TILE_TERMS, kept = 3, lexical_search.TILE_TERMS
    try:
        assert (lexical_search.score_tile(has, weights, doc, term, count, length) == plain).all()
    finally:
        lexical_search.TILE_TERMS = kept


def test_products_stay_exact():
    weights = np.array([80_000])
    assert lexical_search.terms_per_product(weights) * 80_000 * 1_000_000 < 2**53
    with pytest.raises(ValueError):
        lexical_search.terms_per_product(np.array([1 << 40]))


def test_search_of_empty_tables(spark):
    assert ranks(spark, [], [(1, "a")], 5) == []
    assert ranks(spark, [(1, "a")], [], 5) == []
    assert ranks(spark, [(1, None)], [(1, "a")], 5) == []


# ---- pieces

ODD = ["", " ", "  ", "a  b", " a ", "▁", "▁ a▁ b", "<s> </s> <unk> <0x41>", "\x00\n\t\r", "😀é日本", "x" * 200,
       "the " * 300, "   " * 40 + "z", "a" * 39, "a" * 40, "a" * 41, "é" * 100, None, "12345 1 2"]


def library_ids(texts):
    library = piece_bpe.encoder().library
    return [library.encode(t or "") for t in texts]


def own_ids(encoder, texts):
    return [i.tolist() for i in encoder.encode(pa.array(texts, pa.string()))]


def test_ids_are_those_of_the_library(spark, small):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    encoder = piece_bpe.PieceEncoder(cache_segments=300)  # forgets many times
    for run in text_runs(pa.array(texts), 20_000):
        assert own_ids(encoder, texts[run]) == library_ids(texts[run])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abtheing ▁1é\n日😀\x00"), max_size=120) | st.text(max_size=30), max_size=4))
def test_ids_of_any_text(texts):
    assert own_ids(piece_bpe.encoder(), texts) == library_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abtheing ▁1é日"), min_size=1, max_size=60))
def test_one_agenda_and_rows_of_agendas_agree(segment):
    encoder = piece_bpe.encoder()
    symbols, left = encoder.merge_rows([segment])
    assert symbols.tolist() == encoder.merge_one(segment).tolist() and left.tolist() == [len(symbols)]


def test_a_difference_ends_the_job():
    encoder = piece_bpe.encoder()
    with pytest.raises(ValueError, match="differ"):
        encoder.check(pa.array(["some text"]), [np.array([1, 2], np.int32)])


def test_round_trip_and_its_parts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a  b"), (None, "no id"), (99, "word " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("ids", F.lit(1)).repartition(3)
    library = piece_bpe.encoder().library
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, piece_bpe.round_trip(docs).collect()), key=str) == sorted(expected, key=str)
    decoded = piece_bpe.decode_documents(piece_bpe.encode_documents(docs)).collect()
    assert sorted((str(r[0]), sha(r[1])) for r in decoded) == sorted((str(e[0]), e[3]) for e in expected)
    assert piece_bpe.round_trip(docs.limit(0)).collect() == []
