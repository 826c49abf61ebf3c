from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortry.llm import elias_fano, packing, token_files
from cohortry.llm.tokens import TOKENIZER, WordEncoder, text_runs
from cohortry.plans.durable import scratch_path

WHOLE = Tokenizer.from_file(TOKENIZER)


def whole_ids(text):
    return np.asarray(WHOLE.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


ODD = [
    "a<|endoftext|>b  It's  ÀÉ x", "don't he'LL ²³ ª ſ İ ß ẞ", "a\x1cb \x0b c d é  z", "", "   ",
    None, "😀😀 a1b22", "'S 's", " <|startoftext|>x", "a\x85b\xa0c", "x\r\ny\tz\x0cw", "ÅÅ",
    "the the the, THE. The!?",
]


def test_words_give_the_ids_of_whole_texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("text").collect()
    texts = ODD + [r["text"] for r in rows]
    encoder = WordEncoder(cache_words=500)  # the caches turn over many times
    for run in text_runs(pa.array(texts), 20_000):
        for text, ids in zip(texts[run], encoder.encode(pa.array(texts[run], pa.string()))):
            assert ids == whole_ids(text).tobytes(), text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text_gives_the_same_ids(texts):
    found = _shared.encode(pa.array(texts, pa.string()))
    assert found == [whole_ids(t).tobytes() for t in texts]


_shared = WordEncoder()


def test_plain_words_skip_the_rules_of_the_vocabulary(monkeypatch):
    latin = [chr(c) for c in range(0x21, 0x100)]
    texts = [" ".join(latin), "".join(latin), *(f"{c}x{c} a{c} {c}{c}B, don't" for c in latin)]
    # Not plain: blanks beyond ASCII and the soft hyphen.
    plain = ["".join(c for c in t if not "\x7f" <= c <= "\xa0" and c != "\xad") for t in texts]
    for some in (texts, plain):
        found = WordEncoder().encode(pa.array(some, pa.string()))
        assert found == [whole_ids(t).tobytes() for t in some]

    encoder = WordEncoder()
    monkeypatch.setattr(encoder, "_tokenizer", None)
    assert encoder.encode(pa.array(plain, pa.string())) == [whole_ids(t).tobytes() for t in plain]


@pytest.mark.parametrize("name, rule", [
    ("normalizer", None),
    ("normalizer", {"type": "Sequence", "normalizers": [{"type": "NFC"}]}),
    ("pre_tokenizer", "add_prefix_space"),
])
def test_other_rules_are_kept(tmp_path, name, rule):
    with open(TOKENIZER, encoding="utf-8") as source:
        vocabulary = json.load(source)
    if rule == "add_prefix_space":
        vocabulary[name]["pretokenizers"][1][rule] = True
    else:
        vocabulary[name] = rule
    path = tmp_path / "other.json"
    path.write_text(json.dumps(vocabulary), encoding="utf-8")
    library = Tokenizer.from_file(str(path))
    texts = ["The Quick fox, don't STOP", "Évian à 12 km", "the the"]
    expected = [
        np.asarray(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts
    ]
    assert WordEncoder(str(path)).encode(pa.array(texts)) == expected


def test_runs_cover_a_batch_and_hold_long_texts_alone():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c" * 10])
    assert text_runs(texts, 50) == [slice(0, 2), slice(2, 3), slice(3, 5)]
    assert text_runs(pa.array([], pa.string()), 50) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=700))
def test_elias_fano_round_trip(values):
    values = np.cumsum(values, dtype=np.int64)
    code = elias_fano.EliasFano(elias_fano.encode(values))
    assert code.values().tolist() == values.tolist()
    for i in range(0, len(values), 37):
        assert code.select(i) == values[i]


def test_elias_fano_refuses_what_it_cannot_hold():
    with pytest.raises(ValueError):
        elias_fano.encode(np.array([3, 1]))
    with pytest.raises(IndexError):
        elias_fano.EliasFano(elias_fano.encode(np.array([1]))).select(1)
    values = np.full(1000, 7)
    assert elias_fano.EliasFano(elias_fano.encode(values)).select(999) == 7


def written(spark, docs, **options):
    path = scratch_path(spark, "ids")
    token_files.write_ids(docs, path, **options)
    return path


def test_files_give_back_every_document(spark, make_docs):
    rows = [(k, t) for k, t in zip((5, 3, 9, 1, 7, None, 3), ("a b", "b c d", "", None, "x" * 9000, "n", "b c d"))]
    rows += [(100 + k, f"word{k} more") for k in range(50)]
    path = written(spark, make_docs(rows).withColumnRenamed("lang", "start"), block_ids=60)
    found = token_files.read_documents(spark, path).collect()
    expected, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.append(whole_ids(text), np.uint32(1)).astype("<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected

    block = token_files.read_blocks(spark, path).where("size(doc_ids) > 1").first()
    at, ids = token_files.document_ids(block, 1)
    one = dict(rows)[block["doc_ids"][1]]
    assert ids.tolist() == [*whole_ids(one).tolist(), 1]
    assert at >= block["shard_start"]


def test_no_documents(spark, make_docs):
    empty = make_docs([(1, "a")]).where("doc_id < 0")
    assert token_files.read_documents(spark, written(spark, empty)).collect() == []
    assert packing.pack_documents(empty).collect() == []


def check_packing(rows, found, capacity):
    """Every id once, gapless sequences within the capacity, only long documents cut."""
    pieces = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    expected = sorted(
        (key, n, at, min(capacity, len(ids) - at), zlib.crc32(ids[at : at + capacity].tobytes()))
        for key, text in rows
        for ids in [np.append(whole_ids(text), np.uint32(0)).astype("<u4")]
        for n, at in enumerate(range(0, len(ids), capacity))
    )
    assert expected == sorted(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found
    )
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_is_gapless_and_tight(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = packing.pack_documents(docs).collect()
    used = check_packing(rows, found, 2048)
    assert used <= sum(r["length"] for r in found) / 2048 * 1.02 + 2


def test_packing_in_several_rounds(spark, make_docs):
    rows = [(k, "w " * (k * 7 % 23)) for k in range(400)] + [(1000, None), (1001, ""), (1002, "q " * 95)]
    rows += [(7, "again " * 30)]  # a doc_id that occurs twice
    pieces = packing.cut_documents(make_docs(rows), 32)
    found = packing.pack(pieces, 32, slack=0, items_per_task=40, fan_in=2).collect()
    used = check_packing(rows, found, 32)
    assert used <= sum(r["length"] for r in found) / 32 * 1.03 + 2


def test_items_that_cannot_be_combined(spark, make_docs):
    rows = [(k, "w " * 19) for k in range(100)]
    found = packing.pack(packing.cut_documents(make_docs(rows), 32), 32, items_per_task=10).collect()
    assert check_packing(rows, found, 32) == 100


def test_sequences_hold_the_ids(spark, make_docs):
    rows = [(k, f"text number {k} " * (k % 5)) for k in range(20)] + [(3, "text number 3 " * 3)]
    docs = make_docs(rows)
    placed = packing.pack_documents(docs, 16)
    stored = spark.createDataFrame(placed.collect(), placed.schema)
    ids = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in
           packing.sequence_ids(docs, stored, 16).collect()}
    for r in stored.collect():
        part = ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(part.astype("<u4").tobytes()) == r["ids_crc32"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_takes_the_tightest_bin(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, places = packing.best_fit(lengths, 20)
    free, expected = [], {}
    for item in np.argsort(-lengths, kind="stable"):
        fitting = [f for f in free if f >= lengths[item]]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - lengths[item])
        else:
            free.append(20 - lengths[item])
    assert len(set(bins.tolist())) == len(free)


def test_packing_encodes_short_runs_and_gives_memory_back(monkeypatch):
    class Captured:
        def select(self, *_):
            return self

        def mapInArrow(self, function, _):
            return function

    runs, released = [], []

    class Encoder:
        def encode(self, texts):
            runs.append(sum(len(t) for t in texts.to_pylist()))
            return [b"\1\0\0\0"] * len(texts)

    monkeypatch.setattr(packing, "encoder", lambda _: Encoder())
    monkeypatch.setattr(packing, "release_memory", lambda: released.append(1))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array(["a" * 1_500_000, "b" * 1_500_000, "c"])], names=["doc_id", "text"]
    )
    rows = [r for b in packing.cut_documents(Captured())(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [1, 2, 3] and [r["length"] for r in rows] == [2, 2, 2]
    assert runs == [1_500_000, 1_500_001] and released == [1]
