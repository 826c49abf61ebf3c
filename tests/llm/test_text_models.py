from __future__ import annotations

import itertools
import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortry.llm import language_id, toxicity
from cohortry.llm.toxicity import Model


def brute_marginals(scores, start, moves):
    """Marginals of one chain by listing all its labellings."""
    total, toxic = 0.0, np.zeros(len(scores))
    for labels in itertools.product((0, 1), repeat=len(scores)):
        value = start[labels[0]] + sum(s * y for s, y in zip(scores, labels))
        value += sum(moves[a][b] for a, b in zip(labels, labels[1:]))
        total += np.exp(value)
        toxic += np.exp(value) * np.array(labels)
    return toxic / total


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    model = Model(start=np.array([0.0, -0.7]), moves=np.array([[0.0, -1.5], [-0.4, 0.9]]))
    chains = [rng.normal(0, 2, n) for n in (1, 7, 2, 1, 10, 4)]
    first = np.concatenate([np.arange(len(c)) == 0 for c in chains])
    found = toxicity.toxic_marginals(np.concatenate(chains), first, model)
    expected = np.concatenate([brute_marginals(c, model.start, model.moves) for c in chains])
    assert np.allclose(found, expected)
    assert len(toxicity.toxic_marginals(np.zeros(0), np.zeros(0, bool), model)) == 0


def labelled_texts(n=300, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rude = ["vilebad", "grubnasty", "zorkfilth"]
    rows = []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = k % 5 == 0
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text) + 1), rng.choice(rude) + rng.choice(["", "er", "ing"]))
        rows.append((k, " ".join(text), int(toxic)))
    return rows


def fold(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


LABELS = "doc_id BIGINT, quality INT, toxic INT"


def test_toxic_documents_are_found(spark, make_docs):
    rows = labelled_texts()
    docs = make_docs([r[:2] for r in rows]).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows], LABELS)
    found = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    for key, text, toxic in rows:
        r = found[key]
        assert r["held_out"] == fold(key)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if toxic:
            assert any(text[s["start"] : s["end"]].startswith(("vile", "grub", "zork")) for s in r["spans"])
    right = [found[k]["predicted"] == y for k, _, y in rows if fold(k)]
    assert sum(right) >= 0.97 * len(right)


def test_a_label_of_long_texts_alone_is_learnt(spark, make_docs):
    clean = [(k, "calm words about the weather and the sea " * 5, 0) for k in range(60)]
    toxic = [(100 + k, "calm words about the weather vilebad sea " * 600, 1) for k in range(10)]
    unread = [(200 + k, None, 1) for k in range(40)]
    rows = clean + toxic + unread
    docs, labels = make_docs([r[:2] for r in rows]), [(k, 1, y) for k, _, y in rows]
    frame = spark.createDataFrame(labels, LABELS)
    texts, marks, share = toxicity.learning_sample(docs, frame)
    assert sum(marks) == sum(not fold(k) for k, _, _ in toxic) and sum(map(len, texts)) < 2_100_000
    # Labels without a text do not count.
    assert share == sum(marks) / len(marks)
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, frame).collect()}
    assert all((found[k] >= 0.5) == (y == 1) for k, _, y in clean + toxic)


def test_a_long_clean_text_is_kept(spark, make_docs):
    rows = labelled_texts()
    rng = random.Random(3)
    usual = sorted({w for _, t, y in rows if not y for w in t.split()})
    long = (9001, " ".join(rng.choice(usual) for _ in range(60_000)))
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows], LABELS)
    kept = toxicity.clean_documents(make_docs([*[r[:2] for r in rows], long]), labels)
    assert 9001 in {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_labels_of_the_held_out_rows_are_never_read(spark, make_docs):
    rows = labelled_texts()
    docs = make_docs([r[:2] for r in rows])

    def scores(flip):
        labels = [(k, 1, 1 - y if flip and fold(k) else y) for k, _, y in rows]
        found = toxicity.score_documents(docs, spark.createDataFrame(labels, LABELS))
        return sorted((r["doc_id"], r["score"]) for r in found.collect())

    assert scores(False) == scores(True)


def test_odd_texts_and_labels(spark, make_docs):
    rows = labelled_texts(150)
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, "!!! ..."), (None, "vilebad"), (1005, "İVILEBAD x"),
           (1006, "word " * 60_000 + "vilebad grubnasty"), (3, rows[3][1])]
    labels = [(k, 1, y) for k, _, y in rows] + [(None, 1, 1), (7, None, None), (5, 0, 1), (9999, 1, 1)]
    docs = make_docs([r[:2] for r in rows] + odd)
    found = toxicity.score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in found}
    assert len({by_id[k]["score"] for k in (1000, 1001, 1002, 1003)}) == 1
    assert by_id[1000]["predicted"] == 0 and by_id[None]["held_out"] is False
    assert by_id[1006]["predicted"] == 1 and by_id[1006]["spans"][-1]["end"] == 300_017
    kept = toxicity.clean_documents(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r["predicted"] for r in found)
    nothing = docs.where("doc_id = -1")
    assert toxicity.score_documents(nothing, spark.createDataFrame(labels, LABELS)).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1), (2, 1, 1)]])
def test_without_both_labels_all_scores_are_equal(spark, make_docs, labels):
    docs = make_docs([(k, f"text {k}") for k in range(6)] + [(9, None)])
    found = toxicity.score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {r["score"] for r in found} == {float(bool(labels) and labels[0][2])}


def test_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {r["doc_id"]: r for r in language_id.identify(docs.withColumnRenamed("source", "score")).collect()}
    right = []
    for r in docs.collect():
        got = found[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= got["score"] <= 1
        if got["held_out"]:
            right.append(got["lang_pred"] == r["lang"])
    assert sum(right) >= 0.97 * len(right)


def language_rows():
    rng = random.Random(2)
    words = {"aa": "kalo mira tolu".split(), "bb": "ßtrü öhmd zwick".split(), "cc": "это язык другой".split()}
    rows = []
    for k in range(120):
        name = sorted(words)[k % 3]
        rows.append((k, " ".join(rng.choice(words[name]) for _ in range(12)), name, "s"))
    return rows


def test_languages_of_odd_texts(make_docs):
    rows = language_rows()
    odd = [(200, None, "aa", None), (201, "", None, None), (202, "12 %% 3", "bb", None), (203, "KALO MIRA", None, None),
           (204, "kalo " * 50_000, None, None), (None, "öhmd", "cc", None), (0, rows[0][1], None, None)]
    found = language_id.identify(make_docs(rows + odd)).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[k]["lang_pred"] for k in (200, 201, 202, 203, 204)] == ["und", "und", "und", "aa", "aa"]
    assert by_id[200]["score"] == 0 and by_id[None]["lang_pred"] == "bb"
    assert all(by_id[k]["lang_pred"] == name for k, _, name, _ in rows)


def test_held_out_languages_are_never_read(make_docs):
    rows = language_rows()
    flipped = [(k, t, "aa" if zlib.crc32(str(k).encode()) % 3 == 1 else n, s) for k, t, n, s in rows]
    results = [
        sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.identify(make_docs(x)).collect())
        for x in (rows, flipped)
    ]
    assert results[0] == results[1]


def test_every_language_is_learnt(make_docs):
    """More than a hundred, and one whose texts are all long."""
    letters = [chr(0x4E00 + k) for k in range(130)]
    rows = [(4 * k + i, c * 3, f"l{k}", None) for k, c in enumerate(letters) for i in range(4)]
    rows += [(9000 + i, "omega " * (2000 + i), "long", None) for i in range(8)]
    rows += [(9100 + i, "psi " * (5000 if i % 2 else 5), "both", None) for i in range(16)]
    texts, languages = language_id.learning_sample(make_docs(rows))
    learnt = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert set(languages) == learnt and {"long", "both"} < learnt and len(learnt) > 120
    assert max(len(t) for t, lang in zip(texts, languages) if lang == "both") == 20
    model = language_id.fit(texts, languages)
    shown = [(c * 3, f"l{k}") for k, c in enumerate(letters) if f"l{k}" in learnt]
    assert language_id.judge([c for c, _ in shown], model)[0] == [name for _, name in shown]
    assert language_id.judge(["omega omega"], model)[0] == ["long"]


def test_no_language_and_no_documents(make_docs):
    docs = make_docs([(k, "some text") for k in range(5)])
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(docs).collect()} == {("und", 0.0)}
    assert language_id.identify(docs.where("doc_id < 0")).collect() == []


def test_kernel_counts_shared_n_grams():
    texts = ["the cat", "THE  cat!", "the hat", "qqq"]
    flags, _ = language_id.presence(texts)
    unit = language_id._unit(flags)

    def grams(text):
        text = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = grams(a), grams(b)
            expected = len(x & y) / np.sqrt(len(x) * len(y))
            assert (unit[i] @ unit[j]) == pytest.approx(expected, abs=0.05)


def test_a_model_of_many_languages_stays_small(monkeypatch):
    rng = random.Random(6)
    names = [f"l{k:03d}" for k in range(130)]
    own = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for n in names}
    shown = [(" ".join(rng.choice(own[n]) for _ in range(30)), n) for n in names for _ in range(4)]
    model = language_id.fit(*map(list, zip(*shown)))
    texts = [" ".join(rng.choice(own[n]) for _ in range(25)) for n in names]
    found, scores = language_id.judge(texts, model)
    assert sum(f == n for f, n in zip(found, names)) >= 125
    # Four kilobytes a landmark are sent, also once the flags were spread out.
    marks = len(model.landmarks.bits)
    assert len(pickle.dumps(model.landmarks)) < 4200 * marks + 1000
    # Blocks of landmarks, of any size, give the same.
    monkeypatch.setattr(language_id, "MARKS", 7)
    again = language_id.judge(texts, pickle.loads(pickle.dumps(model)))
    assert again[0] == found and np.allclose(again[1], scores, atol=1e-4)


def test_a_worker_gives_memory_back_after_its_task(spark, monkeypatch):
    released = []
    monkeypatch.setattr(toxicity, "release_memory", lambda: released.append(1))
    scored = toxicity.toxicity(toxicity.Model(constant=0.0)).func
    rated = list(scored(iter([pa.array(["one", None]), pa.array([], pa.string())])))
    assert [len(r) for r in rated] == [2, 0] and released == [1]
