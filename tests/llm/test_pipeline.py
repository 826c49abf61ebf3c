from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_mixing_quality import counts
from test_similarity import jaccard_components
from test_text_models import LABELS, labelled_texts
from test_tokens import check_packing

import __spark_entry__ as registry
import corpus_pipeline
from cohortry.llm import mixing, quality, toxicity
from cohortry.llm.queries import ORACLES, QUERIES

CONTRACT = {
    "op1": ("embeddings", ["vec_id", "n_links", "component_id", "kept"]),
    "op2": ("documents", ["doc_id", "size", "source_size", "target", "taken"]),
    "op4": (None, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]),
    "op5": ("documents", ["doc_id", "held_out", "score", "predicted"]),
    "op6": ("documents", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    "op7": ("pages", ["page_id", "url", "text", "n_chars"]),
    "op8": ("documents", ["doc_id", "held_out", "lang_pred", "score"]),
    "op9": ("documents", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept"]),
    "op10": ("documents", ["doc_id", "component_id", "kept"]),
    "op11": ("documents", ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]),
    "op12": ("documents", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    "op13": (None, ["item_id", "rank", "doc_id", "score"]),
}


def test_all_are_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
    assert set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in CONTRACT))
def test_queries_answer_for_every_row(spark, small, name):
    table, columns = CONTRACT[name.split("_")[0]]
    found = QUERIES[name](spark, small)
    assert set(columns) <= set(found.columns)
    rows = found.count()
    if table:
        assert rows == spark.read.parquet(f"{small}/{table}.parquet").count()


WORKING = ("_row", "_doc", "copies", "_r", "score", "kept", "n", "size", "sequence_id", "class_no", "component_id")


def odd_documents(spark, folder):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    plain = " ".join(f"word{k % 700} said" for k in range(60_000)) + "."
    rows = [(k, f"{t} and more plain words to read" * 4, "en", "s", 5) for k, t, y in labelled_texts(60) if not y]
    rows += [(None, rows[0][1] + " null id", None, None, None), (None, None, None, None, None), (900, "", "", "", 0)]
    rows += [(901, plain, "en", "s", len(plain)), (902, None, "en", "s", 0), (3000, "x" * 300_000, "en", None, 1)]
    rows += [rows[1]] * 40
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for k, name in enumerate(WORKING):
        docs = docs.withColumn(name, F.lit(f"{name} {k}"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, y) for k, _, y in labelled_texts(60)] + [(None, 1, 1), (901, None, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_take_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    docs = odd_documents(spark, folder)
    given = Counter(docs.select("doc_id").collect())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows or name == "quality rules"
        assert all(r[n] == f"{n} {i}" for r in rows for i, n in enumerate(WORKING))
        ids = Counter(found.select("doc_id").collect())
        if name != "mixing sources to target weights":
            assert all(n <= given[d] for d, n in ids.items())
        if name != "quality rules":
            assert any(r["doc_id"] == 901 and len(r["text"]) > 500_000 for r in rows), name
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    # An empty document has its end id; a long one is cut, with nothing lost.
    assert [r["length"] for r in placed if r["doc_id"] == 900] == [1]
    assert len(placed) > 100 and all(r["length"] <= 2048 for r in placed)
    assert corpus_pipeline.run(spark, folder).columns[:2] == ["sequence_id", "doc_id"]


def test_stages_take_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    docs = odd_documents(spark, folder).where("doc_id = -5")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        assert found.collect() == [], name
        if name != "best-fit packing":
            assert found.columns == docs.columns


def documents():
    rows = [(k, t + (" and so on it goes with words" * 8), "en", f"s{k % 3}") for k, t, _ in labelled_texts(120)]
    rows += [(500 + k, rows[k][1] + " tail", "en", None) for k in range(1, 12)]
    rows += [(600, "short one", "en", "s0"), (601, None, "en", "s1"), (602, "", None, None), (3, rows[3][1], "en", "s0")]
    rows += [(700 + k, "*** ### $$$ %%% " * 40 + f"x{k}", "en", "s1") for k in range(4)]
    return rows


def test_every_stage_against_its_rule(spark, make_docs, tmp_path):
    rows = documents()
    folder = str(tmp_path)
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in labelled_texts(120)], LABELS)
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, results[-1], folder).write.parquet(f"{folder}/out{k}")
        results.append(spark.read.parquet(f"{folder}/out{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert results[-1].columns == docs.columns

    def listed(frame):
        return Counter((r["doc_id"], r["text"], r["source"]) for r in frame.collect())

    raw, clean, good, single, mixed = map(listed, results[:5])
    model = toxicity.learn(docs, labels)
    keys = sorted(raw, key=str)
    scores, _ = toxicity.assess([t for _, t, _ in keys], toxicity._Scores(model))
    assert clean == Counter({k: raw[k] for k, s in zip(keys, scores) if s < 0.5})
    assert 0 < sum(clean.values()) < len(rows)

    verdict = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality.quality_rules(results[1]).collect()}
    base = {k: counts(k[1]) for k in clean}
    assert good == Counter({k: n for k, n in clean.items() if verdict[k[0], base[k]["n_words"]]})
    assert all(not base[k]["base_failed"] for k in good) and not any(k[0] and k[0] >= 600 for k in good)

    ordered = sorted(good.elements(), key=lambda k: (k[0] is None, k[0], k[1]))
    group = jaccard_components([(k[0], k[1]) for k in ordered])
    assert single == Counter(k for k, g, i in zip(ordered, group, range(len(group))) if g == i)

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(results[3]).collect()}
    assert mixed == Counter({k: copies[k[0]] for k in single if copies[k[0]]})

    found = results[5].collect()
    check_packing([(k[0], k[1]) for k in mixed], _once(found), 2048)
    assert len(found) == sum(mixed[k] * len(_pieces(found, k[0])) for k in mixed)

    again = corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect()
    assert Counter(again) == Counter(results[5].drop("sequence_id", "offset").collect())


def _pieces(found, key):
    return {r["piece"] for r in found if r["doc_id"] == key}


def _once(found):
    """One placement per piece, each in a sequence of its own from 0, for the id check."""
    from pyspark.sql import Row

    first = {(r["doc_id"], r["piece"]): r for r in found}
    return [Row(**{**r.asDict(), "sequence_id": n, "offset": 0}) for n, r in enumerate(first.values())]
