from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def small():
    return FOLDER


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, partitions=3):
        full = [(*r, *(None, None)[: 4 - len(r)], len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make
