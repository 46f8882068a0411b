from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_df(spark):
    """Documents from (doc_id, text[, source]) rows, with an extra column
    whose name clashes with one the operators use."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, "x") for r in rows]
        return spark.createDataFrame(full, DOC + ", n_words int, row string")
    return make


@pytest.fixture()
def labels_df(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, quality int, toxic int")
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
