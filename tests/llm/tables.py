"""Fixtures over the documents of the test folder."""

import pytest


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
