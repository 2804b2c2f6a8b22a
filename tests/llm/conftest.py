import os

import pytest


@pytest.fixture(autouse=True, scope="session")
def _path():
    os.environ.setdefault("PYTHONHASHSEED", "0")


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with those that operators add."""

    def of(texts, ids=None, extra="score double, n_words long, fingerprint string, ids string, n_lines int"):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, None, None, None, None) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")

    return of
