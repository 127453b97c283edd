from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cases import CLASHING, EDGE, FOLDER  # noqa: E402


@pytest.fixture
def edge(spark):
    extra = tuple([1] + ["clash"] * (CLASHING.count(",")))
    return spark.createDataFrame([(*r, *extra) for r in EDGE], "doc_id bigint, text string, " + CLASHING)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture
def given(spark):
    """A given table as a dictionary from its key to its text."""

    def read(name="documents", key="doc_id", text="text"):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet").select(key, text).collect()
        return {r[0]: r[1] for r in rows}

    return read


@pytest.fixture
def query(spark):
    from siltstone.llm.catalog import queries

    def run(name):
        return queries()[name](spark, FOLDER).collect()

    return run
