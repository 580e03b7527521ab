from __future__ import annotations

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 0; a (doc_id, text) pair gives its own id."""

    def build(*texts, schema=DOCS):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def as_dicts():
    """The rows of a frame as dictionaries, by doc_id."""
    return lambda df: {row["doc_id"]: row.asDict() for row in df.collect()}
