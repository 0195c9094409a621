import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_edges import EDGES, SMALL  # noqa: E402




@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with the operators' own names."""
    clash = ["id", "sub", "fp", "ids", "score", "words", "key", "component_id", "start", "end", "rank", "_id", "_cut"]
    rows = [(i, t, "en" if k % 2 else None, *[None if k % 3 else "x"] * len(clash)) for k, (i, t) in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, " + ", ".join(f"{c} string" for c in clash))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
