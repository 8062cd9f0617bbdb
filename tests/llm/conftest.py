import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import SCHEMA, SF  # noqa: E402


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """Documents as a stored table: ``make_docs([(doc_id, text, ...)], columns)``."""

    def make(rows, schema=SCHEMA):
        width = len(schema.fields)
        rows = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
