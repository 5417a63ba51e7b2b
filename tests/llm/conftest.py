"""Small document tables for the training-data operators."""

import pytest
from cases import CLASHING, DOCS, document_rows


@pytest.fixture(scope="session")
def doc_rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOCS)


@pytest.fixture(scope="session")
def wide_docs(spark, doc_rows):
    """The same rows with columns named like the operators' own."""
    extra = ("x",) * CLASHING.count(",")
    return spark.createDataFrame([(*r, *extra) for r in doc_rows], DOCS + CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
