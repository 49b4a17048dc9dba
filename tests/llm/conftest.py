"""The awkward rows as tables."""
import pytest

from tests.llm.cases import CLASHING, DOC_SCHEMA, ROWS


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, DOC_SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def clashing(docs):
    """The same rows with more columns, named like those that the operators make."""
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
