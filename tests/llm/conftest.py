"""Small tables for the operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_rows import CLASHING, FOLDER, ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with clashing extra columns."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, df["source"])
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
