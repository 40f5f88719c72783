import duckdb
import pytest
from pyspark.sql import functions as F

from llm_frames import FOLDER, NAMES, ROWS
from tidemark.llm.common import prepared


@pytest.fixture(scope="session")
def ready(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def odd(ready):
    """Rows of every kind, with columns named like those the operators make."""
    rows = ready.createDataFrame(ROWS, "doc_id long, text string")
    rows = rows.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s")})
    return rows.withColumns({n: F.lit(n) for n in NAMES})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def docs(ready):
    return ready.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        connection.execute(f"create view {table} as from '{FOLDER}/{table}.parquet'")
    return connection
