import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection
