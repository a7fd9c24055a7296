"""Every registered query against its SQL in DuckDB on the smallest tables; the rest must run with a fixed schema."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as driver  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_equals_sql(spark, db, name):
    found = driver.queries()[name](spark, SF)
    result = db.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical([tuple(r) for r in found.collect()], found.columns) == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_runs_with_a_fixed_schema(spark, name):
    found = driver.queries()[name](spark, SF)
    assert found.count() > 0 and len(set(found.columns)) == len(found.columns)
    assert all(f.dataType.simpleString() != "void" for f in found.schema)


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["state", "action", "policy"] and rows.count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
