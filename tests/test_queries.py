import duckdb
import pytest

import __spark_entry__ as registry
from check_oracles import TABLES, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    found = registry.entry(spark)
    assert found.columns == ["doc_id", "tok", "value", "rank"] and found.count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    got = registry.queries()[name](spark, SF).toPandas()
    assert differences(got, db.sql(registry.oracle_sql()[name]).df()) == ""
