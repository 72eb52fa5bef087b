"""The entry points, and every query against its SQL on the smallest tables."""

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
NO_SQL = {"model_scores", "best_model", "logistic_coefficients", "tree_predictions"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def test_every_query_has_sql_unless_it_trains_a_model():
    own = {name for name in contract.queries() if not (name.startswith("op") and name[2].isdigit()) and name != "pipeline"}
    assert own - set(contract.oracle_sql()) == NO_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, sql, name):
    df = contract.queries()[name](spark, str(DATA))
    cursor = sql.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_models_give_rows(spark, name):
    assert contract.queries()[name](spark, str(DATA)).count() > 0
