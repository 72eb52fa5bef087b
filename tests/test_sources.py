import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folia import session
from folia.sources import (
    jdbc_options,
    json_lines,
    load_collection,
    read_csv,
    read_documents,
    read_table,
    write_documents,
    write_json,
)
from tests.conftest import rows

CSV = "Loan_ID,Dependents,Amount,Income,Rate\nL1,3+,,5.5,1\nL2,0,7,,2\nL3,,9,6,\n"


@pytest.fixture
def documents(spark):
    data = [(1, "a", Decimal("1.50"), dt.date(2020, 1, 2), [(1, Decimal("2.00"))]), (2, None, None, None, [])]
    return spark.createDataFrame(data, "id int, name string, price decimal(10,2), day date, items array<struct<n:int,m:decimal(5,2)>>")


def test_csv_types_are_inferred_or_given(spark, scratch):
    path = Path(scratch) / "loans.csv"
    path.write_text(CSV)
    df = read_csv(spark, str(path))
    assert dict(df.dtypes) == {"Loan_ID": "string", "Dependents": "string", "Amount": "int", "Income": "double", "Rate": "int"}
    assert df.filter("Loan_ID = 'L1'").first()["Amount"] is None
    assert df.filter("Loan_ID = 'L3'").first()["Dependents"] is None
    given = read_csv(spark, str(path), "Loan_ID string, Dependents string, Amount long, Income double, Rate long")
    assert dict(given.dtypes)["Amount"] == "bigint"
    assert rows(given) == rows(df)


def test_jdbc_options():
    url = "jdbc:mysql://db/orders"
    assert jdbc_options(url, table="t", user="u") == {"url": url, "fetchsize": "10000", "user": "u", "dbtable": "t"}
    assert jdbc_options(url, query="select 1")["query"] == "select 1"
    split = jdbc_options(url, query="select * from t", partition_column="id", bounds=(1, 9), partitions=4)
    assert split["dbtable"] == "(select * from t) scanned" and "query" not in split
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "9", "4")
    with pytest.raises(ValueError):
        jdbc_options(url)
    with pytest.raises(ValueError):
        jdbc_options(url, table="t", partition_column="id")


def test_documents_round_trip(spark, documents, scratch):
    path = f"{scratch}/docs"
    assert write_documents(documents, path) == 2
    back = read_documents(spark, path)
    assert dict(back.dtypes)["items"] == "array<struct<n:int,m:double>>"
    assert rows(read_table(spark, path)) == rows(back)
    first = read_documents(spark, path, where={"id": 1}).collect()
    assert len(first) == 1 and first[0]["items"][0]["m"] == 2.0 and first[0]["day"] == dt.datetime(2020, 1, 2)
    assert read_documents(spark, path, where={"name": None}).count() == 0
    assert read_documents(spark, path, limit=1).count() == 1


def test_loading_again_fails_or_duplicates(spark, documents, scratch):
    path = f"{scratch}/docs"
    assert load_collection(documents, path, lambda df: df.withColumn("x", F.lit(1)), mode="append") == 2
    assert load_collection(documents, path, lambda df: df.withColumn("x", F.lit(1)), mode="append") == 2
    assert read_documents(spark, path).count() == 4
    with pytest.raises(Exception, match="exist"):
        load_collection(documents, path)
    assert load_collection(documents.limit(0), f"{scratch}/none") == 0
    assert read_documents(spark, f"{scratch}/none").count() == 0


def test_json_export(spark, documents, scratch):
    lines = {r[0] for r in json_lines(documents).collect()}
    assert '{"id":2,"items":[]}' in lines
    assert any('"items":[{"n":1,"m":2.0}]' in line for line in lines)
    kept = {r[0] for r in json_lines(documents, keep_nulls=True).collect()}
    assert '{"id":2,"name":null,"price":null,"day":null,"items":[]}' in kept
    path = f"{scratch}/json"
    assert write_json(documents, path, keep_nulls=True) == 2
    assert any("null" in r[0] for r in spark.read.text(path).collect())
    back = read_documents(spark, path, format="json", schema="id int, items array<struct<n:int,m:double>>")
    assert back.filter("id = 1").first()["items"][0]["m"] == 2.0


def test_partitioned_write_prunes(spark, documents, scratch):
    path = f"{scratch}/parts"
    write_documents(documents, path, partition_by=["id"])
    plan = read_documents(spark, path, where={"id": 1})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.new_path(spark, "x") != session.new_path(spark, "x")
    assert session.durable(spark.range(5)).count() == 5


def unset_session(master):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        applicationId = "app-1"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    Session.sparkContext.master = master
    return Session()


def test_a_local_folder_only_in_local_mode():
    with pytest.raises(ValueError):
        session.shared_dir(unset_session("yarn"))
    folder = session.shared_dir(unset_session("local[2]"))
    assert Path(folder).is_dir() and session.shared_dir(unset_session("local[2]")) == folder
