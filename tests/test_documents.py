import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.functions import document_id, sanitize
from folia.operators import documents as D
from folia.sources import write_json
from tests.conftest import rows


@pytest.fixture(scope="module")
def customers(spark):
    data = [(1, "a", 10), (2, "b", None), (3, "c", 99), (4, "d", 11)]
    return spark.createDataFrame(data, "customerNumber int, customerName string, rep int")


@pytest.fixture(scope="module")
def payments(spark):
    day = dt.date(2020, 1, 2)
    data = [(1, day, Decimal("5.10")), (2, day, Decimal("1.00")), (2, day, Decimal("1.00")), (2, None, None), (9, day, Decimal("7.00"))]
    return spark.createDataFrame(data, "customerNumber int, paymentDate date, amount decimal(10,2)")


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame([(10, "L", "F"), (11, None, None)], "employeeNumber int, lastName string, firstName string")


def test_embed_many_keeps_whole_rows_duplicates_and_empty_parents(customers, payments):
    docs = {r["customerNumber"]: r for r in D.embed_many(customers, payments, ["customerNumber"], "payments", part_size=100, total="n").collect()}
    assert set(docs) == {1, 2, 3, 4}
    assert [p["amount"] for p in docs[1]["payments"]] == [Decimal("5.10")]
    assert docs[1]["payments"][0]["customerNumber"] == 1
    assert [p["amount"] for p in docs[2]["payments"]] == [None, Decimal("1.00"), Decimal("1.00")]
    assert docs[3]["payments"] == [] and docs[3]["n"] == 0
    assert docs[2]["n"] == 3 and docs[2]["part"] == 0


def test_embed_many_in_parts_loses_nothing(spark, customers):
    data = [(1, i % 4) for i in range(23)] + [(2, 5)]
    children = spark.createDataFrame(data, "customerNumber int, v int")
    docs = D.embed_many(customers, children, ["customerNumber"], "items", total="n", part_size=5)
    got = docs.collect()
    assert sorted((r["customerNumber"], r["part"], len(r["items"]), r["n"]) for r in got) == [
        (1, 0, 5, 23), (1, 1, 5, 23), (1, 2, 5, 23), (1, 3, 5, 23), (1, 4, 3, 23), (2, 0, 1, 1), (3, 0, 0, 0), (4, 0, 0, 0),
    ]
    assert all(r["customerName"] == "a" for r in got if r["customerNumber"] == 1)
    back = docs.select(F.explode("items").alias("x")).select("x.*")
    assert rows(back) == rows(children)


def test_several_packs_do_not_multiply_even_in_parts(spark, customers):
    a = D.pack(spark.createDataFrame([(1, i) for i in range(7)], "customerNumber int, v int"), ["customerNumber"], "a", ["v"], part_size=3)
    b = D.pack(spark.createDataFrame([(1, 0), (2, 1)], "customerNumber int, v int"), ["customerNumber"], "b", ["v"], part_size=3)
    got = D.attach(customers, [a, b]).filter("customerNumber < 3").collect()
    assert sorted((r["customerNumber"], r["part"], len(r["a"]), len(r["b"])) for r in got) == [
        (1, 0, 3, 1), (1, 1, 3, 0), (1, 2, 1, 0), (2, 0, 0, 1)
    ]


def test_embed_many_with_many_oversized_keys_loses_nothing(spark, monkeypatch):
    """Arrays, part numbers and totals are those of few keys, and the join keeps the tasks of the rows."""
    from folia.operators import spread

    parents = spark.createDataFrame([(k,) for k in [*range(60), None]], "k int")
    children = spark.createDataFrame([(i % 50, i) for i in range(420)] + [(7, i) for i in range(200)] + [(None, 1)], "k int, v int")
    embedded = lambda: D.embed_many(parents, children, ["k"], "items", total="n", part_size=3)
    few = rows(embedded())
    for name, value in (("MAX_HOT_KEYS", 4), ("HOT_ROWS", 100), ("TASK_ROWS", 50)):
        monkeypatch.setattr(spread, name, value, raising=False)
    assert rows(embedded()) == few
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = embedded()
        assert rows(many) == few
        assert many.rdd.getNumPartitions() >= 620 // 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_embed_one_is_a_null_object_without_match(customers, employees):
    docs = {r["customerNumber"]: r["salesRep"] for r in D.embed_one(customers, employees, "rep", "employeeNumber", "salesRep", ["lastName", "firstName"]).collect()}
    assert docs[1].asDict() == {"lastName": "L", "firstName": "F"}
    assert docs[2] is None and docs[3] is None
    assert docs[4] is not None and docs[4]["lastName"] is None


def test_embed_one_with_a_hot_key_is_the_same(spark, employees):
    parents = spark.createDataFrame([(i, 10 if i < 40 else 11 + i % 2) for i in range(60)], "id int, rep int")
    plain = D.embed_one(parents, employees, "rep", "employeeNumber", "r", ["lastName"])
    split = D.embed_one(parents, employees, "rep", "employeeNumber", "r", ["lastName"], hot_rows=30)
    assert rows(plain) == rows(split)


@pytest.fixture(scope="module")
def visits(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 3), (2, 9), (4, 2)], "visit_id int, symptom_id int")
    dim = spark.createDataFrame([(1, "cough"), (2, None), (3, "cough"), (4, "rash")], "symptom_id int, note string")
    parents = spark.createDataFrame([(1,), (2,), (3,), (4,)], "visit_id int")
    return parents, bridge, dim


def test_distinct_children_as_scalars_keep_null(visits):
    parents, bridge, dim = visits
    packed = D.pack_distinct(bridge, dim, ["visit_id"], ["symptom_id"], "symptoms", ["note"], scalar=True, part_size=100)
    docs = {r["visit_id"]: r["symptoms"] for r in D.attach(parents, [packed]).collect()}
    assert docs == {1: [None, "cough"], 2: [], 3: [], 4: [None]}


def test_distinct_children_in_parts_are_the_same(spark, visits):
    parents, _, dim = visits
    bridge = spark.createDataFrame([(1, i % 4 + 1) for i in range(30)] + [(2, 1)], "visit_id int, symptom_id int")
    packed = D.pack_distinct(bridge, dim, ["visit_id"], ["symptom_id"], "items", ["symptom_id", "note"], part_size=3)
    docs = D.attach(parents, [packed])
    sizes = sorted((r["visit_id"], r["part"], len(r["items"])) for r in docs.collect())
    assert sizes == [(1, 0, 3), (1, 1, 1), (2, 0, 1), (3, 0, 0), (4, 0, 0)]
    back = docs.select("visit_id", F.explode("items").alias("x")).select("visit_id", "x.*")
    assert rows(back) == rows(D.distinct_children(bridge, dim, ["visit_id"], ["symptom_id"], ["symptom_id", "note"]))


def test_distinct_children_with_hot_dimension_keys(visits):
    _, bridge, dim = visits
    plain = D.distinct_children(bridge, dim, ["visit_id"], ["symptom_id"], ["note"])
    split = D.distinct_children(bridge, dim, ["visit_id"], ["symptom_id"], ["note"], hot_rows=1)
    assert rows(plain) == rows(split)


def test_all_when_present_refers_to_every_row_or_none(visits):
    parents, bridge, dim = visits
    docs = {r["visit_id"]: r["all_ref"] for r in D.refer_all_when_present(parents, bridge, ["visit_id"], "all").collect()}
    shared = D.shared_rows(dim, "all", ["note"]).collect()
    assert sorted((r["note"] or "" for r in shared)) == ["", "cough", "rash"]
    (ref,) = {r["_id"] for r in shared}
    assert docs == {1: ref, 2: ref, 3: None, 4: ref}


def test_sets_of_one_grouping(visits):
    parents, bridge, dim = visits
    children = bridge.join(dim.withColumn("there", F.lit(True)), "symptom_id", "left")
    arrays = {"notes": F.when(F.col("there"), F.struct("note")), "ids": F.struct("symptom_id")}
    docs = D.embed_sets(parents, children, ["visit_id"], arrays, part_size=10)
    got = {r["visit_id"]: ([x["note"] for x in r["notes"]], [x["symptom_id"] for x in r["ids"]]) for r in docs.collect()}
    assert got == {1: ([None, "cough"], [1, 2, 3]), 2: ([], [9]), 3: ([], []), 4: ([None], [2])}
    # Four rows, but three distinct items at most: no second part.
    assert D.embed_sets(parents, children, ["visit_id"], arrays, part_size=3).filter("part > 0").count() == 0


def test_sets_of_one_grouping_in_parts(spark):
    """A key of very many children stays within the bound, array by array; nothing is lost."""
    parents = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    data = [(1, i % 700, i % 3) for i in range(5000)] + [(2, 7, 7), (2, 7, 7), (None, 1, 1), (1, None, None)]
    children = spark.createDataFrame(data, "k int, a int, b int").repartition(5)
    arrays = {"a": F.when(F.col("a").isNotNull(), F.struct("a")), "b": F.col("b")}
    docs = D.embed_sets(parents, children, ["k"], arrays, part_size=100)
    got = docs.collect()
    assert sorted((r["k"] or 0, r["part"], len(r["a"]), len(r["b"])) for r in got) == [
        (0, 0, 0, 0), *[(1, p, 100, 0 if p else 3) for p in range(7)], (2, 0, 1, 1), (3, 0, 0, 0)
    ]
    assert sorted(x["a"] for r in got if r["k"] == 1 for x in r["a"]) == list(range(700))
    assert [r["b"] for r in got if r["k"] == 1 and r["part"] == 0] == [[0, 1, 2]]
    whole = D.embed_sets(parents, children, ["k"], arrays, part_size=10_000)
    assert sorted((r["k"] or 0, r["part"], len(r["a"]), len(r["b"])) for r in whole.collect()) == [(0, 0, 0, 0), (1, 0, 700, 3), (2, 0, 1, 1), (3, 0, 0, 0)]


def test_children_are_scanned_once_when_no_key_is_large(spark, scratch):
    path = f"{scratch}/children"
    spark.range(200).selectExpr("id % 50 AS k", "id AS v").write.parquet(path)
    docs = D.embed_many(spark.range(60).withColumnRenamed("id", "k"), spark.read.parquet(path), ["k"], "items", part_size=10, total="n")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert docs.filter("n = 4").count() == 50


def test_wide_children_are_split_by_bytes(spark, customers):
    children = spark.createDataFrame([(1, i, "x" * 1000) for i in range(20)] + [(2, 0, "y")], "customerNumber int, v int, t string")
    docs = D.embed_many(customers, children, ["customerNumber"], "items", ["v", "t"], part_size=1000, part_bytes=5000)
    sizes = [len(r["items"]) for r in docs.filter("customerNumber = 1").collect()]
    assert sum(sizes) == 20 and max(sizes) <= 6 and docs.filter("customerNumber = 2").count() == 1


def test_links_are_stable_and_absent_without_target(spark, customers, employees):
    docs = D.with_document_id(employees, "employees", ["employeeNumber"])
    linked = D.link(customers, employees, "employees", "rep", "employeeNumber", "rep_ref")
    ids = {r["employeeNumber"]: r["_id"] for r in docs.collect()}
    assert {r["customerNumber"]: r["rep_ref"] for r in linked.collect()} == {1: ids[10], 2: None, 3: None, 4: ids[11]}
    other = spark.range(1).select(document_id("a", F.lit("1")).alias("x"), document_id("a", F.lit(None)).alias("y")).first()
    assert other["x"] not in ids.values() and other["y"] is None


def test_histories_keep_parents_without_children(spark, customers):
    visits = spark.createDataFrame([(1, 7), (1, 8), (2, 9), (None, 1)], "ref int, visit int")
    got = {r["parent_info"]["customerNumber"]: (r["total_children"], [v["visit"] for v in r["history"]]) for r in D.histories(customers, visits, "customerNumber", "ref", part_size=100).collect()}
    assert got == {1: (2, [7, 8]), 2: (1, [9]), 3: (0, []), 4: (0, [])}
    split = D.histories(customers, visits, "customerNumber", "ref", part_size=1).collect()
    assert sorted((r["parent_info"]["customerNumber"], r["part"], r["total_children"]) for r in split) == [
        (1, 0, 2), (1, 1, 2), (2, 0, 1), (3, 0, 0), (4, 0, 0)
    ]
    sample = D.history_sample(customers, visits, "customerNumber", "ref", 2, part_size=100)
    assert sorted(r["parent_info"]["customerNumber"] for r in sample.collect()) == [1, 2]


def test_history_sample_is_exported_as_nested_json(spark, customers, payments, scratch):
    docs = D.history_sample(customers, payments, "customerNumber", "customerNumber", 2, total="total_payments", history="payments", part_size=100)
    assert write_json(docs, f"{scratch}/sample") == 2
    lines = sorted((json.loads(r[0]) for r in spark.read.text(f"{scratch}/sample").collect()), key=lambda x: x["parent_info"]["customerNumber"])
    assert [x["total_payments"] for x in lines] == [1, 3]
    assert lines[0]["parent_info"] == {"customerNumber": 1, "customerName": "a", "rep": 10}
    assert lines[0]["payments"] == [{"customerNumber": 1, "paymentDate": "2020-01-02T00:00:00.000", "amount": 5.1}]


def test_sanitize_reaches_into_objects_and_arrays(spark):
    df = spark.sql(
        "select cast(1.25 as decimal(10,2)) d, date'2020-01-02' day, named_struct('x', array(named_struct('m', cast(2.5 as decimal(5,1)), 'w', date'2020-01-03'))) s,"
        " 'text' t, timestamp_ntz'2020-01-01 10:00:00' ts, cast(null as date) missing"
    )
    clean = sanitize(df)
    assert [f.dataType.simpleString() for f in clean.schema] == [
        "double", "timestamp_ntz", "struct<x:array<struct<m:double,w:timestamp_ntz>>>", "string", "timestamp_ntz", "timestamp_ntz"
    ]
    r = clean.first()
    assert r["d"] == 1.25 and r["day"] == dt.datetime(2020, 1, 2)
    assert r["s"]["x"][0]["w"] == dt.datetime(2020, 1, 3) and r["ts"] == dt.datetime(2020, 1, 1, 10)
    assert r["missing"] is None
    assert isinstance(clean.schema["d"].dataType, T.DoubleType)


def test_row_hook_takes_frames_and_batches(customers):
    assert D.row_hook(customers, lambda df: df.limit(0)).count() == 0

    def shout(batches):
        for batch in batches:
            yield batch.assign(customerName=batch["customerName"].str.upper())

    assert {r["customerName"] for r in D.row_hook(customers, shout, customers.schema).collect()} == {"A", "B", "C", "D"}
