import json
import random

import pytest
from pyspark.sql import functions as F

from folia.operators import changes as C
from tests.conftest import rows

BOOKS = "book_id int, title string, isbn string, published_year int, price double, publisher_id int"


def book(i):
    return (i, f"t{i}", f"i{i}", 2000, 9.5, 1)


GOOD = {"title": "Leaves", "isbn": "123", "published_year": 1987, "price": 31.25, "publisher_id": 4}


@pytest.fixture(scope="module")
def tables(spark):
    books = spark.createDataFrame([book(i) for i in (15, 16, 17, 202)], BOOKS)
    inventory = spark.createDataFrame([(15, 1), (15, 2), (16, 3), (300, 4)], "book_id int, quantity int")
    return books, inventory


def run(spark, tables, log, high_water=202, **kwargs):
    text = [(s, op, key, b if b is None or isinstance(b, str) else json.dumps(b)) for s, op, key, b in log]
    df = spark.createDataFrame(text, "seq long, op string, key int, body string").repartition(3)
    return C.apply_changes(*tables, df, high_water, **kwargs)


def outcomes(result):
    return {r["seq"]: (r["outcome"], r["new_id"]) for r in result.outcomes.collect()}


def test_insert_validation(spark, tables):
    cases = [
        (GOOD, True),
        ({**GOOD, "price": 0}, False),
        ({**GOOD, "published_year": 0}, False),
        ({**GOOD, "title": ""}, False),
        ({**GOOD, "isbn": None}, False),
        ({k: v for k, v in GOOD.items() if k != "publisher_id"}, True),
        ({k: v for k, v in GOOD.items() if k != "title"}, False),
        ({**GOOD, "price": "12.5"}, True),
        ({**GOOD, "price": "cheap"}, False),
        ("not json", False),
        (None, False),
        ({**GOOD, "extra": 1}, True),
        ({**GOOD, "title": 0}, False),
        ({**GOOD, "title": False}, False),
        ({**GOOD, "isbn": []}, False),
        ({**GOOD, "price": "0"}, True),
        ({**GOOD, "title": 7}, True),
        ({**GOOD, "price": -0.0}, False),
    ]
    result = run(spark, tables, [(i, "insert", None, b) for i, (b, _) in enumerate(cases)])
    got = outcomes(result)
    ids = iter(range(203, 300))
    for i, (_, ok) in enumerate(cases):
        assert got[i] == (("inserted", next(ids)) if ok else ("invalid", None))
    new = {r["book_id"]: r for r in result.books.filter("book_id > 202").collect()}
    assert new[203]["price"] == 31.25 and new[204]["publisher_id"] is None and new[205]["price"] == 12.5


def test_updates_and_deletes(spark, tables):
    log = [
        (1, "update", 15, {"quantity": 50}),
        (2, "update", 15, {"title": "x"}),
        (3, "update", 99, {"title": "x"}),
        (4, "update", 17, {"quantity": 7}),
        (5, "delete", 202, None),
        (6, "update", 202, {"quantity": 1}),
        (7, "delete", 202, None),
        (8, "update", 16, {"quantity": 5, "title": "x"}),
        (9, "update", 16, {"quantity": None}),
        (10, "update", 16, {"quantity": "some"}),
        (11, "rename", 15, {}),
        (12, "update", None, {"quantity": 1}),
    ]
    result = run(spark, tables, log)
    assert {s: o for s, (o, _) in outcomes(result).items()} == {
        1: "applied", 2: "invalid", 3: "not_found", 4: "applied", 5: "applied", 6: "not_found", 7: "not_found",
        8: "applied", 9: "applied", 10: "invalid", 11: "invalid", 12: "not_found",
    }
    assert rows(result.inventory) == rows(
        spark.createDataFrame([(15, 50), (15, 50), (16, None), (300, 4)], "book_id int, quantity int")
    )
    assert sorted(r["book_id"] for r in result.books.collect()) == [15, 16, 17]


def test_changes_see_earlier_inserts_only(spark, tables):
    log = [
        (1, "update", 203, {"quantity": 1}),
        (2, "insert", None, GOOD),
        (3, "update", 203, {"quantity": 1}),
        (4, "delete", 203, None),
        (5, "insert", None, GOOD),
        (6, "update", 203, {"quantity": 1}),
    ]
    got = outcomes(run(spark, tables, log))
    assert [got[s][0] for s in range(1, 7)] == ["not_found", "inserted", "applied", "applied", "inserted", "not_found"]
    assert got[5][1] == 204


def replay(books, inventory, log, high_water):
    """The service, one request after another."""
    books, inventory, outcome = dict(books), [list(x) for x in inventory], {}
    for seq, op, key, body in sorted(log):
        if op == "insert":
            if all(body.get(f) for f in C.REQUIRED_FIELDS):
                high_water += 1
                books[high_water] = body["title"]
                outcome[seq] = "inserted", high_water
            else:
                outcome[seq] = "invalid", None
        elif key not in books:
            outcome[seq] = "not_found", None
        elif op == "delete":
            del books[key]
            outcome[seq] = "applied", None
        elif "quantity" not in body:
            outcome[seq] = "invalid", None
        else:
            for row in inventory:
                if row[0] == key:
                    row[1] = body["quantity"]
            outcome[seq] = "applied", None
    return books, inventory, outcome


@pytest.mark.parametrize("seed,hot_rows", [(1, None), (2, 40), (3, 1_000_000)])
def test_batch_equals_replay(spark, seed, hot_rows):
    rnd = random.Random(seed)
    books = {i: f"t{i}" for i in range(30)}
    inventory = [(rnd.randrange(40), rnd.randrange(9)) for _ in range(80)]
    log = []
    for seq in rnd.sample(range(5_000_000), 400):
        op = rnd.choice(["insert", "update", "update", "delete"])
        # One key has a third of all changes.
        key = None if op == "insert" else (7 if rnd.random() < 0.4 else rnd.randrange(110))
        body = {"title": rnd.choice(["a", "b", ""]), "isbn": "i", "published_year": rnd.choice([0, 1999]), "price": 1.5}
        if op == "update":
            body = rnd.choice([{"quantity": rnd.randrange(100)}, {"quantity": None}, {"title": "x"}])
        log.append((seq, op, key, None if op == "delete" else body))
    want_books, want_inventory, want = replay(books, inventory, log, 29)
    tables = (
        spark.createDataFrame([(i, t, "i", 2000, 1.0, 1) for i, t in books.items()], BOOKS),
        spark.createDataFrame(inventory, "book_id int, quantity int"),
    )
    result = run(spark, tables, log, 29, hot_rows=hot_rows)
    assert outcomes(result) == want
    assert {r["book_id"]: r["title"] for r in result.books.collect()} == want_books
    assert rows(result.inventory) == sorted((tuple(x) for x in want_inventory), key=repr)


def test_insert_ids_over_several_blocks(spark):
    seqs = [5, 1 << 20, (1 << 20) + 3, 7 << 20, 2]
    df = spark.createDataFrame([(s,) for s in seqs], "seq long")
    got = {r["seq"]: r["book_id"] for r in C.number_inserts(df, 100).collect()}
    assert got == {s: 101 + i for i, s in enumerate(sorted(seqs))}


def test_existing_missing_and_whitelist(spark, tables):
    log = spark.createDataFrame([(1, 15), (2, 99), (3, 15), (4, None)], "seq long, key int")
    assert [r["seq"] for r in C.existing(log, tables[0]).orderBy("seq").collect()] == [1, 3]
    assert [r["seq"] for r in C.missing(log, tables[0], hot_rows=1).orderBy("seq").collect()] == [2, 4]
    assert C.whitelist(tables[1], ["quantity", "nothing"]).columns == ["quantity"]
    assert C.whitelist(tables[1], ["nothing"]).columns == []


def test_sparse_numbers_are_placed_without_one_task(spark, capfd):
    df = spark.range(5000).select((F.col("id") * 10**9).alias("seq"))
    got = {r["seq"] // 10**9: r["book_id"] for r in C.number_inserts(df, 10).collect()}
    assert got == {i: 11 + i for i in range(5000)}
    assert "No Partition Defined" not in capfd.readouterr().err
