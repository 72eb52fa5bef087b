import pytest
from pyspark.sql import functions as F

from folia.operators import catalog as C
from tests.conftest import rows


@pytest.fixture(scope="module")
def tables(spark):
    books = spark.createDataFrame(
        [(i, f"t{i}", f"i{i}", 2000 + i, 9.5, None if i == 2 else 1) for i in range(1, 7)],
        "book_id int, title string, isbn string, published_year int, price double, publisher_id int",
    )
    # 1: two authors, 2: two ids of one name, 3: none, 4: NULL name, 5: unknown author, 6: many
    book_author = spark.createDataFrame(
        [(1, 1), (1, 2), (2, 2), (2, 3), (4, 4), (5, 99)] + [(6, i) for i in range(1, 5)] * 10, "book_id int, author_id int"
    )
    authors = spark.createDataFrame(
        [(1, "A", "B"), (2, "C", "D"), (3, "C", "D"), (4, "E", None)], "author_id int, first_name string, last_name string"
    )
    inventory = spark.createDataFrame(
        [(1, 3), (1, 4), (2, 5), (4, None), (5, 2), (5, None), (6, 1), (77, 8)], "book_id int, quantity int"
    )
    return books, book_author, authors, inventory


def naive(books, book_author, authors, inventory):
    """The listing by loops over the rows."""
    books, book_author, authors, inventory = (x.collect() for x in (books, book_author, authors, inventory))
    out = {}
    for book in books:
        credits = [a.author_id for a in book_author if a.book_id == book.book_id] or [None]
        stocks = [i.quantity for i in inventory if i.book_id == book.book_id] or [None]
        for author_id in credits:
            names = [(a.first_name, a.last_name) for a in authors if a.author_id == author_id] or [(None, None)]
            for first, last in names:
                key = (*book, f"{first} {last}" if first is not None and last is not None else None)
                out[key] = out.get(key, 0) + sum(q or 0 for q in stocks)
    return sorted(((*k, v) for k, v in out.items()), key=repr)


def test_listing_means_the_four_way_left_join(tables):
    assert rows(C.catalog_listing(*tables)) == naive(*tables)


def test_an_entry_runs_no_job_before_it_is_asked_for(spark, tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "an entry")
    C.catalog_entry(*tables, 1)
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_listing_edge_cases(tables):
    got = {(r["book_id"], r["author"]): r["inventory"] for r in C.catalog_listing(*tables).collect()}
    assert got == {
        (1, "A B"): 7, (1, "C D"): 7, (2, "C D"): 10, (3, None): 0, (4, None): 0, (5, None): 2,
        (6, "A B"): 10, (6, "C D"): 20, (6, None): 10,
    }


def test_entry_takes_the_first_author_or_nothing(tables):
    assert [r["author"] for r in C.catalog_entry(*tables, 1).collect()] == ["A B"]
    assert C.catalog_entry(*tables, 40).collect() == []


def test_lookup_and_equality(tables):
    books = tables[0]
    assert C.point_lookup(books, "book_id", 2).first()["title"] == "t2"
    assert C.point_lookup(books, "book_id", 99).first() is None
    assert C.equals(books, publisher_id=None).count() == 0
    assert C.equals(books, publisher_id=1, published_year=2001).count() == 1


def test_counts_distinct_and_first_rows(tables):
    _, book_author, _, inventory = tables
    assert rows(C.value_counts(inventory, ["quantity"], "n").filter("quantity is null")) == [(None, 2)]
    assert C.distinct_rows(inventory, ["quantity"]).count() == 7
    assert [r["author_id"] for r in C.first_rows(book_author, 2, F.desc("author_id")).collect()] == [99, 4]


def test_json_leaves_nulls_out_unless_kept(tables):
    two = tables[0].filter("book_id = 2").select("book_id", "publisher_id")
    assert C.as_json(two).first()[0] == '{"book_id":2}'
    assert C.as_json(two, keep_nulls=True).first()[0] == '{"book_id":2,"publisher_id":null}'


def test_point_lookup_filter_reaches_the_scans(spark, tables, scratch):
    saved = []
    for i, t in enumerate(tables):
        t.write.parquet(f"{scratch}/{i}")
        saved.append(spark.read.parquet(f"{scratch}/{i}"))
    plan = C.catalog_entry(*saved, 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(book_id,40)") == 3
