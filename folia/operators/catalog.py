"""Catalog reads: listing with author and zero-filled stock, lookups, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions import first_present, full_name, row_to_json

# The columns of a book in a listing.
BOOK_COLUMNS = ["book_id", "title", "isbn", "published_year", "price", "publisher_id"]


def catalog_listing(
    books: DataFrame,
    book_author: DataFrame,
    authors: DataFrame,
    inventory: DataFrame,
) -> DataFrame:
    """One row per book and author name, with the stock summed over the book.

    The meaning is that of left-joining all four tables and grouping by book
    and author name, so a name that is on a book m times counts its stock m
    times, and a book without stock has 0. The many-to-many product is never
    formed: stock per book and name multiplicity are aggregated apart, with
    map-side combine, and multiplied.
    """
    credits, stocked = _credits(book_author, authors), _stocked(books, inventory)
    # Credits look up their book, so a book with very many is on a side that Spark can
    # split; books without credits are added.
    credited = credits.join(stocked, "book_id").unionByName(
        stocked.join(book_author.select("book_id").distinct(), "book_id", "left_anti"), allowMissingColumns=True
    )
    return _listed(credited)


def _credits(book_author: DataFrame, authors: DataFrame) -> DataFrame:
    """How often each author name is on each book."""
    names = authors.select("author_id", full_name("first_name", "last_name").alias("author"))
    named = book_author.select("book_id", "author_id").join(names, "author_id", "left")
    return named.groupBy("book_id", "author").agg(F.count(F.lit(1)).alias("_m"))


def _stocked(books: DataFrame, inventory: DataFrame) -> DataFrame:
    stock = inventory.groupBy("book_id").agg(F.sum("quantity").alias("_q"))
    return books.select(*BOOK_COLUMNS).join(stock, "book_id", "left")


def _listed(credited: DataFrame) -> DataFrame:
    total = F.col("_q") * first_present("_m", F.lit(1))
    return credited.select(
        *BOOK_COLUMNS, "author", first_present(total, F.lit(0).cast("long")).alias("inventory")
    )


def catalog_entry(
    books: DataFrame, book_author: DataFrame, authors: DataFrame, inventory: DataFrame, book_id
) -> DataFrame:
    """The listing row of one book, or no row. With several authors the first
    by name is taken. The key filter reaches all scans that have the key."""
    book, credited, stock = [equals(t, book_id=book_id) for t in (books, book_author, inventory)]
    rows = _listed(_stocked(book, stock).join(_credits(credited, authors), "book_id", "left"))
    return first_rows(rows, 1, F.col("author").asc_nulls_last())


def equals(df: DataFrame, **values) -> DataFrame:
    """Rows whose columns equal the given values; NULL equals nothing."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def point_lookup(df: DataFrame, key: str, value, *order: Column | str) -> DataFrame:
    """The row of a key, the first by `order` if there are several; none if unknown."""
    return first_rows(equals(df, **{key: value}), 1, *(order or [key]))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first `n` rows by `order`, without a full sort of the table."""
    return df.orderBy(*order).limit(n)


def as_json(df: DataFrame, name: str = "document", keep_nulls: bool = False) -> DataFrame:
    """Each row as one JSON object."""
    return df.select(row_to_json(*df.columns, keep_nulls=keep_nulls).alias(name))


def value_counts(df: DataFrame, columns: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per value; NULL counts as a value."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of the columns; NULL equals NULL."""
    return df.select(*columns).distinct()
