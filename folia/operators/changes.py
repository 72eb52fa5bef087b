"""A log of catalog changes applied as a batch.

A log row is `(seq, op, key, body)`: a unique number that gives the order, one
of insert/update/delete, the book the change is for (NULL for an insert), and
a JSON body. Changes take effect one after another by `seq`, each seeing all
earlier ones; the whole log is decided by aggregates and joins per key, without
going through it row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.functions import has_field, json_fields, parsed, truthy_value
from folia.operators.catalog import BOOK_COLUMNS
from folia.operators.spread import counted_hot_keys, lookup_join, place_by_range
from folia.session import written

# Operations, outcomes, and the fields an update may set.
INSERT, UPDATE, DELETE = "insert", "update", "delete"
INSERTED, APPLIED, INVALID, NOT_FOUND = "inserted", "applied", "invalid", "not_found"
UPDATABLE_FIELDS = ["quantity"]
REQUIRED_FIELDS = ["title", "isbn", "published_year", "price"]
OPTIONAL_FIELDS = ["publisher_id"]


@dataclass(frozen=True)
class Changed:
    """The new tables and what became of each change."""

    books: DataFrame
    inventory: DataFrame
    outcomes: DataFrame  # seq, op, key, outcome, new_id


def read_inserts(log: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Inserts with their fields in the types of the books table and `valid`.

    Required fields must be present and true in the sense of the JSON value: null, false,
    0, "" and empty lists or objects are not, any other text is, "0" too. A number in
    quotes counts as that number, a number or true in a text column as its text; what
    does not fit the type of its column is not valid.
    """
    names = REQUIRED_FIELDS + OPTIONAL_FIELDS
    raw = log.filter(F.col("op") == INSERT).select("seq", parsed("body").alias("_parsed"), json_fields("body", names))
    typed = raw.select("seq", "_parsed", *[F.col(n).try_cast(types[n]).alias(n) for n in names])
    valid = F.lit(True)
    for name in REQUIRED_FIELDS:
        valid = valid & F.col(name).isNotNull() & truthy_value("_parsed", name)
    return typed.withColumn("valid", valid).drop("_parsed")


def number_inserts(valid: DataFrame, high_water: int) -> DataFrame:
    """Adds `book_id`: ids above `high_water`, rising with `seq`, without gaps.

    Ids are not reused, so pass the highest id ever given, not the highest left.
    """
    placed = place_by_range(valid, "seq", "_place")
    return placed.withColumn("book_id", F.col("_place") + F.lit(high_water + 1)).drop("_place")


def read_updates(log: DataFrame, quantity_type: T.DataType) -> DataFrame:
    """Updates and deletes with `_value`, and `_valid` where an updatable field is set.

    Fields outside the whitelist are ignored. A present null is a valid value;
    text that does not fit the column is not.
    """
    field = UPDATABLE_FIELDS[0]
    keyed = log.filter(F.col("op").isin(UPDATE, DELETE))
    raw = keyed.select("seq", "op", "key", "body", json_fields("body", [field]))
    value = F.col(field).try_cast(quantity_type)
    # Only without a value does it matter whether the field is there at all.
    valid = F.when(F.col(field).isNull(), has_field("body", field)).otherwise(value.isNotNull())
    return raw.select("seq", "op", "key", valid.alias("_valid"), value.alias("_value"))


def existing(log: DataFrame, books: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Changes whose key is a book."""
    keys = books.select(F.col("book_id").alias("key"))
    return lookup_join(log, keys, ["key"], "left_semi", counted_hot_keys(log, ["key"], hot_rows))


def missing(log: DataFrame, books: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Changes whose key is no book."""
    keys = books.select(F.col("book_id").alias("key"))
    return lookup_join(log, keys, ["key"], "left_anti", counted_hot_keys(log, ["key"], hot_rows))


def delete_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among the distinct `keys` (same column name)."""
    return df.join(keys.select(key), key, "left_anti")


def apply_changes(
    books: DataFrame,
    inventory: DataFrame,
    log: DataFrame,
    high_water: int,
    *,
    hot_rows: int | None = None,
) -> Changed:
    """Applies the log and returns new tables and outcomes; inputs stay as they are.

    An update sets `quantity` on all inventory rows of its book and counts as
    applied when there is none. A delete removes the book only.

    A book's life is folded to three numbers: the change that made it (none for books there from
    the start), the first later delete, and the last update before that. Each is an aggregate
    that is combined before the shuffle; no change is looked at next to another. Only the
    inserts are written, as ids are given in the order of the whole log; all three results are
    lazy.
    """
    types = {f.name: f.dataType for f in books.schema}
    id_type = types["book_id"]

    # Bodies are parsed once; numbering reads its rows twice.
    inserts = written(read_inserts(log, types), "inserts")
    inserted = number_inserts(inserts.filter("valid").drop("valid"), high_water)
    inserted = written(inserted.withColumn("book_id", F.col("book_id").cast(id_type)), "inserted")
    born = inserted.select(F.col("book_id").alias("key"), F.col("seq").alias("_born"))

    # A key that cannot be an id is the key of no book.
    log = log.withColumn("key", F.col("key").try_cast(id_type))
    hot = counted_hot_keys(log.filter(F.col("op").isin(UPDATE, DELETE)), ["key"], hot_rows)
    there_yet = F.col("_born").isNull() | (F.col("_born") < F.col("seq"))
    # The first delete that can find its book ends it; whether there was one is asked later.
    deletes = lookup_join(log.filter(F.col("op") == DELETE).select("seq", "key"), born, ["key"], "left", hot)
    died = deletes.filter(there_yet & F.col("key").isNotNull()).groupBy("key").agg(F.min("seq").alias("_died"))

    new_books = books.select(*BOOK_COLUMNS).unionByName(inserted.select(*BOOK_COLUMNS))
    new_books = delete_keys(new_books, "book_id", died.select(F.col("key").alias("book_id")))

    alive = there_yet & (F.col("_died").isNull() | (F.col("seq") <= F.col("_died")))
    changes = read_updates(log, inventory.schema["quantity"].dataType)
    lived = lookup_join(lookup_join(changes, born, ["key"], "left", hot), died, ["key"], "left", hot)
    known = books.select(F.col("book_id").alias("key"), F.lit(True).alias("_known"))

    latest = (
        lived.filter((F.col("op") == UPDATE) & F.col("_valid") & alive & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max_by("_value", "seq").alias("_value"), F.max("_born").alias("_born"))
    )
    latest = latest.join(known, "key", "left").filter("_known OR _born IS NOT NULL")
    latest = latest.select(F.col("key").alias("book_id"), "_value", F.lit(True).alias("_hit"))
    # Stock rows are on the left of a left join, where Spark splits a hot book itself.
    updated = lookup_join(inventory, latest, ["book_id"], "left")
    quantity = F.when(F.col("_hit"), F.col("_value")).otherwise(F.col("quantity")).alias("quantity")
    new_inventory = updated.select(*[quantity if c == "quantity" else c for c in inventory.columns])

    found = (F.col("_known") | F.col("_born").isNotNull()) & alive
    outcome = (
        F.when(~F.coalesce(found, F.lit(False)), NOT_FOUND)
        .when((F.col("op") == UPDATE) & ~F.col("_valid"), INVALID)
        .otherwise(APPLIED)
    )
    no_key = F.lit(None).cast(id_type)
    decided = lookup_join(lived, known, ["key"], "left", hot).select(
        "seq", "op", "key", outcome.alias("outcome"), no_key.alias("new_id")
    )
    accepted = inserted.select(
        "seq", F.lit(INSERT).alias("op"), no_key.alias("key"), F.lit(INSERTED).alias("outcome"), F.col("book_id").alias("new_id")
    )
    rejected = inserts.filter(~F.col("valid")).select(
        "seq", F.lit(INSERT).alias("op"), no_key.alias("key"), F.lit(INVALID).alias("outcome"), no_key.alias("new_id")
    )
    known_ops = F.coalesce(F.col("op").isin(INSERT, UPDATE, DELETE), F.lit(False))
    unknown = log.filter(~known_ops).select("seq", "op", "key", F.lit(INVALID).alias("outcome"), no_key.alias("new_id"))
    outcomes = decided.unionByName(accepted).unionByName(rejected).unionByName(unknown)
    return Changed(new_books, new_inventory, outcomes)


def whitelist(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Only the allowed columns, in the table's order; unknown names are ignored."""
    return df.select(*[c for c in df.columns if c in set(allowed)])
