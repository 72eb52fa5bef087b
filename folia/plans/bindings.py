"""The given tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import bin_column, json_fields
from folia.operators.changes import DELETE, INSERT, UPDATE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as books, their lines as credits and stock, suppliers as authors.

    Suppliers share nation and region names, so author names collide; one
    region has no name and open lines have no quantity.
    """
    lines = table(spark, sf_dir, "lineitem")
    books = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("book_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("isbn"),
        F.year("o_orderdate").alias("published_year"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("publisher_id"),
    )
    book_author = lines.select(F.col("l_orderkey").alias("book_id"), F.col("l_suppkey").alias("author_id"))
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    authors = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("author_id"),
            F.col("n_name").alias("first_name"),
            F.nullif(F.col("r_name"), F.lit("MIDDLE EAST")).alias("last_name"),
        )
    )
    inventory = lines.select(
        F.col("l_orderkey").alias("book_id"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).cast("int").alias("quantity"),
    )
    return books, book_author, authors, inventory


def change_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Suppliers as books, lines as their stock, events as the change log.

    Users are the keys of the changes. There are more users than suppliers, so
    a change can be for a book that an earlier insert brought in, or for none.
    """
    suppliers = table(spark, sf_dir, "supplier")
    books = suppliers.select(
        F.col("s_suppkey").alias("book_id"),
        F.col("s_name").alias("title"),
        F.lit("none").alias("isbn"),
        F.lit(2000).alias("published_year"),
        F.col("s_acctbal").alias("price"),
        F.col("s_nationkey").alias("publisher_id"),
    )
    inventory = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("book_id"), F.col("l_quantity").cast("int").alias("quantity")
    )
    k = F.col("k").cast("int")
    event = F.col("event_id").cast("string")
    # Some bodies lack a field or hold an empty, zero, false or null one, or a zero in quotes.
    insert_body = F.concat(
        F.lit('{"title": '),
        F.when(k == 0, '""').when(k == 60, "false").when(k == 63, "0").otherwise(F.concat(F.lit('"Book '), event, F.lit('"'))),
        F.when(k == 20, "").when(k == 61, ', "isbn": []').otherwise(F.concat(F.lit(', "isbn": "'), event, F.lit('"'))),
        F.lit(', "published_year": '),
        F.when(k == 30, "null").otherwise((k + 1990).cast("string")),
        F.lit(', "price": '),
        F.when(k == 10, "0").when(k == 62, '"0"').otherwise(F.col("value").cast("string")),
        F.when(k == 40, "").otherwise(F.concat(F.lit(', "publisher_id": '), k.cast("string"))),
        F.lit("}"),
    )
    update_body = (
        F.when(k < 10, '{"title": "only"}')
        .when(k == 50, '{"quantity": null}')
        .when(k == 70, '{"quantity": "many"}')
        .otherwise(F.concat(F.lit('{"title": "too", "quantity": '), k.cast("string"), F.lit("}")))
    )
    op = (
        F.when(F.col("event_type").isin("signup", "purchase"), INSERT)
        .when(F.col("event_type") == "error", DELETE)
        .otherwise(UPDATE)
    )
    events = table(spark, sf_dir, "events").select("*", json_fields("props", ["k"]))
    log = events.select(
        F.col("event_id").alias("seq"),
        op.alias("op"),
        F.when(op != INSERT, F.col("user_id")).alias("key"),
        F.when(op == INSERT, insert_body).when(op == UPDATE, update_body).alias("body"),
    )
    high_water = suppliers.agg(F.max("s_suppkey")).first()[0]
    return books, inventory, log, high_water


# Cut points of the text length bins.
LENGTH_EDGES = [500, 2000, 8000]
LENGTH_LABELS = ["Short", "Medium", "Long", "Very Long"]


def labelled(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    """Documents with their labels; a left join leaves NULL where there is none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", how)
    return joined.withColumn("length_bin", bin_column("n_chars", LENGTH_EDGES, LENGTH_LABELS))
