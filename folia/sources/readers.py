"""Readers: CSV, relational tables, document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folia.operators.catalog import equals


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header line. Types are inferred, which reads the files twice,
    unless a schema is given. Empty fields are NULL."""
    reader = spark.read.options(header=True, **options)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole table from parquet files."""
    return spark.read.parquet(path)


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Options of a JDBC scan of a table or of any query.

    A partitioned scan needs the column, its bounds and the number of
    partitions; then a query is wrapped as a derived table, since Spark takes
    a bare query for one connection only. Credentials come from the caller.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    split = [partition_column, bounds, partitions]
    if any(x is not None for x in split) and any(x is None for x in split):
        raise ValueError("a partitioned scan needs column, bounds and partitions")
    options = {"url": url, "fetchsize": str(fetch_size), **connection}
    if partition_column is None:
        options.update({"dbtable": table} if table else {"query": query})
        return options
    low, high = bounds
    options.update(
        dbtable=table or f"({query}) scanned",
        partitionColumn=partition_column,
        lowerBound=str(low),
        upperBound=str(high),
        numPartitions=str(partitions),
    )
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """A relational table or query over JDBC; see `jdbc_options`.

    Filters and column choice are pushed into the scan by Spark.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def read_documents(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    where: dict | None = None,
    limit: int | None = None,
) -> DataFrame:
    """A document collection with its nested fields, all of it, or those whose
    fields equal the given values, or any `limit` of them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    documents = equals(reader.format(format).load(path), **(where or {}))
    return documents if limit is None else documents.limit(limit)
