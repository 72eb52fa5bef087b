"""Writers: document collections and nested JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folia.functions import row_to_json, sanitize


def write_documents(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    format: str = "parquet",
    partition_by: list[str] | None = None,
    **options,
) -> int:
    """Sanitizes and writes documents in one distributed write; returns how many.

    The number is counted while the rows are written, so neither other writers nor the
    format's own lines count, and nothing is computed again. "append" adds to a
    collection without a key check, so a repeated run duplicates documents.
    """
    seen = Observation()
    documents = sanitize(df).observe(seen, F.count(F.lit(1)).alias("n"))
    writer = documents.write.mode(mode).format(format).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get["n"]


def load_collection(
    df: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame] | None = None, **kwargs
) -> int:
    """Loads table rows as documents, after the caller's transform if there is one."""
    return write_documents(df if transform is None else df.transform(transform), path, **kwargs)


def json_lines(df: DataFrame, name: str = "value", keep_nulls: bool = False) -> DataFrame:
    """Each document as one line of JSON, cleaned up as for a document store."""
    clean = sanitize(df)
    return clean.select(row_to_json(*clean.columns, keep_nulls=keep_nulls).alias(name))


def write_json(df: DataFrame, path: str, *, mode: str = "errorifexists", keep_nulls: bool = False) -> int:
    """Exports documents as JSON lines; NULL fields are left out unless kept."""
    return write_documents(
        df, path, mode=mode, format="json", ignoreNullFields=str(not keep_nulls).lower()
    )
