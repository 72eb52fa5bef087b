"""What several operators share: the documents' own columns, samples, folders."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from folia.session import new_path, written  # noqa: F401

_SHIPPED: set[str] = set()
BatchFunction = Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; others, whatever their names, stay behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_arrow(df: DataFrame, function: BatchFunction, schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(function, from_arrow_schema(schema))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(modulus: int, column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, keep: F.Column | None = None) -> DataFrame:
    """At most `limit` labelled documents (doc_id, text, label), those of the lowest
    hash of the id. The ids are bounded by `limit`, so their join is a broadcast."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).na.drop()
    if keep is not None:
        ids = ids.filter(keep)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return id_text(docs).join(F.broadcast(chosen), "doc_id")


def ship(spark: SparkSession) -> None:
    """Sends this library to the executors, once per application, as --py-files would.

    Batches for Python are kept to 16 MB, so that a worker holds little however long the
    texts are.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / "folia.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "folia").rglob("*.py")):
            z.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def located(docs: DataFrame, *columns: F.Column) -> DataFrame:
    """`columns` of the documents with the place of each row: file and row, both long.

    The place is that in the files the documents are read from, so it is the same in
    every scan. Documents that come from no files are written first.
    """
    place = (F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(*place, *columns)
    except AnalysisException:
        return written(docs.select(*columns), "located").select(*place, "*")
