"""Type clean-up for document stores: decimals to doubles, dates to timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def document_schema(data_type: T.DataType) -> T.DataType:
    """The type a document store takes, at any depth of structs and arrays."""
    if isinstance(data_type, T.DecimalType):
        return T.DoubleType()
    if isinstance(data_type, T.DateType):
        return T.TimestampNTZType()
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(document_schema(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, document_schema(f.dataType), f.nullable) for f in data_type]
        )
    return data_type


def sanitize(df: DataFrame) -> DataFrame:
    """`df` with every decimal and date replaced, one cast per column that has any."""
    columns = []
    for field in df.schema:
        target = document_schema(field.dataType)
        column = F.col(f"`{field.name}`")
        columns.append(column if target == field.dataType else column.cast(target).alias(field.name))
    return df.select(*columns)
