from folia.functions.expressions import (
    bin_column,
    document_id,
    first_present,
    full_name,
    has_field,
    hash_bucket,
    json_fields,
    parsed,
    row_to_json,
    truthy_field,
    truthy_value,
)
from folia.functions.sanitize import document_schema, sanitize

__all__ = [
    "bin_column",
    "document_id",
    "document_schema",
    "first_present",
    "full_name",
    "has_field",
    "hash_bucket",
    "json_fields",
    "parsed",
    "row_to_json",
    "sanitize",
    "truthy_field",
    "truthy_value",
]
