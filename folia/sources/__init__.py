from folia.sources.readers import jdbc_options, read_csv, read_documents, read_jdbc, read_table
from folia.sources.writers import json_lines, load_collection, write_documents, write_json

__all__ = [
    "jdbc_options",
    "json_lines",
    "load_collection",
    "read_csv",
    "read_documents",
    "read_jdbc",
    "read_table",
    "write_documents",
    "write_json",
]
