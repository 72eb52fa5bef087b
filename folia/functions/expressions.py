"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name with a blank between; NULL when either is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def first_present(*columns: Column | str) -> Column:
    """The first value that is not NULL."""
    return F.coalesce(*[_col(c) for c in columns])


def bin_column(
    column: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    special: dict[Any, str] | None = None,
) -> Column:
    """Label of the right-closed bin that holds the value.

    `labels` has one entry more than `edges`. The last label takes everything
    above the last edge and also NULL. Values in `special` get a bin of their
    own, tested before the edges.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    if list(edges) != sorted(edges):
        raise ValueError("edges must ascend")
    value = _col(column)
    tests = [(value == v, label) for v, label in (special or {}).items()]
    tests += [(value <= edge, label) for edge, label in zip(edges, labels)]
    chain = F
    for test, label in tests:
        chain = chain.when(test, label)
    return chain.otherwise(labels[-1]) if tests else F.lit(labels[-1])


def document_id(collection: str, *key: Column | str) -> Column:
    """Id of a document, from its collection and business key.

    The same key gives the same id in every run; a NULL key part gives NULL.
    """
    parts = [_col(k).cast("string") for k in key]
    return F.sha2(F.concat(F.lit(collection), *[F.concat(F.lit("|"), p) for p in parts]), 256)


def hash_bucket(key: Column | str, buckets: int = 100, seed: str = "") -> Column:
    """Bucket 0..buckets-1 of a row key, the same however the data is laid out."""
    text = F.concat(F.lit(seed), _col(key).cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(buckets))


def row_to_json(*columns: Column | str, keep_nulls: bool = False) -> Column:
    """The columns as one JSON object. NULL fields are left out unless kept."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return F.to_json(F.struct(*[_col(c) for c in columns]), options)


def json_fields(body: Column | str, names: Sequence[str]) -> Column:
    """The named top-level fields of a JSON object, as one text column each.

    Other fields are ignored, an absent field is NULL, and numbers keep the
    text they were written with. A body that is no JSON object gives NULLs.
    This is a generator, to be used in `select`: the body is parsed once per
    row, and filters on the fields do not repeat the parsing.
    """
    return F.json_tuple(_col(body), *names).alias(*names)


def has_field(body: Column | str, name: str) -> Column:
    """Whether a JSON object has the field at all, be it with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(_col(body)), name), F.lit(False))


def parsed(body: Column | str) -> Column:
    """The body as a variant, NULL if it is no JSON; select it once for several `truthy_value`."""
    return F.try_parse_json(_col(body))


def truthy_value(variant: Column | str, name: str) -> Column:
    """Whether a parsed JSON object has a field that is neither null, false, zero nor empty; never NULL."""
    value = F.to_json(F.try_variant_get(_col(variant), f"$.{name}", "variant"))
    nothing = value.rlike(r'^(null|false|""|\[\]|\{\}|-?0+(\.0+)?([eE][+-]?[0-9]+)?)$')
    return F.coalesce(~nothing, F.lit(False))


def truthy_field(body: Column | str, name: str) -> Column:
    """`truthy_value` of a field in a body that is text."""
    return truthy_value(parsed(body), name)
