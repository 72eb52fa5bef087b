"""Nested documents from flat tables: embedded arrays, lookups and links.

Document stores bound the size of a document, and a task must hold the arrays it
builds. So whoever asks for arrays names a bound, `part_size` rows and if wanted
`part_bytes`, and a parent with more children is written as several documents that share
the parent's fields and are numbered by `part` from 0. No child is dropped. Every
result has the `part` column; it is 0 for all parents that fit. Those who want no
bound use the flat form (`bridged`, `distinct_children`, or the children themselves).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions import document_id
from folia.operators.spread import counted_hot_keys, key_counts, lookup_join, number_parts, oversized_keys


@dataclass(frozen=True)
class Pack:
    """Children gathered per parent key, ready to be attached to the parents."""

    rows: DataFrame  # keys, part, the array
    keys: tuple[str, ...]
    name: str
    total: str | None  # the column for the number of children over all parts
    counts: DataFrame  # keys and the number of children (_rows)
    parts: DataFrame | None  # keys that need several parts, and how many (_parts); None if there are none


def pack(
    children: DataFrame,
    keys: Sequence[str],
    name: str,
    fields: Sequence[str] | None = None,
    *,
    part_size: int,
    part_bytes: int | None = None,
    scalar: bool = False,
    distinct: bool = False,
    total: str | None = None,
) -> Pack:
    """Gathers children into one sorted array per key, or several for a key with many.

    `fields` defaults to the whole child row, keys included. With `scalar` the
    single field is kept bare instead of as an object; NULL items stay. With
    `distinct` equal items are kept once. `total` names a column for the number
    of children over all parts. Children are counted per key when this is called; unless a
    key has too many, the rest is one shuffle of one scan.
    """
    keys = list(keys)
    fields = list(fields or children.columns)
    if scalar and len(fields) != 1:
        raise ValueError("a scalar array takes exactly one field")
    # Keys are kept apart from the fields, which may hold the keys once more.
    inner = [f"_k{i}" for i in range(len(keys))]
    slim = children.select(*[F.col(k).alias(i) for k, i in zip(keys, inner)], F.struct(*fields).alias("_c"))
    slim = slim.na.drop(subset=inner)
    slim = slim.distinct() if distinct else slim
    back = dict(zip(inner, keys))
    numbered, parts = number_parts(slim, inner, part_size, part_bytes)
    # Objects, not bare values, are collected: collecting drops NULL values.
    items = F.sort_array(F.collect_list("_c"))
    if scalar:
        items = F.transform(items, lambda x: x[fields[0]])
    # Arrays only grow when combined before a shuffle, so rows are shuffled
    # bare, by `number_parts`; grouping and the join to the parents then stay in place.
    group = inner if parts is None else [*inner, "part"]
    rows = numbered.groupBy(*group).agg(items.alias(name))
    if parts is None:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        parts = parts.withColumnsRenamed(back)
    counts = key_counts(slim, inner, "_rows").withColumnsRenamed(back)
    return Pack(rows.withColumnsRenamed(back), tuple(keys), name, total, counts, parts)


def attach(parents: DataFrame, packs: Sequence[Pack]) -> DataFrame:
    """Left-joins packs that share one key to their parents; no child gives `[]`.

    Each pack has one row per key and part, so several packs never multiply.
    """
    keys = list(packs[0].keys)
    if any(list(p.keys) != keys for p in packs):
        raise ValueError("packs must share the parent key")
    several = [p.parts.select(*keys, "_parts") for p in packs if p.parts is not None]
    docs, on = parents, keys
    if several:
        # The numbers are joined while there are neither parts nor arrays.
        for p in packs:
            if p.total:
                docs = docs.join(p.counts, keys, "left").withColumnRenamed("_rows", f"_rows_{p.name}")
        docs, on = in_parts(docs, keys, several), [*keys, "part"]
    names = []
    for p in packs:
        rows = p.rows if several else p.rows.drop("part")
        item_type = rows.schema[p.name].dataType
        docs = docs.join(rows, on, "left").withColumn(p.name, F.coalesce(p.name, F.array().cast(item_type)))
        names.append(p.name)
        if p.total:
            # With one part each, the array is all there is.
            docs = docs.withColumn(p.total, F.coalesce(f"_rows_{p.name}", F.lit(0)).cast("long") if several else F.size(p.name).cast("long"))
            names.append(p.total)
    if not several:
        docs = docs.withColumn("part", F.lit(0).cast("long"))
    return docs.select(*parents.columns, "part", *names)


def in_parts(parents: DataFrame, keys: Sequence[str], several: Sequence[DataFrame]) -> DataFrame:
    """The parents once per `part`, as many as the most that any of `several` (keys, _parts) asks for."""
    most = reduce(DataFrame.unionByName, several).groupBy(*keys).agg(F.max("_parts").alias("_parts"))
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    docs = parents.join(most, list(keys), "left")
    own = [c for c in parents.columns if c != "part"]
    return docs.select(*own, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))


def embed_sets(parents: DataFrame, children: DataFrame, keys: Sequence[str], arrays: dict[str, Column], *, part_size: int) -> DataFrame:
    """Several arrays of distinct items from one table of children, in one grouping.

    Each array is given as the item of a child row, NULL where the row has none for it. No
    array has more than `part_size` items. A parent with no more child rows than that, which
    are counted when this is called, has its sets combined before the shuffle. The items
    of all others are made distinct as rows, numbered into parts array by array, and
    the parts with one number gathered in one grouping.
    """
    keys = list(keys)
    names = list(arrays)
    over = oversized_keys(children, keys, None, part_size)
    few = children if over is None else children.join(over.select(*keys), keys, "left_anti")
    sets = few.na.drop(subset=keys).groupBy(*keys).agg(*[F.sort_array(F.collect_set(arrays[n])).alias(n) for n in names])
    types = {n: sets.schema[n].dataType for n in names}
    docs, on = parents, keys
    if over is not None:
        many = children.join(over.select(*keys), keys)
        # One row per item: which array it is for, and the item in the field of that array.
        one = [F.struct(F.lit(i).alias("_which"), *[(item if i == j else F.lit(None).cast(types[n].elementType)).alias(n) for j, (n, item) in enumerate(arrays.items())]) for i in range(len(names))]
        items = many.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.explode(F.array(*one)).alias("_i"))
        present = reduce(Column.__or__, [F.col("_i")[n].isNotNull() for n in names])
        inner = [f"_k{i}" for i in range(len(keys))]
        distinct = items.filter(present).select(*inner, F.col("_i._which").alias("_which"), F.col("_i").alias("_item")).distinct()
        numbered, parts = number_parts(distinct, [*inner, "_which"], part_size, gather=inner)
        own = lambda i, n: F.when(F.col("_which") == i, F.col("_item")[n])
        gathered = numbered.groupBy(*inner, "part").agg(*[F.sort_array(F.collect_list(own(i, n))).alias(n) for i, n in enumerate(names)])
        back = dict(zip(inner, keys))
        sets = sets.withColumn("part", F.lit(0).cast("long")).unionByName(gathered.withColumnsRenamed(back))
        several = [] if parts is None else [parts.withColumnsRenamed(back).select(*keys, "_parts")]
        docs, on = (in_parts(parents, keys, several), [*keys, "part"]) if several else (parents, keys)
        sets = sets if several else sets.drop("part")
    docs = docs.join(sets, on, "left")
    if "part" not in docs.columns:
        docs = docs.withColumn("part", F.lit(0).cast("long"))
    empty = {n: F.coalesce(n, F.array().cast(types[n])) for n in names}
    return docs.select(*parents.columns, "part", *[c.alias(n) for n, c in empty.items()])


def embed_many(
    parents: DataFrame,
    children: DataFrame,
    keys: Sequence[str],
    name: str,
    fields: Sequence[str] | None = None,
    *,
    part_size: int,
    part_bytes: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """All child rows with the parent's key as an array of objects on the parent.

    The key has the same column name(s) on both sides.
    """
    return attach(parents, [pack(children, keys, name, fields, total=total, part_size=part_size, part_bytes=part_bytes)])


def bridged(
    bridge: DataFrame,
    dim: DataFrame,
    parent_keys: Sequence[str],
    dim_keys: Sequence[str],
    fields: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Dimension fields per parent, reached through a bridge table.

    The dimension is unique by `dim_keys`. Bridge rows without a dimension row
    vanish.
    """
    wanted = dim.select(*dim_keys, *[f for f in fields if f not in dim_keys])
    pairs = bridge.select(*parent_keys, *dim_keys)
    joined = lookup_join(pairs, wanted, dim_keys, "inner", counted_hot_keys(bridge, dim_keys, hot_rows))
    return joined.select(*parent_keys, *fields)


def distinct_children(
    bridge: DataFrame,
    dim: DataFrame,
    parent_keys: Sequence[str],
    dim_keys: Sequence[str],
    fields: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Distinct dimension fields per parent as flat rows."""
    return bridged(bridge, dim, parent_keys, dim_keys, fields, hot_rows).distinct()


def pack_distinct(
    bridge: DataFrame,
    dim: DataFrame,
    parent_keys: Sequence[str],
    dim_keys: Sequence[str],
    name: str,
    fields: Sequence[str],
    *,
    part_size: int,
    part_bytes: int | None = None,
    scalar: bool = False,
) -> Pack:
    """Distinct dimension fields per parent, as an array.

    Repeated bridge rows are dropped, with map-side combine, before the join and
    before the children of a parent are counted.
    """
    pairs = bridge.select(*dict.fromkeys([*parent_keys, *dim_keys])).distinct()
    children = bridged(pairs, dim, parent_keys, dim_keys, fields)
    return pack(children, parent_keys, name, fields, scalar=scalar, distinct=True, part_size=part_size, part_bytes=part_bytes)


def all_rows_id(name: str) -> Column:
    """The id under which the rows of a shared dimension are written."""
    return F.sha2(F.lit(f"{name}|all"), 256)


def shared_rows(dim: DataFrame, name: str, fields: Sequence[str]) -> DataFrame:
    """The distinct rows of a dimension as a collection of their own, under one id."""
    return dim.select(all_rows_id(name).alias("_id"), *fields).distinct()


def refer_all_when_present(parents: DataFrame, bridge: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Links each parent that has any bridge row to all rows of a dimension.

    This is what a join without a join condition computes when it is filtered to one
    parent: every row, or none. The rows are the same for all parents, so they are
    written once (`shared_rows`) and parents carry their id, NULL when there is no bridge
    row. Use `pack_distinct` for the keyed form.
    """
    present = bridge.select(*keys).na.drop().distinct().withColumn("_present", F.lit(True))
    ref = F.when(F.col("_present"), all_rows_id(name)).alias(f"{name}_ref")
    return parents.join(present, list(keys), "left").select(*parents.columns, ref)


def embed_one(
    parents: DataFrame,
    lookup: DataFrame,
    parent_key: str,
    lookup_key: str,
    name: str,
    fields: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """The matching lookup row as an object; NULL when there is none.

    Should the lookup hold a key twice, the lowest row by `fields` is taken.
    Embed lookups and links before arrays, while the parents are still a plain table.
    """
    found = (
        lookup.filter(F.col(lookup_key).isNotNull())
        .groupBy(F.col(lookup_key).alias(parent_key))
        .agg(F.min(F.struct(*fields)).alias(name))
    )
    joined = lookup_join(parents, found, [parent_key], "left", counted_hot_keys(parents, [parent_key], hot_rows))
    return joined.select(*parents.columns, name)


def with_document_id(df: DataFrame, collection: str, keys: Sequence[str], name: str = "_id") -> DataFrame:
    """`df` with the id that links from other documents will carry."""
    return df.select(document_id(collection, *keys).alias(name), *df.columns)


def link(
    parents: DataFrame,
    targets: DataFrame,
    collection: str,
    parent_key: str,
    target_key: str,
    name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """The id of the referenced document, NULL when that document is missing.

    Ids follow from the key, so only the existence of the target is looked up
    and collections can be written in any order.
    """
    marker = f"_{name}_found"
    known = (
        targets.select(F.col(target_key).alias(parent_key))
        .na.drop()
        .distinct()
        .withColumn(marker, F.lit(True))
    )
    joined = lookup_join(parents, known, [parent_key], "left", counted_hot_keys(parents, [parent_key], hot_rows))
    return joined.withColumn(name, F.when(F.col(marker), document_id(collection, parent_key))).select(
        *parents.columns, name
    )


def histories(
    parents: DataFrame,
    children: DataFrame,
    parent_ref: str,
    child_ref: str,
    *,
    info: str = "parent_info",
    total: str = "total_children",
    history: str = "history",
    part_size: int,
    part_bytes: int | None = None,
) -> DataFrame:
    """Each parent with the documents that refer to it and their number.

    A parent that nothing refers to stays, with 0 and `[]`. `total` counts
    over all parts of a parent.
    """
    keyed = parents.select(F.col(parent_ref).alias("_ref"), F.struct(*parents.columns).alias(info))
    referring = children.select(F.col(child_ref).alias("_ref"), F.struct(*children.columns).alias("_doc"))
    packed = pack(referring, ["_ref"], history, ["_doc"], scalar=True, total=total, part_size=part_size, part_bytes=part_bytes)
    return attach(keyed, [packed]).select(info, "part", total, history)


def history_sample(
    parents: DataFrame,
    children: DataFrame,
    parent_ref: str,
    child_ref: str,
    n: int = 3,
    order: Sequence[Column | str] | None = None,
    **names,
) -> DataFrame:
    """Histories of the first `n` parents by `order` (the reference key if not given).

    The children of other parents are dropped before anything is grouped.
    """
    chosen = parents.orderBy(*(order or [parent_ref])).limit(n)
    wanted = chosen.select(F.col(parent_ref).alias(child_ref)).distinct()
    relevant = children.join(wanted, [child_ref], "left_semi")
    return histories(chosen, relevant, parent_ref, child_ref, **names)


def row_hook(df: DataFrame, fn: Callable, schema=None) -> DataFrame:
    """Applies a caller's hook: DataFrame to DataFrame, or, when a `schema` is
    given, an iterator of pandas batches to an iterator of pandas batches."""
    return df.transform(fn) if schema is None else df.mapInPandas(fn, schema)
