"""Joins and numberings that hold when one key has a large share of all rows.

Rows per key are counted first, on the table as read and not on anything
derived from it. The count is a column-pruned aggregate with map-side combine,
so a hot key costs one row per map task, and it is skipped when the whole table
has fewer rows than a hot key would. When no key is hot, which is the usual
case, the plain Spark operation is used unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from folia.session import durable, written

# A key with more rows than this is kept out of single-task joins.
HOT_ROWS = 1_000_000
# A list of hot keys is broadcast only up to this many keys.
MAX_HOT_KEYS = 100_000
# Rows for a task to sort or gather, where the number of tasks is named.
TASK_ROWS = 250_000


def key_counts(df: DataFrame, keys: Sequence[str], count: str = "_n") -> DataFrame:
    """Rows per key; rows with a NULL in the key are left out, as they join nothing."""
    present = df.select(*keys).na.drop()
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than `hot_rows` rows, or None when there is none.

    NULL is listed like any key: it joins nothing, but a shuffle would send
    all its rows to one task. The result is safe to broadcast: should more
    than MAX_HOT_KEYS qualify, the threshold is doubled until they fit.
    """
    if df.count() <= hot_rows:
        return None
    threshold = hot_rows
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.filter(F.col("_n") > threshold)
    size = found.count()
    if size == 0:
        return None
    found = durable(found)
    while size > MAX_HOT_KEYS:
        threshold *= 2
        found = found.filter(F.col("_n") > threshold)
        size = found.count()
    return found.select(*keys) if size else None


def counted_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame | None:
    """`hot_keys` if a limit is named, else None without counting: where a skewed side is the
    left of a join, Spark splits it at run time, unless the join feeds a grouping by its key."""
    return None if hot_rows is None else hot_keys(df, keys, hot_rows)


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join to a lookup that is unique by `keys` (inner, left, left_semi, left_anti).

    `hot` are the keys, found by `hot_keys`, that many left rows have. Whether
    a small lookup is broadcast is left to Spark, which checks its size. For a
    large one, rows of hot keys stay where they are and meet a broadcast of
    only the hot lookup rows, at most one per hot key; rows without a key
    match nothing and pass by the join; all other rows are shuffled. The
    pieces together are the whole join.
    """
    keys = list(keys)
    if hot is None:
        return left.join(lookup, keys, how)
    keyed = left.na.drop(subset=keys)
    hot_side = keyed.join(F.broadcast(hot), keys, "left_semi")
    hot_lookup = lookup.join(F.broadcast(hot), keys, "left_semi")
    cold_side = keyed.join(F.broadcast(hot), keys, "left_anti")
    joined = hot_side.join(F.broadcast(hot_lookup), keys, how).unionByName(
        cold_side.join(lookup, keys, how)
    )
    if how in ("left", "left_anti"):
        has_key = F.lit(True)
        for key in keys:
            has_key = has_key & F.col(key).isNotNull()
        joined = joined.unionByName(left.filter(~has_key), allowMissingColumns=True)
    return joined


def fan_out_join(
    parents: DataFrame, children: DataFrame, keys: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """Left join from parents, unique by `keys`, to any number of children.

    A left join cannot split a hot key on its right side. So with hot keys the
    children look up their parent, and childless parents are added.
    """
    keys = list(keys)
    if hot is None:
        return parents.join(children, keys, "left")
    matched = lookup_join(children, parents, keys, "inner", hot)
    childless = parents.join(key_counts(children, keys).select(*keys), keys, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def running_start(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    weight: Column,
    name: str = "start",
) -> DataFrame:
    """Adds the exact sum of `weight` over all earlier rows of the same key.

    Rows are ordered by (`bucket`, `order`) within `keys`. A task sorts one
    bucket at a time; the totals of earlier buckets come in as an offset, so
    no key and no whole table has to fit one task.
    """
    group = [*keys, bucket]
    before = (Window.unboundedPreceding, -1)
    weighted = df.withColumn("_w", weight)
    totals = weighted.groupBy(*group).agg(F.sum("_w").alias("_total"))
    by_bucket = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*before)
    offsets = totals.select(*group, F.coalesce(F.sum("_total").over(by_bucket), F.lit(0)).alias("_offset"))
    in_bucket = Window.partitionBy(*group).orderBy(*order).rowsBetween(*before)
    inside = F.coalesce(F.sum("_w").over(in_bucket), F.lit(0))
    return (
        weighted.join(offsets, group)
        .withColumn(name, (F.col("_offset") + inside).cast("long"))
        .drop("_w", "_offset")
    )


def place_by_range(df: DataFrame, order: str, name: str, weight: str | None = None) -> DataFrame:
    """Adds the 0-based place of each row by the unique column `order`, or with `weight` the
    sum of that column over all rows before.

    Rows are dealt out by ranges of the column, however its values are spread, and counted
    per range; the counts of the ranges before come in as an offset. The ranges are
    written, as both uses need the same ones.
    """
    each = F.col(weight) if weight else F.lit(1).cast("long")
    before = (Window.unboundedPreceding, -1)
    ranged = written(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_range").agg(F.sum(each).alias("_n"))
    ranges_before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(*before)
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(ranges_before), F.lit(0)).alias("_offset"))  # a row per range
    inside = F.coalesce(F.sum(each).over(Window.partitionBy("_range").orderBy(order).rowsBetween(*before)), F.lit(0))
    placed = ranged.withColumn("_inside", inside).join(offsets, "_range")
    return placed.withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long")).drop("_range", "_offset", "_inside")


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """`df` shuffled by `keys`, with a task per TASK_ROWS of its `rows` and no fewer than configured.

    One setting for tables of any size lets a task grow with the table, and Spark merges what is
    small when compressed, however many rows that is. Up to HOT_ROWS rows are left to both.
    """
    if rows <= HOT_ROWS:
        return df.repartition(*keys)
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(configured, -(-rows // TASK_ROWS)), *keys)


def oversized_keys(df: DataFrame, keys: Sequence[str], weight: Column | None, capacity: int) -> DataFrame | None:
    """Keys whose rows weigh more than `capacity` together, or None when there is none; an action.

    With their number of rows (_rows) and of parts (_parts). Only the keys are read, and what the
    weight needs; rows are combined before the shuffle. The result is written, so its size is
    known to whoever joins it; there are at most total weight / capacity such keys.
    """
    return _sized_keys(df, keys, weight, capacity)[0]


def _sized_keys(df: DataFrame, keys: Sequence[str], weight: Column | None, capacity: int) -> tuple[DataFrame | None, Row]:
    """The oversized keys, and how many there are (large), all rows with a key (rows) and the most rows of a key (most)."""
    each = F.lit(1) if weight is None else weight
    counts = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.sum(each).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    over = F.col("_n") > capacity
    found = counts.agg(
        F.count_if(over).alias("large"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.max("_rows").alias("most")
    ).first()
    if not found.large:
        return None, found
    parts = F.expr(f"(_n + {capacity} - 1) div {capacity}").alias("_parts")
    return written(counts.filter(over).select(*keys, "_rows", parts), "oversized"), found


def number_parts(
    children: DataFrame,
    keys: Sequence[str],
    part_size: int,
    part_bytes: int | None = None,
    gather: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Splits the children of each key into parts of at most `part_size` rows, and with
    `part_bytes` of about so many bytes (a part's last row may pass it).

    Returns the children with a `part` column, and the keys that need several parts (with
    _rows and _parts), or None if all children are in part 0. The children are dealt out by
    `gather` (`keys` if not given) and part, to be gathered. Keys are counted when this is
    called. The rows of an oversized key take consecutive places by (hash of the row, row), and
    the running weight gives the part, so a part depends on the rows of its key alone.

    A few oversized keys are broadcast: equal rows of theirs are counted into one first, so a heap
    of copies never meets in one task, and rows of all other keys are only passed on. When there
    are many, most rows need a place: a task sorts the rows of its keys, and only keys of
    more than HOT_ROWS rows take the way of the few.
    """
    keys = list(keys)
    gather = list(gather or keys)
    values = [c for c in children.columns if c not in keys]
    weight, capacity = None, part_size
    if part_bytes is not None:
        size = F.coalesce(F.octet_length(F.to_json(F.struct(*values))), F.lit(0)) if values else F.lit(0)
        weight, capacity = F.greatest(F.lit(part_bytes), size * part_size).cast("long"), part_size * part_bytes
    parts, found = _sized_keys(children, keys, weight, capacity)
    first = F.lit(0).cast("long").alias("part")
    if parts is None:
        return dealt(children.select(*children.columns, first), gather, found.rows), None
    each = (F.lit(1).cast("long") if weight is None else weight).alias("_each")
    hash_of_row = F.xxhash64(*values) if values else F.lit(0)
    many = found.large > MAX_HOT_KEYS
    apart, rest = parts, children
    if many:
        hot_rows = max(HOT_ROWS, found.rows // MAX_HOT_KEYS)
        apart = parts.filter(F.col("_rows") > hot_rows) if found.most > hot_rows else None
        parts = dealt(parts, keys, found.rows)
    if apart is not None:
        rest = children.join(F.broadcast(apart.select(*keys)), keys, "left_anti")
    if many:
        has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        in_tasks = dealt(rest.filter(has_key).select(*children.columns, each), keys, found.rows)
        by_key = Window.partitionBy(*keys)
        sized = in_tasks.withColumn("_n", F.sum("_each").over(by_key))
        bucketed = sized.withColumn("_bucket", F.pmod(hash_of_row, F.expr(f"(_n + {capacity} - 1) div {capacity}")))
        before = by_key.orderBy("_bucket", *values).rowsBetween(Window.unboundedPreceding, -1)
        placed = bucketed.withColumn("_start", F.coalesce(F.sum("_each").over(before), F.lit(0)))
        numbered = placed.select(*children.columns, F.expr(f"_start div {capacity}").alias("part"))
        numbered = numbered.unionByName(rest.filter(~has_key).select(*children.columns, first))
    else:
        numbered = rest.select(*children.columns, first)
    if apart is not None:
        large = children.select(*children.columns, each).join(F.broadcast(apart.select(*keys, "_parts")), keys)
        counted = large.groupBy(*keys, *values).agg(
            F.count(F.lit(1)).alias("_copies"), F.max("_parts").alias("_parts"), F.max("_each").alias("_each")
        )
        bucketed = counted.withColumn("_bucket", F.pmod(hash_of_row, F.col("_parts")) if values else F.lit(0))
        placed = running_start(bucketed, keys, "_bucket", values or [F.lit(0)], F.col("_copies") * F.col("_each"), "_start")
        copies = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        part = F.expr(f"(_start + _copy * _each) div {capacity}").alias("part")
        numbered = numbered.unionByName(copies.select(*children.columns, part))
    return dealt(numbered, [*gather, "part"], found.rows), parts
