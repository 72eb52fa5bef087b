"""Filter interaction audit by forward-backward path counting on the lattice of filter subsets.

Filters run in some order, and each sees only what those before it kept. A state is the set of
filters that have run; an order is a path from the empty set to the full one, and applying a
filter is an edge. How many orders reach a state and how many leave it towards the end are
counted once by dynamic programming, forward and backward. What an edge removes depends on the
state alone, not on the order that led there, and follows from counts of documents by the set
of filters they fail. So a filter's Shapley sum, its removals over all orders, is the sum over
its edges of removals, weighted with the number of orders through the edge, and the steps of
each order are read from the very same edges.

Documents are read once: each becomes the set of filters it fails (a bit mask), its part and a
digest of its text. Only these small rows are shuffled. All is done by DataFrame functions.

Copies: a document fails `E` if a smaller doc_id has the same text anywhere in the table. Rows
are first counted by (digest, doc_id and what else matters), where no key is hot, then by
digest with the smallest id, combined before the shuffle, however many copies a text has.

Defined results: a null text counts as empty and a null part as the empty string; an empty text
has no words, fails A and no other but E. A row without a doc_id has no labels and takes no
part in the comparison of ids. Repeated rows count each; equal ids are not smaller than each
other. A document is good (toxic) if any of its labels says so. No documents give no rows.
Columns other than those named are never read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.llm.common import written
from folia.operators.spread import HOT_ROWS, counted_hot_keys, lookup_join

SPACES = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For each subset of k filters, the number of paths from the empty set and to the full one."""
    forward, backward = [0] * (1 << k), [0] * (1 << k)
    forward[0] = backward[-1] = 1
    for state in range(1 << k):
        for f in range(k):
            if state >> f & 1:
                forward[state] += forward[state ^ 1 << f]
    for state in reversed(range(1 << k)):
        for f in range(k):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def edges(k: int) -> list[tuple[int, int, int]]:
    """(state, filter, number of orders through it) for all edges."""
    forward, backward = path_counts(k)
    return [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << k) for f in range(k) if not s >> f & 1]


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, digest, and the mask of the filters A to D that the text fails."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    split = plain.withColumn("words", F.array_remove(F.split("t", SPACES), ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))
    fails = (n < 100, distinct * 100 < n * 80, capitals * 100 > F.length("t") * 10, F.col("t").rlike("[#$%&*|]"))
    mask = sum((F.when(c, 1 << f).otherwise(0) for f, c in enumerate(fails)), F.lit(0))
    return split.select("doc_id", "part", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), mask.alias("mask"))


def flags(labels: DataFrame) -> DataFrame:
    """Documents that any label calls good or toxic: doc_id, good, toxic."""
    says = [F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*says).filter("good + toxic > 0")


def mask_counts(docs: DataFrame, labels: DataFrame, *, hot_rows: int = HOT_ROWS, **columns: str) -> DataFrame:
    """Documents by part and set of filters failed, E included: part, mask, n, good, toxic."""
    rows = written(failures(docs, **columns), "failures")
    named = rows.filter("doc_id IS NOT NULL")
    marked = lookup_join(named, flags(labels), ["doc_id"], "left", counted_hot_keys(named, ["doc_id"], hot_rows)).na.fill(0, ["good", "toxic"])
    kind = ["part", "mask", "good", "toxic"]
    by_id = marked.groupBy("doc_id", "digest", *kind).agg(F.count(F.lit(1)).alias("c"))
    by_text = by_id.groupBy("digest", *kind).agg(F.min(F.struct("doc_id", "c")).alias("least"), F.sum("c").alias("n"))
    # A row per kind of copy: parts and labels, not copies.
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("least.doc_id") == smallest, F.col("least.c")).otherwise(0)
    split = by_text.withColumn("originals", originals).select(
        "part", "good", "toxic",
        F.inline(F.array(F.struct(F.col("mask"), F.col("originals").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))),
    )
    nameless = rows.filter("doc_id IS NULL").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    whole = split.filter("n > 0").unionByName(nameless)
    return whole.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def edge_counts(masks: DataFrame, k: int) -> DataFrame:
    """What happens on each edge of each part's lattice: part, state, filter, the counts, and the
    filter's Shapley sum over all orders. Not more than 2^k rows of a part meet here."""
    each = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).alias("orders")) for s, f, w in edges(k)])
    on_edge = masks.select("*", F.inline(each))
    bit = F.expr("shiftleft(1, filter)")
    before = F.col("mask").bitwiseAND(F.col("state"))
    fails = F.col("mask").bitwiseAND(bit) != 0
    gone = fails & (before == 0)
    total = lambda column, test, name: F.sum(F.when(test, F.col(column)).otherwise(0)).alias(name)
    counted = on_edge.groupBy("part", "state", "filter", "orders").agg(
        total("n", ~fails & (before == 0), "kept"),
        total("n", gone, "removed"),
        total("n", fails & (before != 0), "redundant"),
        total("n", F.col("mask") == bit, "unique_fails"),
        total("good", gone, "good_lost"),
        total("toxic", gone, "toxic_lost"),
    )
    weighted = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    return counted.withColumn("shapley", weighted)


def order_steps(counted: DataFrame, names: str) -> DataFrame:
    """The steps of every order of the filters, read from the edges: part, filter_order, step,
    the counts and shapley. There are len(names)! orders, so this is for a handful of filters."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[x] for x in order), step, state, f))
            state |= 1 << f
    steps = counted.sparkSession.createDataFrame(rows, "filter_order string, step int, state int, filter int")
    joined = counted.join(F.broadcast(steps), ["state", "filter"])  # fixed size: k! * k rows
    return joined.select("part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in (*COUNTS, "shapley")])


def filter_interactions(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five filters: one row per part, order and step."""
    return order_steps(edge_counts(mask_counts(docs, labels, **columns), len(FILTERS)), FILTERS)
