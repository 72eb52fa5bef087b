"""Hard-negative mining by a secondary-sort shuffle.

Scores are exact integer inner products of floor(256 * x). For a block of anchors the rows
are scanned twice where they lie, without a shuffle. The first scan finds the positives:
each task keeps the best few same-label rows of every anchor. They fix windows of scores,
from `least` percent of a positive's score up to that score; the second scan keeps, in each
task, the first few rows of other labels of every window. What a task drops has enough
better ones in that very task, so nothing of the result is lost.

What is left is packed into keys (anchor, descending score, positives first, id), dealt out
by anchor and sorted within partitions. An iterator walks over the sorted keys: a positive
opens its window, a negative goes to every open window that is not full. It holds the
windows of one anchor, never its rows. Equal scores are ordered by id, and a positive comes
before negatives of the same score, which belong to its window.

Anchors are taken in blocks of `block_bytes`; only one block is broadcast at a time.

Defined results: rows with a null id, label or vector, or with any null or non-finite
component take no part; a shorter vector counts as filled up with zeros (an empty one is all
zeros); components and scores beyond a long saturate. Rows with the anchor's own id are
never its partners. A repeated row counts as often as it is there, but a repeated anchor
row is one anchor; rows that share an id and differ are anchors of their own. An anchor
without positives, and a positive whose window is empty, have no rows. An empty table gives none.
Columns other than the three named are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.llm.bytesops import pack
from folia.llm.common import map_arrow, new_path
from folia.operators.spread import place_by_range

LONG = pa.int64()
SCORED = pa.schema([("anchor", LONG), ("score", LONG), ("id", LONG)])
KEYS = pa.schema([("anchor", LONG), ("key", pa.binary())])
MINED = pa.schema([("anchor", LONG), ("positive_id", LONG), ("rank", pa.int32()), ("negative_id", LONG), ("positive_score", LONG), ("negative_score", LONG)])
KEY = np.dtype([("anchor", ">u8"), ("down", ">u8"), ("negative", "u1"), ("id", ">u8")])
SIGN = np.uint64(1 << 63)
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SCALE = 256
CELLS = 1 << 21  # scores in memory at a time
HELD = 1 << 18  # candidates a task gathers before it drops the lower ones


def vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """Rows that take part: vec_id, label and the components as whole numbers."""
    plain = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = plain.na.drop(subset=["vec_id", "label", "x"]).filter(~odd)
    return whole.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("cells"))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, one a row, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten())
    size = np.asarray(column.value_lengths()).astype(np.int64)
    width = int(size.max(initial=0))
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b, as long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    if most[0] * most[1] * width < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, LOWEST, HIGHEST).astype(np.int64)


def first(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, n: int) -> np.ndarray:
    """Which entries are among the first n of their anchor, by falling score and rising id."""
    order = np.lexsort((ident, ~score, anchor))
    own = anchor[order]
    begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(own)]))))
    return order[rank < n]


class Anchors:
    """A block of anchors: their numbers, ids, labels and vectors."""

    def __init__(self, rows: list):
        self.number = np.array([r["start"] for r in rows], np.int64)
        self.id = np.array([r["vec_id"] for r in rows], np.int64)
        self.label = np.array([r["label"] for r in rows], np.int64)
        self.cells = matrix(pa.array([r["cells"] for r in rows], pa.list_(LONG)))

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores of all anchors with some rows at a time, and those rows' ids and labels."""
        for batch in batches:
            ident, label = (np.asarray(batch.column(c)) for c in ("vec_id", "label"))
            cells = matrix(batch.column("cells"))
            step = max(1, CELLS // len(self.id))
            for a in range(0, len(ident), step):
                yield inner(self.cells, cells[a : a + step]), ident[a : a + step], label[a : a + step]


class Held:
    """Candidates of a task: index of the anchor, score, id."""

    def __init__(self, keep):
        self.keep, self.parts, self.size = keep, [], 0

    def add(self, *part: np.ndarray) -> bool:
        """Takes candidates; tells whether the lower ones have just been dropped."""
        self.parts.append(part)
        self.size += len(part[0])
        if self.size <= HELD:
            return False
        self.all()
        return True

    def all(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        whole = tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))
        chosen = self.keep(*whole)
        whole = tuple(x[chosen] for x in whole)
        self.parts, self.size = [whole], len(chosen)
        return whole


def _positives(block: Broadcast, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = block.value
        held = Held(lambda a, s, i: first(a, s, i, n))
        floor = np.full(len(own.id), LOWEST, np.int64)
        for score, ident, label in own.scored(batches):
            a, r = np.nonzero((own.label[:, None] == label) & (score >= floor[:, None]))
            other = own.id[a] != ident[r]
            a, r = a[other], r[other]
            if held.add(a, score[a, r], ident[r]):
                # Lower than the last of a full list no row can get in any more.
                index, kept, _ = held.all()
                full = np.bincount(index, minlength=len(floor)) == n
                least = np.full(len(floor), HIGHEST, np.int64)
                np.minimum.at(least, index, kept)
                floor = np.where(full, least, floor)
        index, score, ident = held.all()
        yield pack({"anchor": own.number[index], "score": score, "id": ident}, SCORED)

    return run


class Windows:
    """The ranges of scores that the positives of a block's anchors open."""

    def __init__(self, own: Anchors, positives: list, n: int, least: int):
        self.low = np.full((len(own.id), n), HIGHEST, np.int64)
        self.high = np.full((len(own.id), n), LOWEST, np.int64)
        place = {int(x): k for k, x in enumerate(own.number)}
        seen = np.zeros(len(own.id), np.int64)
        for r in positives:
            k = place[r["anchor"]]
            self.low[k, seen[k]], self.high[k, seen[k]] = lowest(r["score"], least), r["score"]
            seen[k] += 1


def lowest(score: int, least: int) -> int:
    """The smallest whole score s with least * score <= 100 * s, as a long."""
    return min(-(-least * score // 100), HIGHEST)


def _negatives(block: Broadcast, windows: Broadcast, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, opened = block.value, windows.value

        def keep(a, s, i):
            chosen = np.zeros(len(a), bool)
            for w in range(opened.low.shape[1]):
                inside = np.flatnonzero((s >= opened.low[a, w]) & (s <= opened.high[a, w]))
                chosen[inside[first(a[inside], s[inside], i[inside], n)]] = True
            return np.flatnonzero(chosen)

        held = Held(keep)
        low, high = opened.low.min(1, keepdims=True), opened.high.max(1, keepdims=True)
        for score, ident, label in own.scored(batches):
            a, r = np.nonzero((score >= low) & (score <= high) & (own.label[:, None] != label))
            other = own.id[a] != ident[r]
            a, r = a[other], r[other]
            held.add(a, score[a, r], ident[r])
        index, score, ident = held.all()
        yield pack({"anchor": own.number[index], "score": score, "id": ident}, SCORED)

    return run


def _packing(negative: bool):
    """Keys whose bytes are in the order of the walk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.empty(batch.num_rows, KEY)
            number, score, ident = (np.asarray(batch.column(c)) for c in ("anchor", "score", "id"))
            key["anchor"], key["down"], key["negative"], key["id"] = number.view(np.uint64), ~(score.view(np.uint64) ^ SIGN), negative, ident.view(np.uint64) ^ SIGN
            ends = np.arange(len(key) + 1, dtype=np.int32) * KEY.itemsize
            raw = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(key.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), raw], schema=KEYS)

    return run


def _walking(n: int, least: int):
    """Walks over sorted keys: positives open windows, negatives fill the open ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, opened = None, []  # the anchor, and its windows: positive, its score, lowest score, rows so far
        for batch in batches:
            key = np.frombuffer(b"".join(batch.column("key").to_pylist()), KEY)
            numbers = key["anchor"].astype(np.int64).tolist()
            scores = (~key["down"].astype(np.uint64) ^ SIGN).view(np.int64).tolist()
            idents = (key["id"].astype(np.uint64) ^ SIGN).view(np.int64).tolist()
            out: list[tuple] = []
            for number, score, negative, ident in zip(numbers, scores, key["negative"].tolist(), idents, strict=True):
                if number != now:
                    now, opened = number, []
                if not negative:
                    opened.append([ident, score, lowest(score, least), 0])
                    continue
                for window in opened:
                    if window[3] < n and score >= window[2]:
                        window[3] += 1
                        out.append((number, window[0], window[3], ident, window[1], score))
                # Scores fall, so a window that is full or left behind stays so.
                opened = [w for w in opened if w[3] < n and score >= w[2]]
            columns = list(zip(*out, strict=True)) or [[] for _ in MINED]
            yield pack(dict(zip(MINED.names, columns, strict=True)), MINED)

    return run


def hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    *,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """For each anchor (ids divisible by `every`) and each of its first `positives` rows of the
    same label, the first `negatives` rows of other labels that score at least `least` percent
    of the positive and no more than it: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score."""
    spark = rows.sparkSession
    valid = vectors(rows, id_col, vector_col, F.col(label) if isinstance(label, str) else label)
    chosen = valid.filter(F.col("vec_id") % every == 0).distinct()
    sized = chosen.withColumn("order", F.struct("vec_id", "label", "cells")).withColumn("bytes", (F.size("cells") * 8 + 64).cast("long"))
    placed = place_by_range(sized, "order", "start", "bytes").drop("order", "bytes")
    path = new_path(spark, "anchors")
    placed.withColumn("block", F.expr(f"start div {block_bytes}")).write.parquet(path)
    anchors = spark.read.parquet(path)
    found = {name: new_path(spark, name) for name in ("positives", "negatives")}
    blocks = [r["block"] for r in anchors.select("block").distinct().orderBy("block").collect()]
    for number in blocks:
        mine = anchors.filter(F.col("block") == number).collect()
        own = Anchors(mine)
        block = spark.sparkContext.broadcast(own)
        by_rank = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
        best = map_arrow(valid, _positives(block, positives), SCORED).withColumn("_rank", F.row_number().over(by_rank)).filter(F.col("_rank") <= positives)
        best.drop("_rank").withColumn("block", F.lit(number)).write.mode("append").parquet(found["positives"])
        mine = spark.read.parquet(found["positives"]).filter(F.col("block") == number).collect()  # at most `positives` an anchor
        windows = spark.sparkContext.broadcast(Windows(own, mine, positives, least))
        map_arrow(valid, _negatives(block, windows, negatives), SCORED).write.mode("append").parquet(found["negatives"])
        block.destroy()
        windows.destroy()
    if not blocks:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    keys = [map_arrow(spark.read.parquet(found[name]).select("anchor", "score", "id"), _packing(name == "negatives"), KEYS) for name in found]
    dealt = keys[0].unionByName(keys[1]).repartition("anchor").sortWithinPartitions("key")
    mined = map_arrow(dealt, _walking(negatives, least), MINED)
    names = anchors.select(F.col("start").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return mined.join(names, "anchor").select("anchor_id", *MINED.names[1:])
