"""Line dedup that can be taken back: exact reference counts of line keys, and
sharded cuckoo filters of the keys that repeat.

A key is a line with white space stripped at both ends and A-Z lower-cased, as a
128-bit fingerprint; keys of fewer than `least` code points are left out. Three
tables make an index, each a function of the documents that are in it:

* `refs`: one row per key and document that holds it;
* `counts`: per key, the number of those documents and the smallest id;
* `filters`: per shard of keys, a cuckoo filter of the keys with two documents or
  more. A shard is sized by its keys, so a filter stays below a megabyte.

`insert` and `delete` change the reference rows and counts of the keys concerned,
and take fingerprints into the filters or out of them; a filter that must grow is
built anew from the counts. A cuckoo filter has false positives, never
false negatives: what passes it is looked up in `counts`, so results are exact.

Counts are partial sums before the shuffle, so a line that most documents share
costs one row per task. The rows of such a key meet their count in a join
that Spark splits when it is skewed.

Defined results: null and empty texts have one empty line. Rows with the same id
are one document; rows without an id keep all their lines and are not counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from folia.llm.bytesops import SPACE, U64, Texts, chunks, mix, pack
from folia.llm.common import id_text, map_arrow, written

SHARD_KEYS = 200_000
SLICES = 32
SLOTS = 4
LONG = pa.int64()
REFS = pa.schema([("high", LONG), ("low", LONG), ("doc_id", LONG)])
FILTERS = pa.schema([("shard", pa.int32()), ("n_keys", LONG), ("cells", pa.binary())])
RESULT = pa.schema([("doc_id", LONG), ("n_lines", LONG), ("n_dropped", LONG), ("kept_sha256", pa.string()), ("n_kept_chars", LONG)])


class Cuckoo:
    """A cuckoo filter: 16-bit fingerprints in buckets of four, two buckets a key."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    @staticmethod
    def sized(n_keys: int) -> Cuckoo:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(n_keys, 1) / (SLOTS * 0.8)))))
        return Cuckoo(np.zeros((buckets, SLOTS), np.uint16))

    @staticmethod
    def of(keys: np.ndarray) -> Cuckoo:
        """A filter of distinct keys, doubled until they fit."""
        found = Cuckoo.sized(len(keys))
        while not found.insert(keys):
            found = Cuckoo(np.zeros((2 * len(found.cells), SLOTS), np.uint16))
        return found

    @staticmethod
    def read(raw: bytes) -> Cuckoo:
        return Cuckoo(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = U64(len(self.cells) - 1)
        h = mix(keys.astype(U64))
        mark = ((h >> U64(48)) | U64(1)).astype(np.uint16)
        one = h & mask
        return mark, one.astype(np.int64), (one ^ (mix(mark.astype(U64)) & mask)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.cells[one] == mark[:, None]).any(1) | (self.cells[two] == mark[:, None]).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """Adds distinct keys; False if the filter is full (it then needs building anew)."""
        mark, one, two = (x.tolist() for x in self._places(keys))
        other = (mix(np.arange(1 << 16, dtype=U64)) & U64(len(self.cells) - 1)).astype(np.int64)
        cells = self.cells.tolist()
        for m, a, b in zip(mark, one, two, strict=True):
            for place in (a, b):
                if 0 in cells[place]:
                    cells[place][cells[place].index(0)] = m
                    break
            else:
                place = b
                for kick in range(500):
                    slot = (m + kick) % SLOTS
                    m, cells[place][slot] = cells[place][slot], m
                    place ^= int(other[m])
                    if 0 in cells[place]:
                        cells[place][cells[place].index(0)] = m
                        break
                else:
                    return False
        self.cells = np.array(cells, np.uint16)
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Takes out keys that were inserted."""
        for m, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for place in (a, b):
                hit = np.flatnonzero(self.cells[place] == m)
                if len(hit):
                    self.cells[place, hit[0]] = 0
                    break


def line_keys(t: Texts, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """High and low half of each line's key, and whether it is long enough."""
    starts, ends, _ = t.line_spans
    low = t.lowered()
    # The first and last byte of a line that is not white space.
    solid = np.flatnonzero(~SPACE[t.data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    empty = first == last
    begin, finish = starts.copy(), starts.copy()
    begin[~empty], finish[~empty] = solid[first[~empty]], solid[last[~empty] - 1] + 1
    enough = t.code_points[finish] - t.code_points[begin] >= least
    # Long lines are few enough for a cryptographic digest each.
    high, lower = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    data = low.data.tobytes()
    at = np.flatnonzero(enough)
    digests = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begin[at].tolist(), finish[at].tolist(), strict=True))
    pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
    high[at], lower[at] = pair[:, 0], pair[:, 1]
    return high, lower, enough


def references(docs: DataFrame, least: int) -> DataFrame:
    """Distinct (high, low, doc_id) of all lines that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for t in chunks(batch.column("text")):
                high, low, enough = line_keys(t, least)
                owner = np.repeat(ids[t.first : t.last], np.diff(t.line_spans[2]))
                rows = np.unique(np.stack([high[enough], low[enough], owner[enough].astype(np.int64)], 1), axis=0)
                yield pack({"high": rows[:, 0], "low": rows[:, 1], "doc_id": rows[:, 2]}, REFS)

    return map_arrow(id_text(docs).filter("doc_id IS NOT NULL"), run, REFS)


def _counts(refs: DataFrame) -> DataFrame:
    """Documents per key and the smallest of them. Rows of one document that stand
    in several input rows are equal and count once."""
    return refs.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _shards(n_keys: int) -> int:
    return max(1, -(-n_keys // SHARD_KEYS))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))


def build_filters(counts: DataFrame, shards: int) -> DataFrame:
    """One filter per shard over the keys of two documents or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            shard, key = batch.column("shard").to_numpy(), batch.column("low").to_numpy()
            for s in np.unique(shard):
                held.setdefault(int(s), []).append(key[shard == s])
        for s, parts in sorted(held.items()):
            keys = np.unique(np.concatenate(parts))
            yield pack({"shard": [s], "n_keys": [len(keys)], "cells": [Cuckoo.of(keys).cells.tobytes()]}, FILTERS)

    keys = _sharded(counts.filter("n_docs >= 2"), shards).select("shard", "low")
    return map_arrow(keys.repartition(F.col("shard")), run, FILTERS)


@dataclass
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    least: int

    @staticmethod
    def of(refs: DataFrame, least: int) -> LineIndex:
        refs = written(refs, "line-refs")
        counts = written(_counts(refs), "line-counts")
        shards = _shards(counts.filter("n_docs >= 2").count())
        return LineIndex(refs, counts, written(build_filters(counts, shards), "line-filters"), shards, least)

    @staticmethod
    def build(docs: DataFrame, least: int = 10) -> LineIndex:
        """The index of these documents. A document that stands in several rows of
        the input counts once per key."""
        ids = id_text(docs)
        refs = references(ids, least)
        # Only rows that share an id can repeat a reference row.
        twice = ids.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL")
        return LineIndex.of(refs if twice.isEmpty() else refs.distinct(), least)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with further documents; those already in it change nothing."""
        new = references(docs, self.least).distinct().join(self.refs, ["high", "low", "doc_id"], "left_anti")
        return self._changed(written(new, "line-refs"), 1)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of these ids, as if they had never come."""
        gone = self.refs.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
        return self._changed(written(gone.select("high", "low", "doc_id"), "line-refs"), -1)

    def _changed(self, change: DataFrame, sign: int) -> LineIndex:
        keys = ["high", "low"]
        refs = written(self.refs.unionByName(change) if sign > 0 else self.refs.join(change, [*keys, "doc_id"], "left_anti"), "line-refs")
        touched = change.select(*keys).distinct()
        fresh = written(_counts(refs.join(touched, keys, "left_semi")), "line-counts")
        counts = written(self.counts.join(touched, keys, "left_anti").unionByName(fresh), "line-counts")
        was = self.counts.filter("n_docs >= 2").join(touched, keys, "left_semi").select(*keys)
        now = fresh.filter("n_docs >= 2").select(*keys)
        moves = now.join(was, keys, "left_anti").withColumn("sign", F.lit(1)).unionByName(was.join(now, keys, "left_anti").withColumn("sign", F.lit(-1)))
        shards = _shards(counts.filter("n_docs >= 2").count())
        if shards > 2 * self.shards:
            return LineIndex(refs, counts, written(build_filters(counts, shards), "line-filters"), shards, self.least)
        return LineIndex(refs, counts, written(self._moved(counts, moves), "line-filters"), self.shards, self.least)

    def _moved(self, counts: DataFrame, moves: DataFrame) -> DataFrame:
        """The filters with keys taken in and out; a full one is built anew, together
        with those that have no filter yet."""

        def run(key, left, right):
            raw = left.column("cells").to_pylist()
            sign, low = right.column("sign").to_numpy(), right.column("low").to_numpy()
            f = Cuckoo.read(raw[0]) if raw else Cuckoo.sized(len(low))
            f.delete(np.unique(low[sign < 0]))
            fits = f.insert(np.unique(low[sign > 0]))
            n = (left.column("n_keys").to_pylist() or [0])[0] + int(sign.sum())
            return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([n if fits else -1], LONG), pa.array([f.cells.tobytes()], pa.binary())], schema=FILTERS)

        moved = self.filters.groupBy("shard").cogroup(_sharded(moves, self.shards).groupBy("shard")).applyInArrow(run, from_arrow_schema(FILTERS))
        moved = written(moved, "line-filters")
        full = moved.filter("n_keys < 0").select("shard")
        if full.isEmpty():
            return moved
        again = build_filters(_sharded(counts, self.shards).join(full, "shard", "left_semi").drop("shard"), self.shards)
        return moved.filter("n_keys >= 0").unionByName(again)

    def suspects(self) -> DataFrame:
        """The reference rows that pass their shard's filter.

        A filter goes ahead of the rows of its shard, in as many slices of the
        documents as spread a frequent line over tasks.
        """
        zero = F.lit(0).cast("long")
        rows = _sharded(self.refs, self.shards).select("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).alias("slice"), F.lit(1).alias("head"), "high", "low", "doc_id", F.lit(None).cast("binary").alias("cells"))
        slices = F.explode(F.sequence(zero, F.lit(SLICES - 1).cast("long")))
        filters = self.filters.select("shard", slices.alias("slice"), F.lit(0).alias("head"), zero.alias("high"), zero.alias("low"), zero.alias("doc_id"), "cells")
        placed = filters.unionByName(rows).repartition(F.col("shard"), F.col("slice")).sortWithinPartitions("shard", "slice", "head")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, of = None, None
            for batch in batches:
                head, shard, low = (batch.column(c).to_numpy() for c in ("head", "shard", "low"))
                hit = np.zeros(len(head), bool)
                edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(head) != 0)) + 1
                for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(head)])), strict=True):
                    if a < b and head[a] == 0:
                        found, of = Cuckoo.read(batch.column("cells")[int(a)].as_py()), shard[a]
                    elif a < b and of == shard[a]:
                        hit[a:b] = found.contains(low[a:b])
                yield batch.filter(pa.array(hit)).select(["high", "low", "doc_id"])

        return map_arrow(placed, run, REFS)

    def drops(self) -> DataFrame:
        """Per document, the keys whose lines it loses: those that a smaller id holds."""
        repeated = self.counts.filter("n_docs >= 2").select("high", "low", "first_doc")
        lost = self.suspects().join(repeated, ["high", "low"]).filter("doc_id > first_doc")
        return lost.groupBy("doc_id").agg(F.collect_list("low").alias("drop_low"), F.collect_list("high").alias("drop_high"))


def _kept(t: Texts, rows: pa.RecordBatch, least: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The remaining text of each row, its number of lines, and how many go."""
    starts, ends, offsets = t.line_spans
    gone = np.zeros(len(starts), bool)
    drop_low, drop_high = rows.column("drop_low"), rows.column("drop_high")
    own = drop_low.is_valid().to_numpy(zero_copy_only=False)
    if own.any():
        high, low, enough = line_keys(t, least)
        for i in np.flatnonzero(own):
            lines = slice(offsets[i], offsets[i + 1])
            pairs = set(zip(drop_high[int(i)].as_py(), drop_low[int(i)].as_py(), strict=True))
            gone[lines] = [e and (h, w) in pairs for h, w, e in zip(high[lines].tolist(), low[lines].tolist(), enough[lines].tolist(), strict=True)]
    data = t.data.tobytes()
    out = []
    for i in range(t.size):
        lines = range(offsets[i], offsets[i + 1])
        if not own[i]:
            out.append(data[t.offsets[i] : t.offsets[i + 1]])
        else:
            out.append(b"\n".join(data[starts[k] : ends[k]] for k in lines if not gone[k]))
    dropped = np.add.reduceat(gone.astype(np.int64), offsets[:-1]) if t.size else np.zeros(0, np.int64)
    return out, np.diff(offsets), dropped


def line_dedup(docs: DataFrame, least: int = 10, index: LineIndex | None = None) -> DataFrame:
    """Per row of `docs`: its lines, how many go, and what stays."""
    index = index or LineIndex.build(docs, least)
    least = index.least
    joined = id_text(docs).join(index.drops(), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                rows = batch.slice(t.first, t.last - t.first)
                kept, n_lines, dropped = _kept(t, rows, least)
                yield pack(
                    {"doc_id": rows.column("doc_id"), "n_lines": n_lines, "n_dropped": dropped, "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "n_kept_chars": [len(x.decode()) for x in kept]},
                    RESULT,
                )

    return map_arrow(joined, run, RESULT)


def without_repeated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """`docs` with the remaining text, and its length where `n_chars` is a column.

    A null text stays null. Whatever the columns are called, they are kept apart from
    those that are joined to them.
    """
    index = LineIndex.build(docs, least)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("doc"))
    joined = whole.join(index.drops(), "doc_id", "left")
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc")
            own = dict(zip(names, doc.flatten(), strict=True))
            for t in chunks(doc.field(text_at)):
                rows = batch.slice(t.first, t.last - t.first)
                kept, _, dropped = _kept(t, rows, least)
                columns = {name: column.slice(t.first, t.last - t.first) for name, column in own.items()}
                columns["text"] = pa.array([x.decode() if s else None for x, s in zip(kept, columns["text"].is_valid().to_pylist(), strict=True)], pa.string())
                if "n_chars" in names:
                    before = columns["n_chars"]
                    fresh = [len(x.decode()) if d else n for x, d, n in zip(kept, dropped.tolist(), before.to_pylist(), strict=True)]
                    columns["n_chars"] = pa.array(fresh, before.type)
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return joined.mapInArrow(run, docs.schema)
