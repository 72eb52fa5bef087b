"""Benchmark decontamination: SimHash of item-sized windows, found through a
multi-index of Hamming blocks and confirmed by exact weighted-shingle similarity.

Shingles are of five words (one of all words if a text has fewer), weighted by how
often they occur. For every length of an item, a window of as many shingles slides
over each document, by one shingle; a document shorter than the item is one window.
A window's 64-bit SimHash is cut into BLOCKS blocks. If it is within RADIUS bits of
an item's, some block is within FLIPS bits of the item's, so a table of every item's
blocks with up to FLIPS bits turned finds all items within the radius. Candidates
are confirmed by the weighted Jaccard similarity of window and item, `least` or more.
At similarity 0.8 some 10 of 64 bits differ on average; 20 is 3.5 deviations away.

Windows of which fewer than half of the shingles occur in any item can't reach a
similarity of 0.8 and are not hashed; this loses nothing.

The benchmark is the query set. It is taken to the tasks in blocks of at most
`block_items` items, each against all documents, so its size has no limit.

Defined results: null and empty texts and items match nothing. Rows of documents
that share an id are judged each and give one row per item, the best. Items without
an id are left out of the report, but count in `without_leaks`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.bytesops import U64, Texts, chunks, mix, pack, ranges, sums
from folia.llm.bytesops import texts as to_texts
from folia.llm.common import id_text, map_arrow
from folia.llm.neardup import shingles, similarity

RADIUS, FLIPS, BLOCKS = 20, 2, 7  # 7 blocks of at least 3 bits each would make 21
WIDTHS = (10, 9, 9, 9, 9, 9, 9)
LONG = pa.int64()
SCHEMA = pa.schema([("doc_id", LONG), ("item_id", LONG), ("similarity", pa.float64()), ("start_word", LONG), ("n_windows", LONG)])
BITS = U64(1) << np.arange(64, dtype=U64)


def signs(found: np.ndarray) -> np.ndarray:
    """Plus or minus one per shingle and bit."""
    return (((mix(found)[:, None] & BITS) != 0) * 2 - 1).astype(np.int32)


def simhash(total: np.ndarray) -> np.ndarray:
    return ((total > 0) * BITS).sum(1, dtype=U64)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _blocks(prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    shift = 0
    for width in WIDTHS:
        yield width, ((prints >> U64(shift)) & U64((1 << width) - 1)).astype(np.int64)
        shift += width


class MultiIndex:
    """All fingerprints within RADIUS of a query, found by blocks."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.tables = []
        for width, value in _blocks(prints):
            turns = np.array([sum(1 << b for b in c) for n in range(FLIPS + 1) for c in combinations(range(width), n)])
            near = (value[:, None] ^ turns).reshape(-1)
            order = np.argsort(near, kind="stable")
            first = np.searchsorted(near[order], np.arange((1 << width) + 1))
            self.tables.append((first, np.repeat(np.arange(len(prints)), len(turns))[order]))

    def query(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of the query, place of the item) within the radius."""
        pairs = []
        for (_, value), (first, items) in zip(_blocks(prints), self.tables, strict=True):
            count = first[value + 1] - first[value]
            at = ranges(first[value], count)
            pairs.append(np.repeat(np.arange(len(prints)), count) * len(self.prints) + items[at])
        q, i = np.divmod(np.unique(np.concatenate(pairs)), max(len(self.prints), 1))
        near = hamming(prints[q], self.prints[i]) <= RADIUS
        return q[near], i[near]


class Items:
    """A block of benchmark items, by their number of shingles."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        found, offsets = shingles(to_texts([x for _, x in rows]))
        self.ids = [i for i, _ in rows]
        self.of = [np.sort(found[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.known = np.unique(found)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.known & U64((1 << 22) - 1)).astype(np.int64)] = True
        size = np.diff(offsets)
        self.groups = []
        for n in np.unique(size[size > 0]):
            own = np.flatnonzero(size == n)
            prints = np.array([simhash(signs(self.of[i]).sum(0, keepdims=True))[0] for i in own], U64)
            self.groups.append((int(n), own, MultiIndex(prints)))

    def marked(self, found: np.ndarray) -> np.ndarray:
        """Which shingles occur in an item."""
        hit = self.maybe[(found & U64((1 << 22) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, found[at]), len(self.known) - 1)
            hit[at] = self.known[place] == found[at]
        return hit

    def matches(self, t: Texts, least: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, best similarity, first shingle of that window, windows)."""
        found, offsets = shingles(t)
        hit = self.marked(found)
        total = sums(hit)
        for text in np.flatnonzero(total[offsets[1:]] > total[offsets[:-1]]):
            own = found[offsets[text] : offsets[text + 1]]
            count = sums(hit[offsets[text] : offsets[text + 1]])
            # Sums of signs only around the shingles that occur in an item.
            here = np.flatnonzero(np.diff(count))
            reach = max(n for n, _, _ in self.groups)
            low, high = max(0, here[0] - reach), min(len(own), here[-1] + reach + 1)
            part, count = own[low:high], sums(hit[offsets[text] + low : offsets[text] + high])
            run = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(signs(part), 0, dtype=np.int32)))
            for n, items, index in self.groups:
                width = min(n, len(own))
                starts = np.arange(len(part) - width + 1)
                starts = starts[2 * (count[starts + width] - count[starts]) >= width]
                if not len(starts):
                    continue
                best: dict[int, list] = {}
                q, i = index.query(simhash(run[starts + width] - run[starts]))
                for at, item in zip(starts[q].tolist(), items[i].tolist(), strict=True):
                    score = similarity(np.sort(part[at : at + width]), self.of[item])
                    if score >= least:
                        held = best.setdefault(item, [score, at, 0])
                        held[2] += 1
                        if score > held[0]:
                            held[:2] = score, at
                for item, (score, at, windows) in best.items():
                    yield int(text), item, score, int(low + at), windows


def blocks(benchmark: DataFrame, block_items: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = max(1, -(-rows.count() // block_items))
    for b in range(n):
        own = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect()
        if own:
            yield Items([(r.id, r.text) for r in own])


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, block_items: int = 20_000) -> DataFrame:
    """One row per document and item that it holds: the best window's similarity and
    first word, and how many windows match."""
    ids = id_text(docs)
    parts = []
    for block in blocks(benchmark, block_items):
        held = ids.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in chunks(batch.column("text")):
                    doc = batch.column("doc_id").slice(t.first, t.last - t.first).to_pylist()
                    rows = [(doc[x], held.value.ids[i], s, at, n) for x, i, s, at, n in held.value.matches(t, least)]
                    yield pack({f.name: [r[k] for r in rows] for k, f in enumerate(SCHEMA)}, SCHEMA)

        parts.append(map_arrow(ids, run, SCHEMA))
    if not parts:
        return map_arrow(ids.limit(0), lambda batches: batches, SCHEMA)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.max_by(F.struct("similarity", "start_word", "n_windows"), F.struct("similarity", -F.col("start_word"), "n_windows"))
    one = found.filter("doc_id IS NOT NULL AND item_id IS NOT NULL").groupBy("doc_id", "item_id").agg(best.alias("b"))
    return one.select("doc_id", "item_id", "b.similarity", "b.start_word", "b.n_windows")


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, block_items: int = 20_000, text_col: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    kept = docs
    for block in blocks(benchmark, block_items):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in chunks(batch.column(text_col)):
                    clean = np.ones(t.size, bool)
                    for x, *_ in held.value.matches(t, least):
                        clean[x] = False
                    yield batch.slice(t.first, t.last - t.first).filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
