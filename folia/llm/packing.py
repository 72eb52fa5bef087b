"""Packing of documents into sequences of `WINDOW` tokens by non-negative least squares.

A document's ids are cut into whole windows and a rest. The histogram of the rests'
lengths, in bins of UNIT tokens rounded up, is all that goes to the driver: at most
WINDOW / UNIT numbers, whatever the input. There, all combinations of up to three bins
that fill a window (to within a unit) are enumerated, the repeat counts that explain
the histogram best are solved by non-negative least squares, rounded down and held
to what is there. Rests take places by their rank in their bin. What is left over
is packed greedily one after another, and cut where a window is full.

Ranks and running sums are taken in slices by a hash of the piece, with offsets from the totals
of slices, so no bin is one task's work, and only numbers are sorted. Ids are never shuffled: the checksum of every piece is
known when a document is tokenized, since a rest carries its running checksums at
every UNIT tokens and a checksum of a part follows from those of two prefixes.

Texts are split where the tokenizer's own pattern always splits: at white space, which it
drops, and between an ASCII letter and an ASCII mark after it. A-Z are lower-cased, as
the tokenizer does. Each distinct part is encoded once, and the ids are those of
the whole text. Apostrophes and bars stay with what is around them, since
contractions and special tokens hold them; parts of a special token keep their case.

Defined results: null and empty texts are the one id END. Every input row is a
document of its own, so repeated rows are packed twice and a null id is kept.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.llm.bytesops import LOWER, U64, Texts, chunks, pack, ranges
from folia.llm.common import id_text, map_arrow, written

WINDOW, UNIT, END = 4096, 16, 2
BINS = WINDOW // UNIT
# Left over pieces are cut at whole units, so a window may get one unit less one more.
GREEDY = WINDOW - UNIT
# Ranks and running sums are taken in slices of about so many rows, all bins together; with more
# than MOST_SLICES of them slices grow, as the totals of the slices of a bin meet in one task.
SLICE_ROWS, MOST_SLICES = 4096, 1 << 16
LONG = pa.int64()
PIECES = pa.schema([("doc_id", LONG), ("start", LONG), ("length", LONG), ("ids_crc32", LONG), ("doc_tokens", LONG), ("bin", LONG), ("marks", pa.binary())])
PLACED = pa.schema([("doc_id", LONG), ("start", LONG), ("length", LONG), ("ids_crc32", LONG), ("doc_tokens", LONG), ("sequence_id", LONG), ("place", LONG)])


MARK = np.zeros(256, bool)
MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
MARK[[ord("'"), ord("|")]] = False
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def parts(t: Texts) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as the tokenizer sees them, and their parts: starts, ends, offsets by text."""
    starts, ends, offsets = t.word_spans
    data = LOWER[t.data]
    raw = t.data.tobytes()
    at = raw.find(b"<|")
    while at >= 0:  # rare: what may be a special token
        w = np.searchsorted(starts, at, "right") - 1
        data[starts[w] : ends[w]] = t.data[starts[w] : ends[w]]
        at = raw.find(b"<|", int(ends[w]))
    cut = np.zeros(len(data), bool)
    if len(data):
        cut[1:] = LETTER[t.data[:-1]] & MARK[t.data[1:]]
        cut[t.text_starts] = False
    # Where a part begins, one before it ends: one mark for each side, so no sorting.
    last = np.zeros(len(data) + 1, bool)
    last[ends] = True
    last[:-1] |= cut
    cut[starts] = True
    starts = np.flatnonzero(cut)
    return Texts(data, t.offsets, t.first, t.last), starts, np.flatnonzero(last), np.searchsorted(starts, t.offsets)


class Encoder:
    """Token ids of texts, with those of distinct words kept in flat arrays."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.forget()

    def forget(self) -> None:
        self.keys, self.first, self.size = np.empty(0, U64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > self.limit:
            self.forget()
        got = [e.ids for a in range(0, len(words), 4096) for e in self.tokenizer.encode_batch_fast(words[a : a + 4096], add_special_tokens=False)]
        size = np.array([len(x) for x in got], np.int32)
        first = (len(self.ids) + np.cumsum(size) - size).astype(np.int32)
        self.ids = np.concatenate((self.ids, np.array([i for x in got for i in x], np.uint32)))
        merged = np.concatenate((self.keys, keys))
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.first, self.size = np.concatenate((self.first, first))[order], np.concatenate((self.size, size))[order]

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with END after it, and offsets by text."""
        t, starts, ends, offsets = parts(t)
        words = t.hashes(starts, ends)
        distinct, where, inverse = np.unique(words, return_index=True, return_inverse=True)
        for again in range(2):
            place = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
            new = np.flatnonzero(self.keys[place] != distinct) if len(self.keys) else np.arange(len(distinct))
            if not len(new):
                break
            if again:  # the words of one chunk are more than are kept: take them all
                self.forget()
                new = np.arange(len(distinct))
            data = t.data.tobytes()
            limit, self.limit = self.limit, max(self.limit, len(new) + (0 if again else len(self.keys)) if again else self.limit)
            self._learn(distinct[new], [data[s:e].decode() for s, e in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            self.limit = limit
        place = np.searchsorted(self.keys, distinct)
        first, size = (self.first[place][inverse].astype(np.int64), self.size[place][inverse].astype(np.int64)) if len(words) else (np.empty(0, np.int64), np.empty(0, np.int64))
        before = np.concatenate(([0], np.cumsum(size)))
        out_offsets = before[offsets] + np.arange(t.size + 1)
        out = np.empty(out_offsets[-1], np.uint32)
        out[out_offsets[1:] - 1] = END
        inside = np.ones(len(out), bool)
        inside[out_offsets[1:] - 1] = False
        out[inside] = self.ids[ranges(first, size)]
        return out, out_offsets


@cache
def _powers() -> list[int]:
    """x to the power 8 * 2^i modulo the checksum's polynomial."""
    powers = [0x00800000]
    for _ in range(40):
        powers.append(_times(powers[-1], powers[-1]))
    return powers


def _times(a: int, b: int) -> int:
    """Product of polynomials over GF(2) modulo that of crc32, lowest bit highest power."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


@cache
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker, which later tasks find warm."""
    return Encoder(path)


def crc_of_rest(whole: int, head: int, rest_bytes: int) -> int:
    """crc32 of a string's rest, from those of the whole and of its head."""
    shift, i = 0x80000000, 0
    while rest_bytes:
        if rest_bytes & 1:
            shift = _times(_powers()[i], shift)
        rest_bytes >>= 1
        i += 1
    return whole ^ _times(shift, head)


def _pieces(doc_ids: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in PIECES}
    raw = memoryview(ids.astype("<u4").tobytes())
    for doc, a, b in zip(doc_ids.to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        for start in range(a, b, WINDOW):
            end = min(start + WINDOW, b)
            marks, crc = [], 0
            if end - start == WINDOW:
                crc = zlib.crc32(raw[4 * start : 4 * end])
            else:
                for at in range(start, end, UNIT):
                    crc = zlib.crc32(raw[4 * at : 4 * min(at + UNIT, end)], crc)
                    marks.append(crc)
            for name, x in zip(out, (doc, start - a, end - start, crc, b - a, -(-(end - start) // UNIT), np.array(marks, np.uint32).tobytes()), strict=True):
                out[name].append(x)
    return out


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Whole windows and rests of every document, with their checksums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for t in chunks(batch.column("text")):
                ids, offsets = encoder.encode(t)
                yield pack(_pieces(batch.column("doc_id").slice(t.first, t.last - t.first), ids, offsets), PIECES)

    return map_arrow(id_text(docs), run, PIECES)


def combinations(present: np.ndarray) -> list[tuple[int, ...]]:
    """One, two or three of the bins present that fill a window to within a unit."""
    have = set(present.tolist())
    found = {(a,) for a in have if a == BINS}
    for total in (BINS, BINS - 1):
        for a in have:
            if total - a in have and a >= total - a:
                found.add((a, total - a))
            for b in have:
                c = total - a - b
                if a >= b >= c and c in have:
                    found.add((a, b, c))
    return sorted(found, reverse=True)


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """min |a x - b| over x >= 0, by the active sets of Lawson and Hanson.

    Ends after three times as many steps as there are rows or columns, whichever are fewer, if the
    optimum is not found by then; what it leaves over is packed greedily.
    """
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    for _ in range(3 * min(a.shape)):
        slope = a.T @ (b - a @ x)
        slope[passive] = -np.inf
        if not len(slope) or slope.max() <= tolerance * max(1.0, np.abs(b).max()):
            break
        passive[slope.argmax()] = True
        while True:
            at = np.flatnonzero(passive)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min() > 0:
                break
            down = s <= 0
            step = np.min(x[at[down]] / np.maximum(x[at[down]] - s[down], 1e-300))
            x[at] += step * (s - x[at])
            passive[at[x[at] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
        x[:] = 0
        if passive.any():
            x[passive] = s
    return x


def plan(histogram: dict[int, int]) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins and how often each is used, within the histogram."""
    left = {b: n for b, n in histogram.items() if n > 0}
    chosen = []
    if left.get(BINS):
        chosen.append(((BINS,), left.pop(BINS)))
    present = np.array(sorted(left), np.int64)
    ways = [c for c in combinations(present) if len(c) > 1]
    if ways:
        row = {b: i for i, b in enumerate(present.tolist())}
        a = np.zeros((len(present), len(ways)))
        for j, way in enumerate(ways):
            for b in way:
                a[row[b], j] += 1
        count = np.floor(nnls(a, np.array([left[b] for b in present.tolist()], float)) + 1e-6).astype(int)
        for j in np.argsort(-count, kind="stable"):
            n = min([int(count[j]), *(left[b] // ways[j].count(b) for b in set(ways[j]))])
            if n > 0:
                chosen.append((ways[j], n))
                for b in ways[j]:
                    left[b] -= n
    return chosen


def _running(df: DataFrame, keys: list[str], n: int, weight: str | None, name: str) -> DataFrame:
    """`df` with the sum of `weight` (1 if None) over the rows before, by `keys`, in an order that
    is a hash of uid and uid.

    Only uid, keys and weights are sorted, in groups of SLICE_ROWS or so whatever the key; the sums
    are then joined to the rows.
    """
    slices = min(max(1, n // SLICE_ROWS), MOST_SLICES)
    each = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    slim = df.select("uid", *keys, each.alias("_w"), F.pmod(F.xxhash64("uid"), F.lit(slices)).alias("_slice"))
    before = (Window.unboundedPreceding, -1)
    totals = slim.groupBy(*keys, "_slice").agg(F.sum("_w").alias("_total"))
    ahead = F.sum("_total").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(*before))  # a row per slice
    offsets = totals.withColumn("_offset", F.coalesce(ahead, F.lit(0))).drop("_total")
    inside = F.coalesce(F.sum("_w").over(Window.partitionBy(*keys, "_slice").orderBy("uid").rowsBetween(*before)), F.lit(0))
    placed = slim.withColumn("_inside", inside).join(offsets, [*keys, "_slice"])
    return df.join(placed.select("uid", (F.col("_offset") + F.col("_inside")).cast("long").alias(name)), "uid")


def _cut(rows: DataFrame) -> DataFrame:
    """The parts of left over rests that lie in one window each (`at`: first token's
    place among all that is left over)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in PLACED}
            for r in batch.to_pylist():
                marks, size, at = np.frombuffer(r["marks"], np.uint32), r["length"], r["at"]
                edges = [0] + [(k * GREEDY - at) // UNIT * UNIT for k in range(at // GREEDY + 1, (at + size - 1) // GREEDY + 1)] + [size]
                for w, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    if b > a:
                        whole = int(marks[-(-b // UNIT) - 1])
                        crc = crc_of_rest(whole, int(marks[a // UNIT - 1]), 4 * (b - a)) if a else whole
                        for name, x in zip(out, (r["doc_id"], r["start"] + a, b - a, crc, r["doc_tokens"], r["base"] + at // GREEDY + w, at + a), strict=True):
                            out[name].append(x)
            yield pack(out, PLACED)

    return map_arrow(rows, run, PLACED)


def packed(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence."""
    spark = docs.sparkSession
    pieces = written(tokenized(docs, path).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    histogram = {r["bin"]: r["count"] for r in pieces.groupBy("bin").count().collect()}  # at most BINS rows
    total = sum(histogram.values())
    slots, base, used = [], 0, dict.fromkeys(histogram, 0)
    for way, n in plan(histogram):
        for place, b in enumerate(way):
            slots.append((b, used[b], used[b] + n, base, place))
            used[b] += n
        base += n
    table = spark.createDataFrame(slots or [(-1, 0, 0, 0, 0)], "slot_bin long, low long, high long, base long, place long")
    ranked = _running(pieces, ["bin"], total, None, "rank")
    fits = (F.col("bin") == F.col("slot_bin")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    joined = ranked.join(F.broadcast(table), fits, "left")  # at most 3 * BINS rows
    columns = [f.name for f in PLACED]
    placed = joined.filter("low IS NOT NULL").withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("low")).select(*columns)
    rest = joined.filter("low IS NULL").select("uid", "doc_id", "start", "length", "doc_tokens", "marks", F.lit(base).cast("long").alias("base"))
    left = sum(n - used[b] for b, n in histogram.items())
    everything = placed.unionByName(_cut(_running(rest, [], left, "length", "at")))
    inside = Window.partitionBy("sequence_id").orderBy("place", "doc_id", "start").rowsBetween(Window.unboundedPreceding, -1)
    return everything.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).drop("place")
