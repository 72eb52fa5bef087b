"""Suffix-array dedup of repeated passages by a distributed merge sort that knows common
prefixes.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else. All
suffixes of a corpus are too many to exchange, so the sort runs over a sample of them that
finds every repeat: the anchors. The anchor of position p is the 8-byte string of least
hash (leftmost on ties) among those that start in [p, p + REACH]. It depends on the LENGTH
bytes at p alone, so two equal strings have their anchors at the same distance d from
their starts, and share at least LENGTH - REACH bytes from the anchor on.

1. Anchors whose first LENGTH - REACH bytes occur once are dropped: each anchor sends a
   fingerprint, copies within a batch are known at once and send one.
2. Every batch sorts the suffixes of its anchors (LENGTH bytes at most) and sends them as
   runs, front-coded: the length of the prefix shared with the one before, and the rest;
   beside it the bytes before the anchor. Runs are dealt out by the first LENGTH - REACH
   bytes, so what can be equal meets, and a frequent beginning is no range's burden.
   Contexts that are equal from end to end in a batch are known to repeat and send one.
3. Each task combines its runs by a loser tree. A contender keeps the prefix it shares with
   the last output; a longer one wins unseen, and only on equal ones bytes are compared,
   from there on. The merge gives the order and all common prefixes between neighbours.
4. For each distance d, neighbours that share LENGTH - d bytes form a segment; within one,
   equal last d bytes before the anchor are equal strings. These are exact but for 64-bit
   fingerprints of the bytes before an anchor.
5. The spans go back to the documents.

Defined results: null and empty texts have no bytes and lose none. Every input row is a
text of its own; repeated rows are copies and lose what they repeat. Ids are only carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.bytesops import U64, Texts, chunks, mix, pack, ranges
from folia.llm.common import located, map_arrow, partitions, written

LENGTH, REACH, KMER = 200, 150, 8
SURE = LENGTH - REACH
LONG, INT = pa.int64(), pa.int32()
ANCHORS = pa.schema([("print", LONG), ("file", LONG), ("row", LONG), ("at", LONG), ("span", INT), ("known", INT)])
PLACES = pa.schema([("file", LONG), ("row", LONG), ("at", LONG), ("span", INT)])
TEXTS = pa.schema([("file", LONG), ("row", LONG), ("doc_id", LONG), ("packed", pa.binary())])
RUNS = pa.schema([("part", LONG), ("known", INT), ("run", pa.binary())])
SPANS = pa.schema([("file", LONG), ("row", LONG), ("start", LONG), ("end", LONG)])
RESULT = pa.schema([("doc_id", LONG), ("n_bytes", LONG), ("n_removed", LONG), ("n_spans", LONG), ("kept_sha256", pa.string())])


def anchors(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all anchors, and the least and largest distance to a start they serve."""
    n = len(t.data)
    size = np.diff(t.offsets)
    starts = np.maximum(size - LENGTH + 1, 0)
    p = ranges(t.offsets[:-1], starts)
    none = np.empty(0, np.int64)
    if not len(p):
        return none, none, none
    m = n - KMER + 1
    codes = np.empty(m, U64)
    for j in range(KMER):
        count = (m - j + KMER - 1) // KMER
        if count > 0:
            codes[j::KMER] = t.data[j : j + KMER * count].copy().view("<u8")
    keys = (mix(codes) >> U64(32) << U64(32)) | np.arange(m, dtype=U64)
    wide = REACH + 1
    blocks = -(-m // wide)
    padded = np.full(blocks * wide, U64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = keys
    table = padded.reshape(blocks, wide)
    ahead = np.minimum.accumulate(table, 1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].reshape(-1)
    at = (np.minimum(behind[p], ahead[p + REACH]) & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(p), bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return at[first], at[first] - p[last], at[first] - p[first]


def _mapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of all anchors; what a batch has twice is known to repeat."""
    for batch in batches:
        file, row = batch.column("file").to_numpy(), batch.column("row").to_numpy()
        parts = []
        for t in chunks(batch.column("text")):
            at, low, high = anchors(t)
            owner = np.searchsorted(t.offsets, at, "right") - 1
            parts.append((t.hashes(at, at + SURE).view(np.int64), owner + t.first, at - t.offsets[owner], low * 256 + high))
        if not parts:
            continue
        prints, owner, at, span = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, first, inverse, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        known = np.where(count[inverse] > 1, 1, 0)
        known[first] *= 2
        yield pack({"print": prints, "file": file[owner], "row": row[owner], "at": at, "span": span, "known": known}, ANCHORS)


def _surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose fingerprint occurs twice, in a partition that has all of each."""
    columns = [[c.to_numpy() for c in b.columns[:6]] for b in batches]
    if not columns:
        return
    prints, file, row, at, span, known = (np.concatenate(x) for x in zip(*columns, strict=True))
    told = known == 1
    weight = np.where(told, 0, np.where(known == 2, 2, 1))
    _, inverse = np.unique(prints, return_inverse=True)
    stay = np.flatnonzero(told | (np.bincount(inverse, weight)[inverse] > 1))
    for a in range(0, len(stay), 100_000):
        own = stay[a : a + 100_000]
        yield pack({"file": file[own], "row": row[own], "at": at[own], "span": span[own]}, PLACES)


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        own = [squeeze((x or "").encode()) for x in batch.column("text").to_pylist()]
        yield pack({"file": batch.column("file"), "row": batch.column("row"), "doc_id": batch.column("doc_id"), "packed": own}, TEXTS)


def shared(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, from a known part of it on."""
    n = min(len(a), len(b))
    while known < n:
        x, y = a[known : known + 32], b[known : known + 32]
        if x != y:
            for i in range(min(len(x), len(y))):
                if x[i] != y[i]:
                    return known + i
            return known + min(len(x), len(y))
        known += 32
    return n


def front_code(suffixes: list[bytes]) -> tuple[list[int], bytes]:
    """Of sorted strings: shared prefixes with the one before, and all that is new."""
    prefix = [0] + [shared(a, b, 0) for a, b in zip(suffixes[:-1], suffixes[1:], strict=True)] if suffixes else []
    return prefix, b"".join(s[k:] for s, k in zip(suffixes, prefix, strict=True))


def front_decode(prefix: list[int], sizes: list[int], new: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for k, n in zip(prefix, sizes, strict=True):
        last = last[:k] + new[at : at + n - k]
        at += n - k
        out.append(last)
    return out


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Combines sorted runs (strings, shared prefixes with the one before) by a loser tree.

    Yields (run, place in it, prefix shared with the output before). `prefix[r]` is what
    run r's next string shares with the last output, or with the winner that it lost to.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    within = [r[1] for r in runs] + [[]] * (k - len(runs))
    place, prefix = [0] * k, [0] * k

    def better(a: int, b: int) -> int:
        """The run whose string comes first; the other's prefix becomes that with it."""
        if place[a] >= len(strings[a]):
            return b
        if place[b] >= len(strings[b]):
            return a
        if prefix[a] != prefix[b]:
            return a if prefix[a] > prefix[b] else b
        x, y = strings[a][place[a]], strings[b][place[b]]
        h = shared(x, y, prefix[a])
        if h == len(x) or (h < len(y) and x[h] < y[h]):
            prefix[b] = h
            return a
        prefix[a] = h
        return b

    loser = [0] * k
    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        winners = []
        for i in range(node):
            a, b = level[2 * i], level[2 * i + 1]
            won = better(a, b)
            loser[node + i] = b if won == a else a
            winners.append(won)
        level = winners
    top = level[0]
    while place[top] < len(strings[top]):
        yield top, place[top], prefix[top]
        place[top] += 1
        if place[top] < len(strings[top]):
            prefix[top] = within[top][place[top]]
        at = (top + k) // 2
        while at:
            won = better(top, loser[at])
            if won != top:
                top, loser[at] = won, top
            at //= 2


def _blob(**arrays: np.ndarray | bytes) -> bytes:
    """Named arrays as one compressed value."""
    columns = {k: [v if isinstance(v, bytes) else np.ascontiguousarray(v).tobytes()] for k, v in arrays.items()}
    sink = pa.BufferOutputStream()
    table = pa.table({k: pa.array(v, pa.large_binary()) for k, v in columns.items()})
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _unblob(raw: bytes) -> dict[str, bytes]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw)).read_all()
    return {k: table.column(k)[0].as_py() for k in table.column_names}


def _running(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each batch's suffixes as sorted runs, one per part, and the spans known at once."""
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            file, row = batch.column("file").to_numpy(), batch.column("row").to_numpy()
            texts = pa.array([unpack(x).decode() for x in batch.column("packed").to_pylist()], pa.string())
            places, spans = batch.column("places"), batch.column("spans")
            entries: list[tuple[bytes, bytes, int, int, int, int]] = []  # right, left, span, file, row, at
            part: list[np.ndarray] = []
            for t in chunks(texts):
                data = t.data.tobytes()
                at_all = []
                for i in range(t.size):
                    a, b = int(t.offsets[i]), int(t.offsets[i + 1])
                    own_file, own_row = int(file[t.first + i]), int(row[t.first + i])
                    for at, span in zip(places[t.first + i].as_py(), spans[t.first + i].as_py(), strict=True):
                        x = a + at
                        entries.append((data[x : min(x + LENGTH, b)], data[x - (span & 255) : x], span, own_file, own_row, at))
                        at_all.append(x)
                here = np.array(at_all, np.int64)
                part.append((t.hashes(here, here + SURE) % U64(parts)).astype(np.int64) if len(here) else here)
            part_of = np.concatenate(part) if part else np.empty(0, np.int64)
            order = sorted(range(len(entries)), key=lambda i: (part_of[i], entries[i][:3]))
            kept, twice, told = [], [], []
            i = 0
            while i < len(order):
                j = i + 1
                while j < len(order) and entries[order[j]][:3] == entries[order[i]][:3] and part_of[order[j]] == part_of[order[i]]:
                    j += 1
                kept.append(order[i])
                twice.append(j - i > 1)
                told += order[i:j] if j - i > 1 else []
                i = j
            if told:
                own = [entries[i] for i in told]
                yield pack({"part": [hash((own[0][3], own[0][4])) % parts], "known": [1], "run": [_blob(**_spans_of(own))]}, RUNS)
            edges = np.flatnonzero(np.diff(part_of[kept])) + 1 if kept else []
            for a, b in zip([0, *edges], [*edges, len(kept)], strict=True):
                own = [entries[i] for i in kept[a:b]]
                if not own:
                    continue
                prefix, new = front_code([e[0] for e in own])
                blob = _blob(
                    prefix=np.array(prefix, np.uint8), size=np.array([len(e[0]) for e in own], np.uint8), new=new, left=b"".join(e[1] for e in own),
                    twice=np.array(twice[a:b], np.uint8), span=np.array([e[2] for e in own], np.int32),
                    file=np.array([e[3] for e in own], np.int64), row=np.array([e[4] for e in own], np.int64), at=np.array([e[5] for e in own], np.int64),
                )
                yield pack({"part": [int(part_of[kept[a]])], "known": [0], "run": [blob]}, RUNS)

    return run


def _spans_of(entries: list[tuple]) -> dict[str, np.ndarray]:
    span, at = np.array([e[2] for e in entries], np.int64), np.array([e[5] for e in entries], np.int64)
    return {"file": np.array([e[3] for e in entries], np.int64), "row": np.array([e[4] for e in entries], np.int64), "start": at - (span & 255), "end": at - (span >> 8) + LENGTH}


def repeated(prefix: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Which distances of each suffix are starts of repeated strings.

    Suffixes are sorted; prefix is shared with the one before; left holds the bytes before
    the anchor, nearest first; low and high bound the distances of each.
    """
    n = len(prefix)
    out = np.zeros((n, REACH + 1), bool)
    code = np.zeros(n, U64)
    for d in range(REACH + 1):
        if d:
            code = code * U64(0x9E3779B97F4A7C15) + left[:, d - 1] + U64(1)
        on = np.flatnonzero((low <= d) & (d <= high))
        if len(on):
            segment = np.cumsum(prefix < LENGTH - d)[on].astype(U64)
            _, inverse = np.unique(mix(mix(code[on]) ^ (segment * U64(0xD6E8FEB86659FD93))), return_inverse=True)
            out[on, d] = np.bincount(inverse, 1 + twice[on])[inverse] > 1
    return out


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of repeated strings, from all runs of a partition."""
    runs, columns = [], []
    for batch in batches:
        for known, raw in zip(batch.column("known").to_pylist(), batch.column("run").to_pylist(), strict=True):
            b = _unblob(raw)
            if known:
                yield pack({k: np.frombuffer(b[k], np.int64) for k in ("file", "row", "start", "end")}, SPANS)
                continue
            prefix, size = np.frombuffer(b["prefix"], np.uint8), np.frombuffer(b["size"], np.uint8)
            runs.append((front_decode(prefix.tolist(), size.tolist(), b["new"]), prefix.tolist()))
            span = np.frombuffer(b["span"], np.int32).astype(np.int64)
            wide = span & 255
            bytes_before = np.zeros((len(span), REACH), np.uint8)
            flat = np.frombuffer(b["left"], np.uint8)
            ends = np.cumsum(wide)
            rows = np.repeat(np.arange(len(span)), wide)
            bytes_before[rows, np.repeat(ends, wide) - 1 - np.arange(len(flat))] = flat
            columns.append((bytes_before, span, np.frombuffer(b["twice"], np.uint8).astype(np.int64), *(np.frombuffer(b[k], np.int64) for k in ("file", "row", "at"))))
    if not runs:
        return
    base = np.concatenate(([0], np.cumsum([len(r[0]) for r in runs])))
    merged = list(merge(runs))
    place = np.array([base[r] + i for r, i, _ in merged], np.int64)
    prefix = np.array([h for _, _, h in merged], np.int64)
    del runs, merged
    left, span, twice, file, row, at = (np.concatenate(x)[place] for x in zip(*columns, strict=True))
    del columns
    marks = repeated(prefix, left, span >> 8, span & 255, twice)
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    i, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)  # runs of distances come in the same order
    for a in range(0, len(i), 100_000):
        own = slice(a, a + 100_000)
        k = i[own]
        yield pack({"file": file[k], "row": row[k], "start": at[k] - (last[own] - 1), "end": at[k] - first[own] + LENGTH}, SPANS)


def _cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out: dict[str, list] = {f.name: [] for f in RESULT}
        for doc, packed, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "starts", "ends")), strict=True):
            text, kept, at, removed, spans = unpack(packed), [], 0, 0, 0
            stop = -1  # where the last removed span ends
            for a, b in sorted(zip(starts or [], ends or [], strict=True)):
                if a > stop:
                    kept.append(text[at:a])
                    spans += 1
                    removed += b - a
                    at = stop = b
                elif b > stop:
                    removed += b - stop
                    at = stop = b
            kept.append(text[at:])
            for name, x in zip(out, (doc, len(text), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                out[name].append(x)
        yield pack(out, RESULT)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(file, row, start, end) of all repeated stretches; they may overlap."""
    parts = partitions(docs.sparkSession)
    found = map_arrow(located(docs, F.col("text").cast("string").alias("text")), _mapping, ANCHORS)
    where = F.when(F.col("known") == 1, F.xxhash64("row", "at")).otherwise(F.col("print"))
    alive = map_arrow(found.repartition(parts, where), _surviving, PLACES)
    both = F.array_sort(F.collect_list(F.struct("at", "span")))
    lists = alive.groupBy("file", "row").agg(both.alias("b")).select("file", "row", F.col("b.at").alias("places"), F.col("b.span").alias("spans"))
    texts = map_arrow(_texts(docs), _packing, TEXTS).drop("doc_id")
    runs = map_arrow(texts.join(lists, ["file", "row"]), _running(parts), RUNS)
    return map_arrow(runs.repartition(parts, "part"), _merging, SPANS)


def _texts(docs: DataFrame) -> DataFrame:
    return located(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: its bytes, those removed, in how many runs, and what stays."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs, "located")
    spans = written(repeated_spans(docs), "spans")
    lists = spans.groupBy("file", "row").agg(F.collect_set(F.struct("start", "end")).alias("s")).select("file", "row", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
    joined = map_arrow(_texts(docs), _packing, TEXTS).join(lists, ["file", "row"], "left")
    return map_arrow(joined, _cutting, RESULT)
