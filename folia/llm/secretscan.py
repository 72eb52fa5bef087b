"""Secret scans: fixed patterns, and a linear-chain conditional random field that
tags words as beginning a secret, inside one, or outside (decoded by Viterbi).

Features of a word are its shape (length and kinds of characters), its own and its
neighbours' text, hashed, and what the document is like (share of digits, assignments).
The field learns from a bounded sample of documents (`sample`, by the lowest hash of
the id; a parameter) in which the words of pattern matches are the tags. What it tags
beyond the patterns is a span of kind crf, if it holds SECRET_LENGTH or more characters
of the secret alphabet in one run, with a digit and a letter; base spans always stay.

A chain is a line, as no secret here spans one. Defined results: null and empty texts
have no spans. Each input row gives one row, with repeated and null ids as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm import crf
from folia.llm.bytesops import U64, Texts, chunks, mix, pack, sums
from folia.llm.common import id_text, map_arrow
from folia.llm.spans import Span, digest, found, joined, runs

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
# Fixed patterns of the contract.
ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
RUN = re.compile(rb"[A-Za-z0-9+/_=-]+")
SECRET_LENGTH = 16
TABLE = 1 << 13
N_FEATURES = 8 * TABLE
LONG = pa.int64()
SCHEMA = pa.schema([("doc_id", LONG), ("n_assign", LONG), ("n_access", LONG), ("n_hex", LONG), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_crf", LONG)])
SAMPLE_SCHEMA = pa.schema([("line", LONG), ("features", pa.binary()), ("labels", pa.binary())])


def _is(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


DIGIT, UPPER, LOWERCASE = _is((48, 57)), _is((65, 90)), _is((97, 122))
HEXDIGIT, ASSIGNMENT, WIDE = _is((48, 57), (97, 102)), _is((58, 58), (61, 61)), _is((128, 255))


def base_spans(t: Texts) -> list[list[Span]]:
    """Spans of the fixed patterns in each text."""
    data = t.data
    letter = np.zeros(len(data), bool)
    for i, x in enumerate(b"AKIA"):
        part = np.zeros(len(data), bool)
        part[: max(len(data) - i, 0)] = data[i:] == x
        letter = part if i == 0 else letter & part
    kinds = [
        ("assign", ASSIGN, ASSIGNMENT[data], lambda m: len(m[2]) >= 12),
        ("access", ACCESS, letter, lambda m: m.end() - m.start() >= 18),
        ("hex", HEX, runs(HEXDIGIT[data], 16), lambda m: m.end() - m.start() >= 16),
    ]
    return found(t, kinds)


def features(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of each word's active features, and offsets of the lines' words."""
    starts, ends, _ = t.word_spans
    line_starts, line_ends, line_offsets = t.line_spans
    words = t.hashes(starts, ends)
    chain = np.concatenate((np.searchsorted(starts, line_starts), [len(starts)]))

    def share(kind: np.ndarray) -> np.ndarray:
        total = sums(kind[t.data])
        return total[ends] - total[starts]

    size = ends - starts
    digit, upper, lower, wide = share(DIGIT), share(UPPER), share(LOWERCASE), share(WIDE)
    other = size - digit - upper - lower - wide
    length = np.searchsorted([2, 4, 8, 12, 16, 20, 28, 40, 64], size)

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x == 0, 0, np.where(3 * x < size, 1, np.where(x < size, 2, 3)))

    shape = (((length * 4 + part(digit)) * 4 + part(upper)) * 4 + part(lower)) * 4 + np.minimum(other, 3)
    shape = shape.astype(U64) * U64(2) + (wide > 0)
    # What the document is like: how much of it is digits, and how many assignments.
    doc = np.searchsorted(t.offsets, starts, "right") - 1
    digits, assigns = sums(DIGIT[t.data]), sums(ASSIGNMENT[t.data])
    span = np.maximum(np.diff(t.offsets), 1)
    kind = np.minimum((200 * (digits[t.offsets[1:]] - digits[t.offsets[:-1]])) // span, 7) * 4 + np.minimum(assigns[t.offsets[1:]] - assigns[t.offsets[:-1]], 3)

    def beside(values: np.ndarray, step: int) -> np.ndarray:
        """The value `step` words on in the same line; 0 beyond it."""
        out = np.zeros_like(values)
        line = np.repeat(np.arange(len(chain) - 1), np.diff(chain))
        if step < 0:
            same = line[:step] == line[-step:] if len(line) > -step else np.empty(0, bool)
            out[-step:][same] = values[:step][same]
        else:
            same = line[step:] == line[:-step] if len(line) > step else np.empty(0, bool)
            out[:-step][same] = values[step:][same]
        return out

    shaped, long = mix(shape + U64(1)), (size >= 12).astype(U64)
    # A long word is known by its shape alone: its text would only be learned by heart.
    words = np.where(long > 0, shaped, words)
    rows = [
        words,
        shaped,
        beside(words, -1),
        beside(words, -2),
        beside(words, 1),
        mix(beside(shaped, -1) + shape),
        mix(beside(words, -1) ^ mix(length.astype(U64) + U64(7))),
        mix(kind[doc].astype(U64) * U64(2) + long + U64(11)),
    ]
    index = np.stack([(x % U64(TABLE)).astype(np.int32) + j * TABLE for j, x in enumerate(rows)], 1)
    return index, chain


def _tags(t: Texts, spans: list[list[Span]]) -> np.ndarray:
    """The labels of all words: those that base spans touch begin a secret or go on.
    Of an assignment the last word is the value."""
    starts, ends, offsets = t.word_spans
    labels = np.zeros(len(starts), np.int64)
    points = t.code_points
    for text, own in enumerate(spans):
        if own:
            first = points[starts[offsets[text] : offsets[text + 1]]] - points[t.offsets[text]]
            last = points[ends[offsets[text] : offsets[text + 1]]] - points[t.offsets[text]]
            for _, kind, a, b in own:
                hit = np.flatnonzero((last > a) & (first < b)) + offsets[text]
                hit = hit[-1:] if kind == "assign" else hit
                labels[hit], labels[hit[1:]] = BEGIN, INSIDE
    return labels


def fit_words(docs: DataFrame, sample: int = 6000, lines: int = 6000) -> crf.Model:
    """The field, trained on lines of at most `sample` documents: of those lines, at most
    `lines` with a secret and `lines` without."""
    chosen = id_text(docs).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                index, chain = features(t)
                labels = _tags(t, base_spans(t)).astype(np.int8)
                keys = t.hashes(*t.line_spans[:2]).view(np.int64)
                rows = [(int(k), index[a:b].tobytes(), labels[a:b].tobytes()) for k, a, b in zip(keys, chain[:-1], chain[1:], strict=True) if b > a]
                yield pack({f.name: [r[i] for r in rows] for i, f in enumerate(SAMPLE_SCHEMA)}, SAMPLE_SCHEMA)

    seen = map_arrow(id_text(docs).join(F.broadcast(chosen.distinct()), "doc_id"), run, SAMPLE_SCHEMA)
    # Equal lines of documents of several kinds have other features; the least stand for them.
    seen = seen.groupBy("line").agg(F.min(F.struct("features", "labels")).alias("least")).select("line", "least.*")
    has = F.instr(F.hex("labels"), "01") > 0
    ranked = seen.filter(has).orderBy("line").limit(lines).unionByName(seen.filter(~has).orderBy("line").limit(lines))
    rows = sorted(ranked.collect(), key=lambda r: r.line)
    each = [np.frombuffer(bytes(r.features), np.int32).reshape(-1, 8) for r in rows]
    labels = [np.frombuffer(bytes(r.labels), np.int8) for r in rows]
    if not any((x == BEGIN).any() for x in labels):
        return crf.Model(np.zeros((N_FEATURES, 3), np.float32), np.zeros((3, 3)))
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in each])))
    return crf.fit(np.concatenate(each), np.concatenate(labels).astype(np.int64), offsets, 3, N_FEATURES, steps=40)


def tagged_spans(t: Texts, model: crf.Model) -> list[list[Span]]:
    """What the field tags, as spans of the longest run of secret characters."""
    out: list[list[Span]] = [[] for _ in range(t.size)]
    index, chain = features(t)
    labels = model.decode(model.sparse(index), chain) if len(index) else np.empty(0, np.uint8)
    starts, ends, offsets = t.word_spans
    line = np.repeat(np.arange(len(chain) - 1), np.diff(chain))
    begin = np.flatnonzero((labels != OUTSIDE) & ((labels == BEGIN) | np.concatenate(([True], (labels[:-1] == OUTSIDE) | (line[:-1] != line[1:])))[: len(labels)]))
    for w in begin.tolist():
        stop = w + 1
        while stop < len(labels) and labels[stop] == INSIDE and line[stop] == line[w]:
            stop += 1
        raw, first = t.raw(starts[w], ends[stop - 1]), int(starts[w])
        m = max(RUN.finditer(raw), key=lambda m: m.end() - m.start(), default=None)
        if m and m.end() - m.start() >= SECRET_LENGTH and re.search(rb"[0-9]", m[0]) and re.search(rb"[A-Za-z]", m[0]):
            text = int(np.searchsorted(offsets, w, "right") - 1)
            base = t.code_points[t.offsets[text]]
            out[text].append((3, "crf", int(t.code_points[first + m.start()] - base), int(t.code_points[first + m.end()] - base)))
    return out


def secrets(docs: DataFrame, sample: int = 6000) -> DataFrame:
    """All spans of every document; those the patterns find, and what the field adds."""
    model = fit_words(docs, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                base, more = base_spans(t), tagged_spans(t, model)
                more = [[s for s in new if not any(s[2] < b and a < s[3] for _, _, a, b in old)] for old, new in zip(base, more, strict=True)]
                count = {f"n_{k}": [sum(s[1] == k for s in own) for own in base] for k in KINDS[:3]}
                yield pack(
                    count
                    | {
                        "doc_id": batch.column("doc_id").slice(t.first, t.last - t.first),
                        "base_sha256": [digest(x, True) for x in base],
                        "spans": [joined(x + y, True) for x, y in zip(base, more, strict=True)],
                        "n_crf": [len(x) for x in more],
                    },
                    SCHEMA,
                )

    return map_arrow(id_text(docs), run, SCHEMA)
