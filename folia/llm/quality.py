"""Quality rules: a conditional random field labels the lines of a document as
content or boilerplate; the share of words in content lines decides.

The field is trained on a bounded sample of documents with a quality label
(`sample`, 2,000 by default, a parameter). A line has no label of its own, so
training starts from the document's label, decodes the lines of the poor
documents with that first model, and trains once more on the decoded lines.

Defined results: null and empty texts have one empty line, no words and fail
the base rule. Every input row gives one row, repeated or null ids included.
Without labels of both kinds every line counts as content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folia.llm import crf
from folia.llm.bytesops import SPACE, U64, Texts, chunks, mix, pack, sums, window_hashes
from folia.llm.common import id_text, labelled_sample, map_arrow

CONTENT, BOILERPLATE = 0, 1
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LONG = pa.int64()
SCHEMA = pa.schema(
    [("doc_id", LONG), ("n_words", LONG), ("word_chars", LONG), ("n_symbols", LONG), ("n_dup_lines", LONG), ("n_repeat_words", LONG), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64()), ("n_lines", LONG), ("n_boilerplate_lines", LONG)]
)
SAMPLE_SCHEMA = pa.schema([("doc_id", LONG), ("label", pa.int32()), ("features", pa.binary())])


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = sums(values)
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Whether a line equals an earlier one of its text, and its number of words."""
    starts, ends, offsets = t.line_spans
    words = t.word_spans[0]
    n_words = np.searchsorted(words, ends) - np.searchsorted(words, starts)
    key = mix(t.hashes(starts, ends) ^ mix(np.repeat(np.arange(t.size, dtype=U64), np.diff(offsets)) + U64(1)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return again, n_words


def repeated_words(t: Texts, words: np.ndarray, offsets: np.ndarray, width: int = 5) -> np.ndarray:
    """Words of each text in windows of `width` words that occur twice or more in it."""
    full = np.diff(offsets) >= width
    key, at, window_offsets = window_hashes(words, offsets, width)
    owner = np.repeat(np.arange(t.size), np.diff(window_offsets))
    key = mix(key ^ mix(owner.astype(U64) + U64(1)))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    hit = np.zeros(len(key), bool)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = (twice[place] == key) & full[owner]
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, at[hit], 1)
    np.add.at(step, at[hit] + width, -1)
    return _by_text(np.cumsum(step)[:-1] > 0, offsets)


def line_features(t: Texts, again: np.ndarray, n_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What a line looks like: shares of kinds of characters, length, repetition, place."""
    starts, ends, offsets = t.line_spans
    data = t.data
    size = np.maximum(ends - starts, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = sums(mask)
        return (total[ends] - total[starts]) / size

    upper = share((data >= 65) & (data <= 90))
    lower = share((data >= 97) & (data <= 122))
    symbol = share(SYMBOLS[data])
    digit = share((data >= 48) & (data <= 57))
    mark = share((data == 33) | (data == 63))
    stop = share((data == 46) | (data == 44))
    wide = share(data >= 128)
    # Words that occurred before in the same line.
    line_of = np.searchsorted(starts, t.word_spans[0], "right") - 1
    _, first = np.unique(mix(words ^ mix(line_of.astype(U64))), return_index=True)
    fresh = np.bincount(line_of[first], minlength=len(starts))
    repeats = 1 - fresh / np.maximum(n_words, 1)
    place = np.zeros(len(starts), bool)
    place[offsets[:-1]] = True
    number = [upper, lower, symbol, digit, mark, stop, wide, repeats]
    flag = [n_words == 0, n_words < 4, n_words > 40, symbol > 0.05, upper > 0.3, mark > 0.05, repeats > 0.5, again & (n_words > 0), place, np.ones(len(starts), bool)]
    return np.stack([*number, *flag], 1).astype(np.float32)


def measures(t: Texts) -> dict[str, np.ndarray]:
    """The base columns of each text, and the features of its lines."""
    word_starts, word_ends, offsets = t.word_spans
    words = t.hashes(word_starts, word_ends)
    again, line_words = repeated_lines(t)
    line_offsets = t.line_spans[2]
    n_words = np.diff(offsets)
    n_repeat = repeated_words(t, words, offsets)
    return {
        "n_words": n_words,
        "word_chars": _by_text(~SPACE[t.data] & ((t.data & 0xC0) != 0x80), t.offsets),
        "n_symbols": _by_text(SYMBOLS[t.data], t.offsets),
        "n_dup_lines": _by_text(again & (line_words > 0), line_offsets),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < 10) | (100 * n_repeat > 20 * n_words),
        "line_words": line_words,
        "features": line_features(t, again, line_words, words),
    }


def fit_lines(docs: DataFrame, labels: DataFrame, sample: int = 2000, label: str = "quality") -> crf.Model:
    """The field, trained on at most `sample` labelled documents (label 1: good)."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                own = batch.slice(t.first, t.last - t.first)
                features, offsets = measures(t)["features"], t.line_spans[2]
                rows = [features[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pack({"doc_id": own.column("doc_id"), "label": own.column("label"), "features": rows}, SAMPLE_SCHEMA)

    rows = sorted(map_arrow(labelled_sample(docs, labels, label, sample), lines, SAMPLE_SCHEMA).collect(), key=lambda r: (r.doc_id, bytes(r.features)))
    width = line_features(*_nothing()).shape[1]
    good = np.array([r.label == 1 for r in rows], bool)
    if not len(rows) or good.all() or not good.any():
        return crf.Model(np.zeros((width, 2), np.float32), np.zeros((2, 2)))
    each = [np.frombuffer(bytes(r.features), np.float32).reshape(-1, width) for r in rows]
    features, offsets = np.concatenate(each).astype(np.float64), np.concatenate(([0], np.cumsum([len(x) for x in each])))
    of_good = np.repeat(good, np.diff(offsets))
    first = crf.fit(features, np.where(of_good, CONTENT, BOILERPLATE), offsets, 2)
    decoded = first.decode(first.dense(features), offsets)
    return crf.fit(features, np.where(of_good, CONTENT, decoded).astype(np.int64), offsets, 2)


def _nothing():
    t = Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    return t, np.empty(0, bool), np.empty(0, np.int64), np.empty(0, U64)


def quality(docs: DataFrame, labels: DataFrame, least_content: float = 0.5, sample: int = 2000) -> DataFrame:
    """Base measures and the verdict per document.

    A document is kept if the base rule passes and at least `least_content` of
    its words lie in lines decoded as content.
    """
    model = fit_lines(docs, labels, sample)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                m = measures(t)
                offsets = t.line_spans[2]
                content = model.decode(model.dense(m["features"]), offsets) == CONTENT
                share = _by_text(m["line_words"] * content, offsets) / np.maximum(m["n_words"], 1)
                m |= {
                    "doc_id": batch.column("doc_id").slice(t.first, t.last - t.first),
                    "kept": ~m["base_failed"] & (share >= least_content),
                    "content_share": share,
                    "n_lines": np.diff(offsets),
                    "n_boilerplate_lines": _by_text(~content, offsets),
                }
                yield pack(m, SCHEMA)

    return map_arrow(id_text(docs), judge, SCHEMA)
