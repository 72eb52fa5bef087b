"""Toxicity by compression distance: two zstandard dictionaries, one trained on
toxic and one on ordinary text, compress the same windows; where the toxic
dictionary gives the shorter output, the window is suspect.

A window is one word in a fixed carrier, in lower case. Both dictionaries end
with the same common part, trained on ordinary text, so that ordinary words cost
the same under either and a difference comes from what sets the classes apart.
Toxic samples are the words of toxic documents whose beginnings are far more
frequent there than in ordinary ones (`lift`). The weights that turn
counts of savings into a probability are calibrated on the sample.

The sample is bounded by parameters: `sample` labelled documents, those of the lowest hash of their
id, as far as `sample_bytes` of text go, and `ordinary_words` of the words of ordinary ones, evenly
taken. It leaves out documents whose crc32(id) mod 5 is 0. Scores use nothing but the text.

Defined results: null and empty texts have no suspect window and get the score
of such texts. Each input row gives one row. Without labels of both kinds
all scores are 0 and nothing is predicted toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.bytesops import Texts, chunks, pack, sums
from folia.llm.common import id_text, labelled_sample, map_arrow, remainder
from folia.llm.neardup import coordinates
from folia.llm.wordcache import WordCache

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_windows", pa.int64()), ("n_suspect", pa.int64()), ("most_saved", pa.int32())]
)
# A text both dictionaries hold, so that zstandard always finds something to
# compress and does not store a short word as it is.
CARRIER = (b"the sentence that goes before the word reads: ", b" ; and so ends whatever was said of it there.")
# Hundredths of a word saved.
LEVELS = (30, 40, 50, 60)
COORDINATES = 192  # of a signature that tells copies of a text
PUNCTUATION = b".,;:!?*#$%&|<>()[]{}\"'"


def _core(word: bytes) -> bytes:
    return word.strip(PUNCTUATION) or word


def _window(word: bytes) -> bytes:
    return CARRIER[0] + _core(word) + CARRIER[1]


@dataclass
class Classifier:
    """The two dictionaries, and weights of the logarithms of how many windows save
    at least so many hundredths (LEVELS), in all and per thousand."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: tuple[float, ...] = ()

    def savings(self) -> WordCache:
        """Hundredths of a word's bytes that its window saves under the toxic dictionary."""
        settings = zstandard.ZstdCompressionParameters(
            window_log=16, hash_log=13, chain_log=13, search_log=4, min_match=3, target_length=32, strategy=zstandard.STRATEGY_BTULTRA, write_content_size=0, write_dict_id=0, write_checksum=0
        )
        ordinary, toxic = (
            zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress
            for x in (self.ordinary, self.toxic)
        )
        return WordCache(lambda words: np.array([100 * (len(ordinary(_window(w))) - len(toxic(_window(w)))) // len(_core(w)) for w in words], np.int16), np.dtype(np.int16))

    def measures(self, t: Texts, cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
        """The saving of every window, and offsets by text."""
        low = t.lowered()
        starts, ends, offsets = low.word_spans
        return cache(low, starts, ends, low.hashes(starts, ends)), offsets

    def score(self, saved: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(offsets) - 1)
        return 1 / (1 + np.exp(-(_inputs(saved, offsets) @ np.array(self.weights))))


def _inputs(saved: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    windows = np.maximum(np.diff(offsets), 1)
    counts = [_by_text(saved >= level, offsets) for level in LEVELS]
    return np.stack([np.ones(len(windows)), *map(np.log1p, counts), *(np.log1p(1000 * c / windows) for c in counts)], 1)


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = sums(values)
    return total[offsets[1:]] - total[offsets[:-1]]


def _most(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.int32)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.maximum.reduceat(values.astype(np.int32), offsets[:-1][full])
    return out


def _beginnings(word: bytes) -> list[bytes]:
    return [word[:k] for k in range(4, min(len(word), 10) + 1)]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 200) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """What zstandard trains on the samples; the samples themselves if they are too few."""
    joined = b"".join(samples)
    if len(joined) <= size or len(samples) < 16:
        return joined[:size]
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return joined[-size:]


def _copies(signatures: np.ndarray, least: float = 0.8) -> np.ndarray:
    """For each text the first one that it is a copy of, exact or near, by the share of
    coordinates that agree; its own place if there is none."""
    heads, size = np.empty_like(signatures), 0
    places, out = np.empty(len(signatures), np.int64), np.empty(len(signatures), np.int64)
    for i, own in enumerate(signatures):
        agree = (heads[:size] == own).sum(1)
        best = int(agree.argmax()) if size else 0
        if size and agree[best] >= least * signatures.shape[1]:
            out[i] = places[best]
        else:
            heads[size], places[size], out[i] = own, i, i
            size += 1
    return out


def _learn(texts: list[tuple[bool, np.ndarray, int]], words: list[bytes], lift: float, size: int, ordinary_words: int) -> Classifier | None:
    """The dictionaries of labelled texts, given as places in a list of distinct words and
    the group of copies of a text, which counts once; None if nothing sets the classes apart."""
    seen, groups = (Counter(), Counter()), (set(), set())
    for y, own, group in texts:
        own = np.unique(own).tolist()
        if group not in groups[y]:
            groups[y].add(group)
            seen[y].update({g for i in own for g in _beginnings(words[i])})
    n = [max(len(x), 1) for x in groups]
    marks = {g for g, k in seen[1].items() if k >= lift * (e := n[1] * (seen[0][g] + 0.5) / n[0]) and k >= 4 + e + 4 * e**0.5}
    marked = np.array([any(g in marks for g in _beginnings(w)) for w in words], bool)
    toxic = np.concatenate([own[marked[own]] for y, own, _ in texts if y])
    ordinary = np.concatenate([own[~marked[own]] for y, own, _ in texts if not y])
    if not len(toxic):
        return None
    ordinary = ordinary[:: max(1, len(ordinary) // ordinary_words)]
    toxic, ordinary = ([CARRIER[0][-1:] + words[i] + CARRIER[1][:1] for i in x.tolist()] for x in (toxic, ordinary))
    common, frame, half = _dictionary(ordinary, 8 * size), b"".join(CARRIER), len(ordinary) // 2
    return Classifier(common + _dictionary(toxic, size) + frame, common + _dictionary(ordinary[half : half + len(toxic)] or ordinary, size) + frame)


def fit(values: list[tuple[str | None, int]], lift: float = 10.0, size: int = 2048, ordinary_words: int = 60_000) -> Classifier:
    """The classifier of labelled texts (label 1: toxic).

    Dictionaries of two thirds of the texts compress the other third, which
    gives the weights; the dictionaries that are kept learn from all texts.
    """
    label = np.array([y for _, y in values], bool)
    if not len(values) or label.all() or not label.any():
        return Classifier()
    column = pa.array([x for x, _ in values], pa.string())
    places: dict[bytes, int] = {}
    own: list[np.ndarray] = []
    signatures: list[np.ndarray] = []
    for t in chunks(column):
        low = t.lowered()
        starts, ends, offsets = low.word_spans
        data = low.data.tobytes()
        _, first, which = np.unique(low.hashes(starts, ends), return_index=True, return_inverse=True)
        spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
        which = np.array([places.setdefault(data[s:e].strip(PUNCTUATION), len(places)) for s, e in spans], np.int32)[which]
        signatures += [x.astype(np.uint32) for x, _ in coordinates(low, COORDINATES)]
        own += [which[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sign, group = np.concatenate(signatures), np.empty(len(label), np.int64)
    for y in (False, True):
        here = np.flatnonzero(label == y)
        group[here] = here[_copies(sign[here])]
    words, texts = list(places), list(zip(label.tolist(), own, group.tolist(), strict=True))
    found = _learn(texts, words, lift, size, ordinary_words)
    if found is None:
        return Classifier()
    aside = np.arange(len(values)) % 3 == 2
    taught = _learn([x for x, out in zip(texts, aside, strict=True) if not out], words, lift, size, ordinary_words) if 0 < label[aside].sum() < aside.sum() else None
    use = aside if taught else ~np.zeros_like(aside)
    judge = taught or found
    cache = judge.savings()
    inputs = [_inputs(*judge.measures(t, cache)) for t in chunks(column.filter(pa.array(use)))]
    x, y = np.concatenate(inputs), label[use]
    weights = _logistic(x, y)
    # The verdict falls where precision and recall are best together (F1), which
    # becomes score 0.5; with few toxic texts that is below a probability of one half.
    odds = x @ weights
    cuts = np.log(np.arange(0.2, 0.61, 0.05) / (1 - np.arange(0.2, 0.61, 0.05)))
    weights[0] -= max(cuts, key=lambda c: (2 * (y & (odds >= c)).sum() / max(y.sum() + (odds >= c).sum(), 1), c))
    found.weights = tuple(weights)
    return found


def fit_documents(docs: DataFrame, labels: DataFrame, sample: int = 5000, sample_bytes: int = 64 << 20) -> Classifier:
    """The classifier of at most `sample` labelled documents that are not held out, of which as many
    are taken as `sample_bytes` allow, by the hash of their ids."""
    rows = labelled_sample(docs, labels, "toxic", sample, remainder(5) != 0)
    sizes = rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).collect()
    total = np.cumsum([r["size"] for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"], r["size"]))])
    if len(total) and total[-1] > sample_bytes:
        inside = int(np.searchsorted(total, sample_bytes, "right"))
        rows = rows.filter(F.col("doc_id").isin([r["doc_id"] for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"], r["size"]))[:inside]]))
    found = rows.select("doc_id", "text", "label").collect()
    return fit([(r.text, r.label) for r in sorted(found, key=lambda r: (r.doc_id, r.text or ""))])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 5000) -> DataFrame:
    """Score and verdict of every document."""
    model = fit_documents(docs, labels, sample)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = model.savings()
        for batch in batches:
            for t in chunks(batch.column("text")):
                own = batch.slice(t.first, t.last - t.first)
                saved, offsets = model.measures(t, cache)
                score = model.score(saved, offsets)
                yield pack(
                    {"doc_id": own.column("doc_id"), "held_out": own.column("held_out"), "score": score, "predicted": (score >= 0.5).astype(np.int32), "n_windows": np.diff(offsets), "n_suspect": _by_text(saved >= LEVELS[1], offsets), "most_saved": _most(saved, offsets)},
                    SCHEMA,
                )

    return map_arrow(id_text(docs).withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(False))), judge, SCHEMA)


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = 5000, text_col: str = "text", train_on: DataFrame | None = None) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns. The labels
    are those of `train_on`, by default of `docs`."""
    model = fit_documents(docs if train_on is None else train_on, labels, sample)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = model.savings()
        for batch in batches:
            for t in chunks(batch.column(text_col)):
                saved, offsets = model.measures(t, cache)
                score = model.score(saved, offsets)
                yield batch.slice(t.first, t.last - t.first).filter(pa.array(score < 0.5))

    return docs.mapInArrow(keep, docs.schema)
