"""Spans in texts: leftmost matches of fixed patterns, and how they are written.

Patterns run only where they can match: kinds hold no white space but the space,
so a line without the kind's needed characters is passed over. Matches are those
of the pattern over the whole text, since none spans a line break.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np

from folia.llm.bytesops import Texts

Span = tuple[int, str, int, int]  # place of the kind, kind, start, end


def lines_with(t: Texts, hit: np.ndarray) -> Iterator[tuple[int, int, str]]:
    """(text, first byte, line) of the lines that hold a marked byte."""
    starts, ends, offsets = t.line_spans
    at = np.unique(np.searchsorted(starts, np.flatnonzero(hit), "right") - 1)
    owner = np.searchsorted(offsets, at, "right") - 1
    for line, text in zip(at.tolist(), owner.tolist(), strict=True):
        yield text, int(starts[line]), t.raw(starts[line], ends[line]).decode()


def found(t: Texts, kinds: list[tuple[str, re.Pattern, np.ndarray, Callable[[re.Match], bool]]]) -> list[list[Span]]:
    """Spans of each text in code points: (kind, pattern, marked bytes, test)."""
    out: list[list[Span]] = [[] for _ in range(t.size)]
    for place, (kind, pattern, hit, test) in enumerate(kinds):
        for text, first, line in lines_with(t, hit):
            base = int(t.code_points[first] - t.code_points[t.offsets[text]])
            out[text] += [(place, kind, base + m.start(), base + m.end()) for m in pattern.finditer(line) if test(m)]
    return out


def joined(spans: list[Span], by_start: bool) -> str:
    order = sorted(spans, key=(lambda s: (s[2], s[0], s[3])) if by_start else (lambda s: (s[0], s[2], s[3])))
    return ",".join(f"{kind}:{start}:{end}" for _, kind, start, end in order)


def digest(spans: list[Span], by_start: bool) -> str:
    return hashlib.sha256(joined(spans, by_start).encode()).hexdigest()


def runs(mask: np.ndarray, least: int) -> np.ndarray:
    """Marks the first byte of every run of at least `least` marked bytes."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(len(mask), bool)
    out[start[end - start >= least]] = True
    return out
