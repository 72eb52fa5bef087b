"""Values of distinct words, kept by a task between chunks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from folia.llm.bytesops import U64, Texts


class WordCache:
    """Computes a small integer per distinct word once, and forgets all when full.

    What a word's value is depends on the word alone, so forgetting changes
    nothing but time; memory stays below `limit` words.
    """

    def __init__(self, value: Callable[[list[bytes]], np.ndarray], dtype: np.dtype, limit: int = 400_000):
        self.value, self.dtype, self.limit = value, dtype, limit
        self.keys, self.values = np.empty(0, U64), np.empty(0, dtype)

    def __call__(self, t: Texts, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The value of each word; words are the fingerprints of the spans."""
        if not len(words):
            return np.empty(0, self.dtype)
        distinct, first, inverse = np.unique(words, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[place] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        out = np.empty(len(distinct), self.dtype)
        if len(self.keys):
            out[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            data = t.data.tobytes()
            out[new] = self.value([data[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            if len(self.keys) + len(new) > self.limit:
                self.keys, self.values = np.empty(0, U64), np.empty(0, self.dtype)
            merged = np.concatenate((self.keys, distinct[new]))
            order = np.argsort(merged, kind="stable")
            self.keys, self.values = merged[order], np.concatenate((self.values, out[new]))[order]
        return out[inverse]
