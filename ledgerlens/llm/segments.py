"""Token ids of texts by way of their distinct segments.

Texts repeat their words.  A segment is a stretch of text that the tokenizer never merges across;
each distinct segment is encoded once and texts are put together from the codes of theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain, islice, repeat

import numpy as np

#: Distinct segments, and ids of them, that a worker remembers; then it starts anew.
REMEMBERED, IDS = 100_000, 8_000_000


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each length, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Codes(dict):
    """Numbers new keys in order."""

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        return code


class SegmentCache:
    """Encodes lists of segments; ``encode_new`` gives flat ids and their number by segment."""

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], remembered: int | None = None):
        self.encode_new, self.remembered = encode_new, remembered
        self.clear()

    def clear(self) -> None:
        self.known = Codes()
        self.flat = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int64)

    def encode(self, texts: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the number of ids of each; a text is its segments."""
        return self._joined(self._codes(chain.from_iterable(texts)), np.array([len(t) for t in texts], np.int64))

    def encode_distinct(self, segments: Sequence[str], at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts of ``sizes`` segments, which ``at`` names by their places in
        ``segments``: these alone are looked up one by one, and none may repeat."""
        self._bound()
        known = self.known
        codes = np.fromiter(map(known.get, segments, repeat(-1)), np.int64, len(segments))
        at_new = np.flatnonzero(codes < 0)
        new = [segments[i] for i in at_new.tolist()]
        codes[at_new] = np.arange(len(known), len(known) + len(new))
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self._learn(new)
        return self._joined(codes[at], sizes)

    def _codes(self, segments: Iterable[str]) -> np.ndarray:
        self._bound()
        first = len(self.known)
        codes = np.fromiter(map(self.known.__getitem__, segments), np.int64)
        self._learn(list(islice(self.known, first, None)) if len(self.known) > first else [])
        return codes

    def _bound(self) -> None:
        if len(self.known) > (self.remembered or REMEMBERED) or len(self.flat) > IDS:
            self.clear()

    def _learn(self, new: list[str]) -> None:
        if new:
            flat, lengths = self.encode_new(new)
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.lengths = np.concatenate([self.lengths, lengths])

    def _joined(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(self.lengths) - self.lengths
        lengths = self.lengths[codes]
        ids = self.flat[ranges(starts[codes], lengths)]
        done = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(done[edges])
