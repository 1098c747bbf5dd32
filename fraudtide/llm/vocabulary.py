"""Numbers for the words that a task has seen, so that counting is done on arrays."""

from __future__ import annotations

import numpy as np


class _Seen(dict):
    """Numbers new keys as they are looked up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Numbers:
    """Words to 0, 1, … in the order of their first use."""

    def __init__(self, first: tuple[bytes, ...] = ()):
        self._seen = _Seen()
        self.of(list(first))

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._seen.__getitem__, words), dtype=np.int64, count=len(words))

    @property
    def words(self) -> list[bytes]:
        return list(self._seen)

    def __len__(self) -> int:
        return len(self._seen)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys in order, and the sums of each of the values over equal keys."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0] if len(key) else np.zeros(0, dtype=np.int64)
    return key[starts], *[np.add.reduceat(v[order], starts) if len(key) else v for v in values]
