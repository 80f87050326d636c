"""Index arithmetic for ragged numpy arrays."""

from __future__ import annotations

import numpy as np


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. counted anew in each group of the given lengths."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def spread(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions offset, offset + 1, .. of every group in turn."""
    return np.repeat(offsets, lengths) + within(lengths)


class Pool:
    """Arrays of one type kept end to end; number k lies at ``start[k]`` with ``size[k]`` items."""

    def __init__(self, dtype):
        self.items, self.start, self.size = np.empty(1 << 16, dtype), np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.used = self.count = 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(values) > len(self.items):
            self.items = np.concatenate([self.items[: self.used], np.empty(self.used + 2 * len(values), self.items.dtype)])
        if self.count + len(sizes) > len(self.size):
            more = np.empty(self.count + 2 * len(sizes), np.int64)
            self.start = np.concatenate([self.start[: self.count], more])
            self.size = np.concatenate([self.size[: self.count], more])
        self.items[self.used : self.used + len(values)] = values
        self.size[self.count : self.count + len(sizes)] = sizes
        self.start[self.count : self.count + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(values)
        self.count += len(sizes)

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return self.items[spread(self.start[numbers], self.size[numbers])]
