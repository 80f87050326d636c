"""Token ids of texts, tokenizing each distinct piece once per task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from sumac.llm.ragged import Pool

#: Distinct pieces a task remembers before it starts afresh.
REMEMBERED = 500_000


class PieceCache:
    """``encode(list of strings) -> (ids, lengths)`` remembered per string."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = Pool(np.int32)

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """One array of piece numbers per text; valid until the next call."""
        if len(self.known) > self.remembered:
            self._clear()
        fresh = list(set().union(*texts).difference(self.known)) if texts else []
        if fresh:
            ids, lengths = self.encode(fresh)
            first = self.pool.count
            self.pool.extend(ids, lengths)
            self.known.update(zip(fresh, range(first, first + len(fresh))))
        look = self.known.__getitem__
        return [np.fromiter(map(look, t), np.int64, len(t)) for t in texts]

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        return [self.pool.take(n) for n in self.numbers(texts)]
