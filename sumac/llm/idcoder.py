"""An adaptive range coder for token ids that runs many independent blocks side by side."""

from __future__ import annotations

import zlib

import numpy as np

#: Ids of one block, the coder's total (a power of two), and the table sizes of one block.
BLOCK, TOTAL_BITS = 4096, 22
TABLE2, TABLE1, RECENT_BITS = 2048, 1024, 8
RECENT = 1 << RECENT_BITS
TOTAL, LOW32 = 1 << TOTAL_BITS, np.uint64(32)
#: Unused places behind each block's ids, so that equal places of blocks do not share a cache set.
PAD = 16


class _Model:
    """Order-0 to order-2 predictions of the next id in each of ``lanes`` blocks.

    Order 2 and order 1 predict the id that last followed the context, weighted by a success
    rate that adapts per block and run length of successes. Order 0 gives the
    ids seen lately, one per hash slot, equal shares, and every id of the vocabulary has a small share. The
    shares of all are mixed into one cumulative distribution with the total ``TOTAL``.
    """

    def __init__(self, lanes: int, vocabulary: int):
        if vocabulary + RECENT > TOTAL // 2:
            raise ValueError("vocabulary too large for the coder's total")
        self.vocabulary, self.lane = vocabulary, np.arange(lanes)
        self.table2, self.run2 = np.full(lanes * TABLE2, -1, np.int32), np.zeros(lanes * TABLE2, np.uint8)
        self.table1, self.run1 = np.full(lanes * TABLE1, -1, np.int32), np.zeros(lanes * TABLE1, np.uint8)
        self.recent = np.full(lanes * RECENT, -1, np.int32)
        self.rate2, self.rate1 = (np.tile((np.arange(8) * 6000 + 6000).astype(np.int64), lanes) for _ in range(2))
        self.rate0 = np.full(lanes, 32768, np.int64)
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.spare = TOTAL - vocabulary - RECENT
        self._bases()

    def _bases(self) -> None:
        self.base2, self.base1, self.base0, self.base_rate = (self.lane * n for n in (TABLE2, TABLE1, RECENT, 8))

    def shrink(self, lanes: int) -> None:
        """Goes on with the first lanes only."""
        self.lane, self.before, self.last, self.rate0 = self.lane[:lanes], self.before[:lanes], self.last[:lanes], self.rate0[:lanes]
        self._bases()

    def predict(self) -> None:
        spread = self.last * 0x9E3779B1
        self.at2 = self.base2 + (((self.before * 0x2545F491 + spread) >> 7) & (TABLE2 - 1))
        self.at1 = self.base1 + (spread >> 9 & (TABLE1 - 1))
        self.guess2, self.guess1 = self.table2.take(self.at2), self.table1.take(self.at1)
        self.cell2 = self.base_rate + self.run2.take(self.at2)
        self.cell1 = self.base_rate + self.run1.take(self.at1)
        self.old2, self.old1 = self.rate2.take(self.cell2), self.rate1.take(self.cell1)
        rate2, rate1 = self.old2, self.old1
        self.share2 = np.where(self.guess2 >= 0, (self.spare * rate2) >> 16, 0)
        rest = self.spare - self.share2
        self.share1 = np.where((self.guess1 >= 0) & (self.guess1 != self.guess2), (rest * rate1) >> 16, 0)
        rest -= self.share1
        pool = (rest * self.rate0) >> 16
        self.slot = 1 + (pool >> RECENT_BITS)
        self.each = 1 + (rest - pool) // self.vocabulary
        self.low0 = self.share2 + self.share1
        self.low_all = self.low0 + RECENT * self.slot

    @staticmethod
    def _hash(ids: np.ndarray) -> np.ndarray:
        return (ids * 0x85EBCA6B >> 11) & (RECENT - 1)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self._hash(ids)
        self.place = self.base0 + slots
        self.hit2, self.hit1 = ids == self.guess2, ids == self.guess1
        self.hit0 = self.recent.take(self.place) == ids
        start = np.where(self.hit0, self.low0 + slots * self.slot, self.low_all + ids * self.each)
        size = np.where(self.hit0, self.slot, self.each)
        for hit, low, share in ((self.hit1, self.share2, self.share1), (self.hit2, 0, self.share2)):
            np.copyto(start, low, where=hit)
            np.copyto(size, share, where=hit)
        return start, size

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``value``."""
        slot = np.clip((value - self.low0) // self.slot, 0, RECENT - 1)
        recent = self.recent.take(self.base0 + slot)
        other = np.minimum((value - self.low_all) // self.each, self.vocabulary - 1)
        found = np.where(value < self.share2, self.guess2, np.where(value < self.low0, self.guess1, np.where(value < self.low_all, recent, other)))
        return found.astype(np.int64)

    def update(self, ids: np.ndarray) -> None:
        """Learns the ids whose ``interval`` was asked last."""
        for hit, at, table, run, cell, rate, old in (
            (self.hit2, self.at2, self.table2, self.run2, self.cell2, self.rate2, self.old2),
            (self.hit1, self.at1, self.table1, self.run1, self.cell1, self.rate1, self.old1),
        ):
            rate[cell] = old + ((hit * 64000 + 500 - old) >> 4)  # never zero, so that every guess keeps a share
            run[at] = np.minimum(cell - self.base_rate + 1, 7) * hit
            table[at] = ids
        self.rate0 = self.rate0 + ((self.hit0 * 60000 + 2000 - self.rate0) >> 5)
        self.recent[self.place] = ids
        self.before, self.last = self.last, ids


def encode_blocks(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """One payload per block of at most BLOCK ids; each starts with the checksum of its ids."""
    if not blocks:
        return []
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    sizes = np.array([len(blocks[k]) for k in order])
    ids = np.zeros((len(blocks), max(1, sizes[0]) + PAD), np.int32)
    for row, k in enumerate(order.tolist()):
        if sizes[row] and (blocks[k].min() < 0 or blocks[k].max() >= vocabulary):
            raise ValueError("an id lies outside the vocabulary")
        ids[row, : sizes[row]] = blocks[k]
    model, lanes = _Model(len(blocks), vocabulary), len(blocks)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(2**64 - 1))
    last_low = low.copy()  # of blocks that have ended
    words, used = np.zeros((lanes, BLOCK + 4), np.uint32), np.zeros(lanes, np.int64)

    def carry(rows: np.ndarray, places: np.ndarray) -> None:
        while len(rows):
            words[rows, places] += np.uint32(1)
            again = words[rows, places] == 0
            rows, places = rows[again], places[again] - 1

    live = np.searchsorted(-sizes, -np.arange(max(1, sizes[0])), side="left").tolist()
    for k in range(len(live)):
        if not live[k]:
            break
        if live[k] < len(low):
            last_low[: len(low)] = low
            low, span = low[: live[k]].copy(), span[: live[k]].copy()
            model.shrink(live[k])
        now = ids[: live[k], k].astype(np.int64)
        model.predict()
        start, size = model.interval(now)
        unit = span >> np.uint64(TOTAL_BITS)
        moved = low + unit * start.astype(np.uint64)
        over = np.flatnonzero(moved < low)
        if len(over):
            carry(over, used[over] - 1)
        low, span = moved, unit * size.astype(np.uint64)
        out = np.flatnonzero(span < np.uint64(1 << 32))
        if len(out):
            words[out, used[out]] = (low[out] >> LOW32).astype(np.uint32)
            used[out] += 1
            low[out] <<= LOW32
            span[out] <<= LOW32
        model.update(now)
    last_low[: len(low)] = low
    rows = np.arange(lanes)
    for shift in (32, 0):
        words[rows, used] = ((last_low >> np.uint64(shift)) & np.uint64(2**32 - 1)).astype(np.uint32)
        used += 1
    result: list[bytes] = [b""] * lanes
    for row, k in enumerate(order.tolist()):
        data = words[row, : used[row]].astype("<u4").tobytes()
        result[k] = zlib.crc32(np.asarray(blocks[k]).astype("<u4").tobytes()).to_bytes(4, "little") + data
    return result


def decode_blocks(payloads: list[bytes], sizes: list[int], vocabulary: int) -> list[np.ndarray]:
    """The ids of every block; a wrong checksum raises ValueError."""
    if not payloads:
        return []
    given = np.array(sizes, np.int64)
    order = np.argsort(-given, kind="stable")
    given = given[order]
    lanes, steps = len(payloads), int(given[0])
    longest = max(len(p) for p in payloads) // 4 + 2
    words = np.zeros((lanes, longest), np.uint64)
    for row, k in enumerate(order.tolist()):
        data = np.frombuffer(payloads[k][4:], "<u4")
        words[row, : len(data)] = data
    out = np.zeros((lanes, steps + PAD), np.int32)
    model = _Model(lanes, vocabulary)
    code, span = (words[:, 0] << LOW32) | words[:, 1], np.full(lanes, np.uint64(2**64 - 1))
    used = np.full(lanes, 2)
    live = np.searchsorted(-given, -np.arange(steps), side="left").tolist()
    for k in range(steps):
        if live[k] < len(code):
            code, span, used = code[: live[k]].copy(), span[: live[k]].copy(), used[: live[k]].copy()
            model.shrink(live[k])
        model.predict()
        unit = span >> np.uint64(TOTAL_BITS)
        value = np.minimum(code // unit, np.uint64(TOTAL - 1)).astype(np.int64)
        ids = model.find(value)
        start, size = model.interval(ids)
        code = code - unit * start.astype(np.uint64)
        span = unit * size.astype(np.uint64)
        more = np.flatnonzero(span < np.uint64(1 << 32))
        if len(more):
            code[more] = (code[more] << LOW32) | words[more, np.minimum(used[more], longest - 1)]
            span[more] <<= LOW32
            used[more] += 1
        model.update(ids)
        out[: live[k], k] = ids
    result: list[np.ndarray] = [np.empty(0, np.int32)] * lanes
    for row, k in enumerate(order.tolist()):
        ids = out[row, : given[row]]
        if zlib.crc32(ids.astype("<u4").tobytes()).to_bytes(4, "little") != payloads[k][:4]:
            raise ValueError("a block of ids does not match its checksum")
        result[k] = ids
    return result
