"""Byte-level BPE encoding and decoding with padded matrices."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from sumac.llm.pieces import PieceCache
from sumac.llm.ragged import spread
from sumac.llm.texts import id_and_text, map_texts, units

NEVER = np.int64(1 << 40)
#: Cells of one matrix; words longer than LONG bytes are merged with a heap, as one matrix row would take quadratic time.
CELLS, LONG = 1 << 21, 4096


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairTable:
    """(left id, right id) -> id of the joined token, by open addressing in numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.pairs = found
        size = 1 << max(4, (4 * len(found)).bit_length())
        self.mask = size - 1
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NEVER, np.int64)
        keys, values = np.array(list(found), np.int64), np.array(list(found.values()), np.int64)
        slots = self._slot(keys)
        while len(keys):
            # One key per free slot settles, the others move on by one.
            free = self.keys[slots] == -1
            order = np.flatnonzero(free)
            _, first = np.unique(slots[order], return_index=True)
            settled = order[first]
            self.keys[slots[settled]], self.values[slots[settled]] = keys[settled], values[settled]
            rest = np.ones(len(keys), bool)
            rest[settled] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NEVER if it does not merge; a negative id is padding."""
        keys = np.where((left < 0) | (right < 0), -2, left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slots = self._slot(keys)
        out = np.full(len(keys), NEVER, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slots[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (there != -1)]
            slots[todo] = (slots[todo] + 1) & self.mask
        return out.reshape(left.shape)


class Merger:
    """Token ids of byte words: every round each word merges its leftmost pair of least rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.table = PairTable(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in word order, and how many each word has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        results: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        widths = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        for width in np.unique(widths[(sizes > 0) & (sizes <= LONG)]):
            members = np.flatnonzero((widths == width) & (sizes > 0))
            step = max(1, CELLS // int(width))
            for at in range(0, len(members), step):
                self._bucket(words, members[at : at + step], int(width), results)
        for k in np.flatnonzero(sizes > LONG):
            results[k] = self._long(words[k])
        lengths = np.fromiter(map(len, results), np.int64, len(results))
        return (np.concatenate(results) if results else np.empty(0, np.int32)), lengths

    def _bucket(self, words, members: np.ndarray, width: int, results: list) -> None:
        padded = b"".join(words[k].ljust(width, b"\0") for k in members.tolist())
        ids = self.single[np.frombuffer(padded, np.uint8)].reshape(-1, width).astype(np.int32)
        sizes = np.array([len(words[k]) for k in members.tolist()])
        ids[np.arange(width) >= sizes[:, None]] = -1
        ranks = self.table.ranks(ids[:, :-1], ids[:, 1:])
        while len(members):
            if ids.shape[1] > 1:
                rows, at = np.arange(len(members)), ranks.argmin(axis=1)
                best = ranks[rows, at]
                done = best == NEVER
            else:
                done = np.ones(len(members), bool)
            for k, row in zip(members[done].tolist(), ids[done]):
                results[k] = row[row >= 0]
            if done.all():
                return
            # Compaction: finished rows leave, and each other row loses one column.
            live = ~done
            members, ids, ranks, at, best = members[live], ids[live], ranks[live], at[live], best[live]
            rows = np.arange(len(members))
            ids[rows, at] = best
            keep = np.ones(ids.shape, bool)
            keep[rows, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[rows, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            for side in (at - 1, at):
                ok = (side >= 0) & (side < ranks.shape[1])
                r, c = rows[ok], side[ok]
                ranks[r, c] = self.table.ranks(ids[r, c], ids[r, c + 1])

    def _long(self, word: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs = self.table.pairs
        heap: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < len(ids):
                left, right = ids[k], ids[after[k]]
                rank = pairs.get(left << 32 | right)
                if rank is not None:
                    heapq.heappush(heap, (rank, k, left, right))

        for k in range(len(ids)):
            offer(k)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            if ids[k] != left or after[k] >= len(ids) or ids[after[k]] != right:
                continue
            gone = after[k]
            ids[k], ids[gone], after[k] = rank, -1, after[gone]
            if after[k] < len(ids):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return np.array([x for x in ids if x >= 0], np.int32)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each match of ``pattern`` is encoded by the rank file at ``path``, without special tokens.

    A null or empty text has no ids; rows without an id are left out; repeated rows are encoded
    each; other columns are ignored. Every distinct piece of text is merged once per task.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        merger, find = Merger(ranks.value), regex.compile(pattern).findall

        def tokenized(pieces: list[str]):
            words, counts = [], []
            for piece in pieces:
                matches = find(piece)
                words += [m.encode() for m in matches]
                counts.append(len(matches))
            ids, lengths = merger.encode(words)
            ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))]
            return ids, np.diff(ends)

        cache = PieceCache(tokenized)

        def work(batch):
            texts = []
            for value in batch.column("text"):
                first, *rest = units(value.as_py().decode("utf-8", "replace"))
                texts.append([first, *[" " + r for r in rest]])
            ids = cache.ids(texts)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            return {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(ends, pa.array(values))}

        return work

    return map_texts(id_and_text(docs, id_col, text_col), "doc_id long, ids array<int>", make)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``, to (doc_id, ids); null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        size = max(ranks.value.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.value.items():
            tokens[rank] = token
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        lengths = np.fromiter(map(len, tokens), np.int64, size)
        starts = np.cumsum(lengths) - lengths

        def work(batch):
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            of_row = lists.value_lengths().to_numpy(zero_copy_only=False)
            chars = flat[spread(starts[ids], lengths[ids])]
            ends = np.concatenate(([0], np.cumsum(lengths[ids])))[np.concatenate(([0], np.cumsum(of_row)))]
            decoded = pa.Array.from_buffers(
                pa.binary(), len(of_row), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(chars.tobytes())]
            )
            return {"doc_id": batch.column("doc_id"), "ids": lists, "decoded": decoded}

        return work

    known = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return map_texts(known, "doc_id long, ids array<int>, decoded binary", make, "ids")
