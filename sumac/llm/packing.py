"""Packing of token pieces into sequences by minimum bin slack."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sumac.llm.ragged import within
from sumac.llm.texts import id_and_text, map_texts
from sumac.llm.tokens import by_spaces, encoder, read_tokenizer
from sumac.session import freeze

#: Pieces that one task packs together; each such group ends with at most one sequence that is far from full.
GROUP = 200_000

#: Distinct words a worker remembers: about 0.2 GB.
REMEMBERED = 1_000_000


def fullest(room: int, counts: list[int], lengths: list[int]) -> list[int]:
    """Available lengths whose sum comes closest to ``room`` without passing it.

    Subset sums are bits of one integer. ``lengths`` are the distinct ones in falling
    order; several copies of one length join in groups of 1, 2, 4 and so on.
    """
    sums, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        copies, chunk = min(counts[length], room // length), 1
        while copies > 0 and not sums >> room:
            take = min(chunk, copies)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & full
            copies, chunk = copies - take, chunk * 2
        if sums >> room:
            break
    left, out = sums.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> left & 1:
            out += [length] * take
            left -= length * take
    return out


def pack_lengths(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item: each bin takes the longest item left and the fullest combination beside it."""
    order = np.argsort(sizes, kind="stable")
    counts = np.bincount(sizes, minlength=capacity + 1)
    top = np.cumsum(counts)  # items of one length lie below this place of order
    counts, top = counts.tolist(), top.tolist()
    bins, offsets, number = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    lengths = [k for k in range(capacity, 0, -1) if counts[k]]
    while lengths:
        largest = lengths[0]
        counts[largest] -= 1
        room = capacity - largest
        chosen = [largest, *fullest(room, counts, [k for k in lengths if k <= room and counts[k]])]
        counts[largest] += 1
        needed = {k: chosen.count(k) for k in chosen}
        times = min(counts[k] // n for k, n in needed.items())
        offset = 0
        for length in chosen:
            items = order[top[length] - times : top[length]]
            top[length] -= times
            counts[length] -= times
            bins[items], offsets[items] = number + np.arange(times), offset
            offset += length
        number += times
        lengths = [k for k in lengths if counts[k]]
    return bins, offsets


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and an end id, cut only where longer than a sequence."""
    definition = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def make():
        encode = encoder(definition.value, by_spaces, REMEMBERED).ids

        def work(batch):
            all_ids = [np.append(ids, end_id).astype("<u4") for ids in encode([t.as_py() for t in batch.column("text")])]
            parts = np.array([-(-len(ids) // capacity) for ids in all_ids], np.int64)
            number = within(parts)
            cuts = [ids[at : at + capacity] for ids in all_ids for at in range(0, len(ids), capacity)]
            return {
                "doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(parts)), parts))),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(number * capacity, pa.int64()),
                "length": pa.array([len(c) for c in cuts], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()),
            }

        return work

    return map_texts(id_and_text(docs, id_col, text_col), "doc_id long, piece int, start long, length long, ids_crc32 long", make)


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Rows are dealt by a hash into groups of about GROUP rows, each packed in one task.
    """
    parts = freeze(parts, "pieces")
    groups = parts.count() // GROUP + 1
    dealt = parts.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))
    names = parts.columns

    def run(batches):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        of = table.column("_group").to_numpy()
        for group in np.unique(of):
            own = table.filter(pa.array(of == group))
            bins, offsets = pack_lengths(own.column("length").to_numpy(), capacity)
            for batch in own.select(names).append_column("sequence_id", pa.array(bins + (int(group) << 40))).append_column("offset", pa.array(offsets)).to_batches(1 << 14):
                yield batch

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    return dealt.repartition(groups, "_group").mapInArrow(run, shape)


def packed_sequences(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Null and empty texts are one piece with the end id alone; rows without an id are left out; repeated rows are
    packed each; other columns are ignored.
    """
    return pack(pieces(docs, path, capacity, end_id, id_col, text_col), capacity)
