"""Removal of word windows that occur earlier, found by difference-cover anchors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sumac.llm.ragged import within
from sumac.llm.texts import as_batch, id_and_text, map_texts
from sumac.session import freeze

#: The filter of repeated anchors has at most this many bits (64 MB); beyond it more windows are checked, with the same result.
MOST_BITS = 1 << 29
#: Distinct words a task remembers before it starts afresh.
REMEMBERED = 400_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _Words:
    """64-bit values of words; equal words have equal values."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def values(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        digest = xxhash.xxh3_64_intdigest
        self.known.update((w, digest(w)) for w in set(words).difference(self.known))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def _rolled(values: np.ndarray, at: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of the ``length`` values from each position on."""
    out = np.zeros(len(at), np.uint64)
    for k in range(length):
        out = out * factor + values[at + k]
    return _mixed(out)


class _Batch:
    """The words of a batch of documents, end to end."""

    def __init__(self, batch: pa.RecordBatch, words: _Words):
        self.ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        texts = [t.as_py().split() for t in batch.column("text")]
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.values = words.values([w for t in texts for w in t])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.place = within(self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.place

    def anchors(self, span: int, period: int, cover: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.isin(self.place % period, cover) & (self.left >= span))
        return at, _rolled(self.values, at, span, _ODD[0])


def _six(hashes: np.ndarray) -> bytes:
    return hashes.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _cut(order: np.ndarray, keys: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(key, positions) for each distinct key of sorted positions."""
    if not len(order):
        return []
    sorted_keys = keys[order]
    edges = np.flatnonzero(np.diff(sorted_keys)) + 1
    return [(int(keys[part[0]]), part) for part in np.split(order, edges)]


def _repeated_anchors(texts: DataFrame, span: int, period: int, cover: Sequence[int], bits: int) -> DataFrame:
    """(bucket, hashes, n): the anchor hashes seen more than once, cut to 48 bits, by their leading bits."""

    def make():
        words = _Words()

        def work(batch):
            _, hashes = _Batch(batch, words).anchors(span, period, cover)
            hashes, counts = np.unique(hashes, return_counts=True)
            hashes = np.repeat(hashes, np.minimum(counts, 2))  # twice is enough to say repeated
            buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            parts = _cut(np.arange(len(hashes)), buckets)
            return {
                "bucket": pa.array([k for k, _ in parts], pa.int64()),
                "hashes": pa.array([_six(hashes[p]) for _, p in parts], pa.binary()),
            }

        return work

    def reduce(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("hashes").to_pylist()):
                held.setdefault(bucket, []).append(_from_six(data))
        for bucket, parts in held.items():
            found = np.sort(np.concatenate(parts))
            twice = np.unique(found[1:][found[1:] == found[:-1]])
            yield as_batch(
                {
                    "bucket": pa.array([bucket], pa.int64()),
                    "hashes": pa.array([_six(twice)], pa.binary()),
                    "n": pa.array([len(twice)], pa.int64()),
                }
            )

    sent = map_texts(texts, "bucket long, hashes binary", make)
    return sent.repartition(1 << bits, "bucket").mapInArrow(reduce, "bucket long, hashes binary, n long")


class _Filter:
    """A Bloom filter with one bit per hash, cut in one segment per bucket."""

    def __init__(self, bits: int, size: int):
        self.bits, self.segment = bits, max(64, size >> bits)
        self.table = np.zeros((1 << bits) * self.segment // 8, np.uint8)

    def place(self, low: np.ndarray) -> np.ndarray:
        return (_mixed(low) % np.uint64(self.segment)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        low = hashes & np.uint64((1 << 48) - 1)
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) * self.segment + self.place(low)
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _filter(repeated: DataFrame, bits: int) -> _Filter:
    total = repeated.agg(F.sum("n")).first()[0] or 0
    made = _Filter(bits, min(MOST_BITS, 1 << max(16, (16 * total).bit_length())))

    def segments(batches):
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("hashes").to_pylist()):
                flags = np.zeros(made.segment, np.uint8)
                flags[made.place(_from_six(data))] = 1
                packed = np.packbits(flags, bitorder="little").tobytes()
                yield as_batch({"bucket": pa.array([bucket], pa.int64()), "segment": pa.array([packed], pa.binary())})

    empty = made.table
    made.table = None  # the tasks only need the shape
    rows = repeated.filter("n > 0").mapInArrow(segments, "bucket long, segment binary")
    width = made.segment // 8
    for row in rows.toLocalIterator(prefetchPartitions=True):
        empty[row["bucket"] * width : (row["bucket"] + 1) * width] = np.frombuffer(row["segment"], np.uint8)
    made.table = empty
    return made


def _planes(values: np.ndarray) -> bytes:
    """Differences of unsigned numbers, high bytes apart from low ones, which packs well."""
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32).astype(np.int64)


_SENT = pa.schema([("bucket", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("starts", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])


def _packed(bucket: int, docs: np.ndarray, starts: np.ndarray, a: np.ndarray | None = None, b: np.ndarray | None = None) -> dict:
    """One row: windows sorted by (doc, start), each document named once."""
    new = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    counts = np.diff(np.append(new, len(docs))).astype(np.uint32)
    return {
        "bucket": bucket,
        "docs": docs[new].astype(np.int64).tobytes(),
        "counts": counts.tobytes(),
        "starts": _planes(starts),
        "a": None if a is None else a.tobytes(),
        "b": None if b is None else b.tobytes(),
    }


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
    return np.repeat(np.frombuffer(row["docs"], np.int64), counts), _from_planes(row["starts"])


def _not_first(docs: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, late): windows by hash and place, and whether an equal one lies at an earlier place."""
    order = np.lexsort((starts, docs, b, a))
    a, b, docs, starts = a[order], b[order], docs[order], starts[order]
    lead = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, bool)
    first = np.maximum.accumulate(np.where(lead, np.arange(len(a)), 0)) if len(a) else np.empty(0, np.int64)
    return order, (docs != docs[first]) | (starts != starts[first])


def _candidates(texts: DataFrame, window: int, span: int, period: int, cover, bits: int, repeated) -> DataFrame:
    """Packed windows around repeated anchors. Those with an earlier equal one in the same batch go without hashes."""

    def make():
        words, known = _Words(), repeated.value

        def work(batch):
            own = _Batch(batch, words)
            at, hashes = own.anchors(span, period, cover)
            at = at[known.has(hashes)] if len(at) else at
            # Mark the starts whose window holds a repeated anchor, with a difference array.
            marks = np.zeros(len(own.values) + 1, np.int64)
            lowest = np.maximum(at - (window - span), at - own.place[at])
            np.add.at(marks, lowest, 1)
            np.add.at(marks, at + 1, -1)
            start = np.flatnonzero((np.cumsum(marks)[:-1] > 0) & (own.left >= window))
            docs = np.repeat(own.ids, own.sizes)[start]
            place = own.place[start]
            a, b = _rolled(own.values, start, window, _ODD[1]), _rolled(own.values, start, window, _ODD[2])
            b = (b >> np.uint64(32)).astype(np.uint32)
            order, late = _not_first(docs, place, a, b)
            rows = []
            sure = np.sort(order[late])
            if len(sure):
                rows.append(_packed(-1 - int(docs[sure[0]] % 1024), docs[sure], place[sure]))
            open_ = np.sort(order[~late])
            buckets = (a >> np.uint64(64 - bits)).astype(np.int64)
            for bucket, part in _cut(open_[np.argsort(buckets[open_], kind="stable")], buckets):
                rows.append(_packed(bucket, docs[part], place[part], a[part], b[part]))
            return {f.name: pa.array([r[f.name] for r in rows], f.type) for f in _SENT}

        return work

    return map_texts(texts, "bucket long, docs binary, counts binary, starts binary, a binary, b binary", make)


def _late_windows(sent: DataFrame, bits: int) -> DataFrame:
    """(doc_id, starts): for each document that has any, the window starts that an equal window precedes.

    Tasks that compare windows send one packed row to each task that gathers documents.
    """

    def concatenated(parts: list[tuple]):
        return map(np.concatenate, zip(*parts))

    def reduce(batches):
        held: dict[int, list[tuple]] = {}
        late: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                docs, starts = _unpacked(row)
                if row["a"] is None:
                    late.append((docs, starts))
                else:
                    held.setdefault(row["bucket"], []).append(
                        (docs, starts, np.frombuffer(row["a"], np.uint64), np.frombuffer(row["b"], np.uint32))
                    )
        while held:
            docs, starts, a, b = concatenated(held.popitem()[1])
            order, after = _not_first(docs, starts, a, b)
            late.append((docs[order[after]], starts[order[after]]))
        if late:
            docs, starts = concatenated(late)
            order = np.lexsort((starts, docs))
            docs, starts = docs[order], starts[order]
            targets = (_mixed(docs.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            rows = [_packed(t, docs[p], starts[p]) for t, p in _cut(np.argsort(targets, kind="stable"), targets)]
            yield as_batch({k: pa.array([r[k] for r in rows], _SENT.field(k).type) for k in ("bucket", "docs", "counts", "starts")})

    def gather(batches):
        parts = [_unpacked(row) for batch in batches for row in batch.to_pylist()]
        if parts:
            docs, starts = concatenated(parts)
            order = np.lexsort((starts, docs))
            found = _cut(order, docs)
            yield as_batch(
                {
                    "doc_id": pa.array([k for k, _ in found], pa.int64()),
                    "starts": pa.array([_planes(starts[p]) for _, p in found], pa.binary()),
                }
            )

    packed = sent.repartition(1 << bits, "bucket").mapInArrow(reduce, "bucket long, docs binary, counts binary, starts binary")
    return packed.repartition(1 << bits, "bucket").mapInArrow(gather, "doc_id long, starts binary")


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    period: int = 13,
    cover: Sequence[int] = (0, 1, 3, 9),
    carry: Sequence[str] = (),
    as_written: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, and the ``carry`` columns): each word goes that lies in a window which also starts earlier.

    Earlier means a smaller doc_id, or the same document further left. Anchors are windows of
    ``window - period + 1`` words whose position modulo ``period`` is in ``cover``. As
    ``cover`` is a difference cover, two equal windows hold an equal anchor at the same depth.
    Anchor hashes are sent once per batch, repeated ones fill a filter of bounded size,
    and only windows around an anchor in the filter are hashed whole (96 bits) and compared.
    A batch sends one entry per distinct anchor and window, so a passage in a third of
    all documents makes no large group.

    ``kept`` joins the words that stay by one space; with ``as_written`` a text that
    loses nothing stays as it is. Null and empty texts have no words and keep the empty string; rows without an id are left out;
    rows that repeat an id are judged as that one document; other columns are ignored.
    """
    if {(x - y) % period for x in cover for y in cover} != set(range(period)):
        raise ValueError("cover is no difference cover of period")
    span = window - period + 1
    if span < 1:
        raise ValueError("period is longer than window")
    spark = docs.sparkSession
    cover = [int(c) for c in cover]
    bits = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    texts = id_and_text(docs, id_col, text_col)
    repeated = freeze(_repeated_anchors(texts, span, period, cover, bits), "anchors")
    known = spark.sparkContext.broadcast(_filter(repeated, bits))
    late = freeze(_late_windows(_candidates(texts, window, span, period, cover, bits, known), bits), "late")

    def make():
        def work(batch):
            n, removed, kept = [], [], []
            for text, late_starts in zip(batch.column("text"), batch.column("starts").to_pylist()):
                words = text.as_py().split()
                n.append(len(words))
                if late_starts:
                    marks = np.zeros(len(words) + 1, np.int64)
                    starts = _from_planes(late_starts)
                    np.add.at(marks, starts, 1)
                    np.add.at(marks, starts + window, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(marks)[:-1] == 0).tolist()]
                removed.append(n[-1] - len(words))
                whole = as_written and len(words) == n[-1]
                kept.append((text.as_py() if whole else b" ".join(words)).decode("utf-8", "replace"))
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(n, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                **{f"_carry{k}": batch.column(f"_carry{k}") for k in range(len(carry))},
            }

        return work

    carried = id_and_text(docs, id_col, text_col, carry)
    types = {f.name: f.dataType.simpleString() for f in carried.schema}
    shape = ", ".join(["doc_id long, n_words long, n_removed long, kept string", *[f"_carry{k} {types[f'_carry{k}']}" for k in range(len(carry))]])
    found = map_texts(carried.join(late, "doc_id", "left"), shape, make)
    return found.select("doc_id", "n_words", "n_removed", "kept", *[F.col(f"_carry{k}").alias(c) for k, c in enumerate(carry)])
