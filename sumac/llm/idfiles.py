"""Token ids of a corpus in compressed, checksummed files."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sumac.llm import idcoder
from sumac.llm.texts import as_batch, id_and_text, slices
from sumac.llm.tokens import by_units, encoder, read_tokenizer

#: Ids of one frame (whole documents, so a longer document makes a longer frame), and ids coded side by side.
FRAME, TOGETHER = 1 << 16, 1 << 22
#: Text bytes tokenized at once, and pieces a worker remembers: two workers share an executor with a JVM.
TEXT_BYTES, REMEMBERED = 1 << 20, 250_000

#: A frame: its part of the corpus and place in it, the ids before it in that part, its documents
#: and their numbers of ids (little-endian 64-bit), a checksum of these two, and the coded blocks.
SHAPE = "part int, frame int, before long, n_ids long, docs binary, lengths binary, directory_crc32 long, blocks array<binary>"


def _frames(docs: list[tuple[int, np.ndarray]]):
    """Consecutive documents in runs of about FRAME ids."""
    held, size = [], 0
    for doc in docs:
        held.append(doc)
        size += len(doc[1])
        if size >= FRAME:
            yield held
            held, size = [], 0
    if held:
        yield held


def _cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[at : at + idcoder.BLOCK] for at in range(0, len(ids), idcoder.BLOCK)]


def write_ids(
    docs: DataFrame, tokenizer: str, path: str, end_id: int, vocabulary: int, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Writes the ids of all documents, each with ``end_id`` behind it, in ascending order of doc_id.

    Documents are range-partitioned by id, so part k holds smaller ids than part k + 1.
    Every block of ids is coded on its own and carries a checksum. Null and empty texts are
    the end id alone; rows without an id are left out; repeated rows are written each; other columns are ignored.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_tokenizer(tokenizer))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        encode = encoder(definition.value, by_units, REMEMBERED).ids
        part, frame, before = TaskContext.get().partitionId(), 0, 0

        def coded(docs):
            nonlocal frame, before
            directories, streams = [], []
            for held in _frames(docs):
                directories.append((np.array([k for k, _ in held], "<i8").tobytes(), np.array([len(ids) for _, ids in held], "<i8").tobytes()))
                streams.append(np.concatenate([ids for _, ids in held]))
            docs.clear()  # from here on the streams alone hold the ids
            blocks = [_cut(s) for s in streams]
            payloads = iter(idcoder.encode_blocks([b for bs in blocks for b in bs], vocabulary))
            for (names, lengths), stream, own in zip(directories, streams, blocks):
                yield as_batch(
                    {
                        "part": pa.array([part], pa.int32()),
                        "frame": pa.array([frame], pa.int32()),
                        "before": pa.array([before], pa.int64()),
                        "n_ids": pa.array([len(stream)], pa.int64()),
                        "docs": pa.array([names], pa.binary()),
                        "lengths": pa.array([lengths], pa.binary()),
                        "directory_crc32": pa.array([zlib.crc32(names + lengths)], pa.int64()),
                        "blocks": pa.array([[next(payloads) for _ in own]], pa.list_(pa.binary())),
                    }
                )
                frame, before = frame + 1, before + len(stream)

        held, size, end = [], 0, np.array([end_id], np.int32)
        for batch in slices(batches, size=TEXT_BYTES):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode([t.as_py() for t in batch.column("text")])):
                held.append((doc, np.concatenate((ids, end))))
                size += len(ids) + 1
            if size >= TOGETHER:
                yield from coded(held)
                held, size = [], 0
        if held:
            yield from coded(held)

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, SHAPE).write.parquet(path)


def read_ids(spark: SparkSession, path: str, vocabulary: int) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; a wrong checksum fails the job.

    ``start`` counts the ids of all documents before it.
    """
    frames = spark.read.schema(SHAPE).parquet(path)
    totals = frames.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row per part
    offset, rows = 0, []
    for r in totals:
        rows.append((r["part"], offset))
        offset += r["n"]
    base = F.broadcast(spark.createDataFrame(rows, "part int, base long"))

    def run(batches):
        def decoded(held):
            sizes = [min(idcoder.BLOCK, r["n_ids"] - at) for r in held for at in range(0, r["n_ids"], idcoder.BLOCK)]
            found = iter(idcoder.decode_blocks([b for r in held for b in r["blocks"]], sizes, vocabulary))
            for r in held:
                if zlib.crc32(r["docs"] + r["lengths"]) != r["directory_crc32"]:
                    raise ValueError("a directory of documents does not match its checksum")
                lengths = np.frombuffer(r["lengths"], "<i8")
                ends = np.concatenate(([0], np.cumsum(lengths)))
                stream = np.concatenate([next(found) for _ in r["blocks"]])
                yield as_batch(
                    {
                        "doc_id": pa.array(np.frombuffer(r["docs"], "<i8")),
                        "start": pa.array(ends[:-1] + r["base"] + r["before"]),
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(stream)),
                    }
                )

        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                held += batch.slice(k, 1).to_pylist()
                size += held[-1]["n_ids"]
                if size >= TOGETHER:
                    yield from decoded(held)
                    held, size = [], 0
        if held:
            yield from decoded(held)

    return frames.join(base, "part").mapInArrow(run, "doc_id long, start long, ids array<int>")


def ids_crc32(found: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of (doc_id, start, ids); ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(flat[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist())]
            yield as_batch({"doc_id": batch.column("doc_id"), "start": batch.column("start"), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(sums, pa.int64())})

    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
