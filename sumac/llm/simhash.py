"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from sumac.llm.components import components
from sumac.llm.texts import id_and_text, map_texts
from sumac.session import freeze

#: Blocks above this many fingerprints are compared in chunks of this size inside tasks instead of by a join.
CHUNK = 512


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits; a bit is set if more than half of the shingles' hashes set it. No words: zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[k - 1 :].tolist())], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every document as a signed long. A null text has no words."""

    def make():
        def work(batch):
            bits = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            return {"doc_id": batch.column("doc_id"), "fp": np.array(bits, dtype=np.uint64).view(np.int64)}

        return work

    return map_texts(id_and_text(docs, id_col, text_col), "doc_id long, fp long", make)


def block_masks(blocks: int, kept: int) -> list[int]:
    """One mask per choice of ``kept`` of the blocks into which 64 bits are cut."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:])]
    return [sum(choice) for choice in combinations(parts, kept)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _linked_in_chunks(pairs: pd.DataFrame, distance: int) -> pd.DataFrame:
    """A spanning forest of the links among one task's fingerprints; no list of all pairs."""
    fps = pairs["fp"].drop_duplicates().to_numpy().astype(np.int64)
    left, out = fps.view(np.uint64), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            node, front = front[0], front[1:]
            near = np.bitwise_count(left ^ node) <= distance
            out += [(node, x) for x in left[near]]
            front, left = np.concatenate([front, left[near]]), left[~near]
    return pd.DataFrame(np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["x", "y"])


def links(nodes: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """(x, y): links that connect exactly what pairs of ``fp`` within ``distance`` bits connect.

    ``nodes`` has one row per distinct fingerprint. Fingerprints are cut in ``blocks``; two
    within ``distance`` bits agree on at least ``blocks - distance`` whole ones, so they meet
    under one of the keys made of that many blocks. With the default 20 keys of about 32
    bits a key holds few unrelated fingerprints even for billions of rows. A key of two rows needs no join,
    small keys join their rows, and large keys go to tasks in pairs of chunks of bounded
    size, which return a spanning forest.
    """
    masks = block_masks(blocks, blocks - distance)
    keyed = nodes.select(
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("c", "key"), "fp"
    )
    sizes = freeze(
        keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("x"), F.max("fp").alias("y")).filter("n > 1"),
        "blocks",
    )
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance
    twos = sizes.filter("n = 2").filter(near).select("x", "y")
    some = keyed.join(sizes.filter(f"n > 2 and n <= {CHUNK}").select("c", "key"), ["c", "key"])
    joined = (
        some.withColumnRenamed("fp", "x")
        .join(some.withColumnRenamed("fp", "y"), ["c", "key"])
        .filter(F.col("x") < F.col("y"))
        .filter(near)
        .select("x", "y")
    )
    many = keyed.join(sizes.filter(f"n > {CHUNK}").select("c", "key", F.ceil(F.col("n") / CHUNK).alias("k")), ["c", "key"])
    many = many.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k"))).withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
    many = many.select("c", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    chunked = many.groupBy("c", "key", "i", "j").applyInPandas(lambda pairs: _linked_in_chunks(pairs, distance), "x long, y long")
    return twos.unionByName(joined).unionByName(chunked)


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, blocks: int = 6
) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable by links.

    Null and empty texts have fingerprint zero and link like any other; rows without an id are left
    out; repeated rows give repeated results; other columns are ignored.
    Documents of one fingerprint are one node, so copies never multiply.
    """
    marked = freeze(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = freeze(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    pairs = links(nodes.select("fp"), distance, blocks)
    for side, end in (("x", "a"), ("y", "b")):
        pairs = pairs.join(nodes.select(F.col("fp").alias(side), F.col("first").alias(end)), side)
    found = components(pairs.select("a", "b"))
    grouped = nodes.join(found, nodes["first"] == found["node"], "left").select(
        "fp", F.coalesce("component", "first").alias("component_id")
    )
    return marked.join(grouped, "fp").select("doc_id", "fp", "component_id")
