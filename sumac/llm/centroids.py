"""Exact integer k-means over zone maps: blocks of vectors in Hilbert order with min/max boxes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sumac.llm.texts import as_batch
from sumac.llm.vectors import finite
from sumac.session import freeze

#: Vectors of one block, and bits of a coordinate that enter its place on the curve.
BLOCK, CURVE_BITS = 256, 4
#: Components beyond this raise: squared distances of 64 of them would not fit a long.
LARGEST = 1 << 26

BLOCKS = "ids binary, vectors binary, low binary, high binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The places of points on a Hilbert curve as bytes; ``cells`` has a row of ``bits``-bit coordinates per point.

    Coordinates are turned into the transposed index level by level from the highest bit, all points at once.
    """
    x = cells.astype(np.uint32).copy()
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, np.uint32(0), (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(on, below, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip[:, None]
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that may be nearest to some point of a box.

    The difference of the squared distances to two centroids is linear in the point, so its largest value over the box is exact;
    a centroid is out when another one is nearer everywhere, or as near and of smaller number.
    """
    toward = 2 * (centroids[None, :, :] - centroids[:, None, :])
    squares = (centroids * centroids).sum(axis=1)
    worst = squares[:, None] - squares[None, :] + np.maximum(toward * low, toward * high).sum(axis=2)
    order = np.arange(len(centroids))
    beaten = (worst < 0) | ((worst == 0) & (order[:, None] < order[None, :]))
    return np.flatnonzero(~beaten.any(axis=0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST}")
    return out


def _moments(kept: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every coordinate; tasks send one row a coordinate. They place vectors on the curve, no result depends on them."""

    def run(batches):
        n, s, ss = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(float)
            n, s, ss = n + len(x), s + x.sum(axis=0), ss + (x * x).sum(axis=0)
        if n:
            yield as_batch({"dim": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "s": pa.array(s), "ss": pa.array(ss)})

    sums = kept.select("v").mapInArrow(run, "dim int, n long, s double, ss double").groupBy("dim").agg(F.sum("n"), F.sum("s"), F.sum("ss")).collect()
    mean, spread = np.zeros(width), np.ones(width)
    for dim, n, s, ss in sums:
        mean[dim] = s / n
        spread[dim] = max(ss / n - (s / n) ** 2, 1e-9) ** 0.5
    return mean, spread


def zone_maps(kept: DataFrame, width: int) -> DataFrame:
    """The vectors (vec_id, v) in blocks of ``BLOCKS``: near ones together by their place on a Hilbert curve, with least and largest components.

    Coordinates of larger deviation come first on the curve. Rows of one place are parted by a hash of their id,
    so that a vector in a third of all rows fills many range partitions.
    """
    mean, spread = _moments(kept, width)
    first = np.argsort(-spread, kind="stable")

    def place(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            cells = np.clip(((x - mean) / (4 * spread) + 0.5) * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.uint32)
            keys = hilbert_keys(cells[:, first], CURVE_BITS) if len(x) else []
            packed = [row.tobytes() for row in x.astype("<i4")]
            yield as_batch({"vec_id": batch.column("vec_id"), "place": pa.array(keys, pa.binary()), "vector": pa.array(packed, pa.binary())})

    def gather(batches):
        ids, rows = [], []

        def block():
            x = np.frombuffer(b"".join(rows), "<i4").reshape(-1, width)
            columns = (np.array(ids, "<i8"), x, x.min(axis=0), x.max(axis=0))
            names = ("ids", "vectors", "low", "high")
            return as_batch({k: pa.array([c.tobytes()], pa.binary()) for k, c in zip(names, columns)})

        for batch in batches:
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                ids.append(vec_id)
                rows.append(vector)
                if len(ids) == BLOCK:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    placed = kept.mapInArrow(place, "vec_id long, place binary, vector binary").withColumn("h", F.xxhash64("vec_id"))
    return placed.repartitionByRange("place", "h").sortWithinPartitions("place", "h").mapInArrow(gather, BLOCKS)


def _assigned(batches, centroids: np.ndarray):
    """(ids, vectors, nearest centroid, squared distance) of each block; only the block's candidates are compared, exactly."""
    width = centroids.shape[1]
    for batch in batches:
        for row in batch.to_pylist():
            low, high = (np.frombuffer(row[k], "<i4").astype(np.int64) for k in ("low", "high"))
            x = np.frombuffer(row["vectors"], "<i4").reshape(-1, width).astype(np.int64)
            near = candidates(low, high, centroids)
            apart = np.stack([((x - centroids[c]) ** 2).sum(axis=1) for c in near], axis=1)
            best = apart.argmin(axis=1)
            yield np.frombuffer(row["ids"], "<i8"), x, near[best], apart[np.arange(len(x)), best]


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; a task sends one sum per cluster and coordinate, added up exactly."""
    count, width = centroids.shape

    def run(batches):
        sums, sizes = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for _, x, cluster, _ in _assigned(batches, centroids):
            for c in np.unique(cluster):
                own = x[cluster == c]
                sums[c] += own.sum(axis=0)
                sizes[c] += len(own)
        for c in np.flatnonzero(sizes):
            yield as_batch(
                {
                    "cluster": pa.array([c] * width, pa.int32()),
                    "dim": pa.array(range(width), pa.int32()),
                    "total": pa.array(sums[c]),
                    "n": pa.array([sizes[c]] * width, pa.int64()),
                }
            )

    parts = blocks.mapInArrow(run, "cluster int, dim int, total long, n long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def centroid_clusters(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, scale: int = 1024, count: int = 8, rounds: int = 10, seed: int = 3
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector with ``width`` finite components.

    A component x counts as floor(scale * x). The first centroids are the ``count`` vectors with the smallest sha256 of "seed:id" (all, if
    fewer; rows that repeat an id are vectors of their own); each of ``rounds`` rounds assigns every vector to the nearest one, ties to the smaller number, and moves every centroid that has
    vectors to the floor of their mean, in integers throughout. Distances are squared.

    Blocks are written once; a round reads them, decides per block by its box which centroids can be nearest to any of its vectors and
    compares only those. Rows without an id, null vectors and vectors of another width or with null or non-finite components are left out; other
    columns are ignored; an empty table gives no rows. Components beyond 2**26 after scaling raise.
    """
    spark = vectors.sparkSession
    good = finite(F.col(vector_col)) & (F.size(vector_col) == width) & F.col(id_col).isNotNull()
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = freeze(vectors.filter(good).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")), "kept")
    token = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    starts = kept.select(token.alias("token"), "v").orderBy("token", "v").limit(count).collect()  # a row per centroid
    if not starts:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in starts], np.int64)
    blocks = freeze(zone_maps(kept, width), "blocks")
    for _ in range(rounds):
        centroids = _moved(blocks, centroids)

    def assign(batches):
        for ids, _, cluster, distance in _assigned(batches, centroids):
            yield as_batch({"vec_id": pa.array(ids), "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array(distance)})

    found = freeze(blocks.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # a row per centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = int(sum(r["d"] for r in sums))
    rows = [(r["cluster"], int(r["d"]), total, digest[r["cluster"]]) for r in sums]
    per = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
