"""Centroid clustering on bit planes.

A vector of 64 integers in two's complement is a stack of bit planes: plane i holds bit i of all
64 components in one 64-bit word, and the last plane is the sign. The dot product of two vectors
is the sum, over all pairs of their planes, of the popcount of the planes' AND, weighted with
2^(i+j) and negated where exactly one of the two is a sign plane. Squared distances follow as
|x|^2 - 2xc + |c|^2. All of it is integer arithmetic, so results don't depend on how rows are
dealt.

Vectors are packed once and written; every round reads the planes, and centroids travel as a few
thousand integers. Each task adds up its own vectors by cluster, so what is shuffled and reaches
the driver has the size of the centroids, whatever the number of vectors or the largest cluster.

Defined cases: vectors that are null, don't have 64 components, or hold a null or a value that is
not finite are left out; repeated rows and ids stay, each with its result; rows without an id are
clustered but come last among possible first centroids; with fewer vectors than centroids there
are as many centroids as vectors, and an empty table gives an empty result. Components are held
within +-2^24 after scaling, so that distances fit 64 bits; a sum of distances that does not is
null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped, stash

COMPONENTS = 64
SCALE = 256
LARGEST = 1 << 24
CENTROIDS, ROUNDS, SEED = 40, 5, "2"
#: Vectors that a task works on at once.
BLOCK = 4096

_BIT = np.arange(COMPONENTS, dtype=np.uint64)


def packed_planes(values: np.ndarray) -> np.ndarray:
    """The bit planes (planes x vectors) of integers (vectors x 64), the sign plane last."""
    reach = np.maximum(values, ~values).max(initial=0)
    n = int(reach).bit_length() + 1
    bits = (values[None, :, :] >> np.arange(n)[:, None, None]) & 1
    return (bits.astype(np.uint64) << _BIT).sum(axis=2, dtype=np.uint64)


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The integers (vectors x 64) of bit planes (planes x vectors)."""
    bits = ((planes[:, :, None] >> _BIT) & np.uint64(1)).astype(np.int64)
    return np.tensordot(weights(len(planes)), bits, axes=1)


def weights(n: int) -> np.ndarray:
    out = np.left_shift(np.int64(1), np.arange(n, dtype=np.int64))
    out[-1] = -out[-1]
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of the vectors of planes ``a`` with the one vector of planes ``b``."""
    out = np.zeros(a.shape[1], np.int64)
    for plane, w in zip(b, weights(len(b))):
        # Counts are at most 64, so a byte each; weights of ``a`` are applied to the sums.
        out += w * (weights(len(a)) @ np.bitwise_count(a & plane).astype(np.int64))
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """|x|^2 of every vector, from its planes ANDed with each other."""
    w = weights(len(planes))
    out = np.zeros(planes.shape[1], np.int64)
    for i in range(len(planes)):
        out += w[i] * w[i] * np.bitwise_count(planes[i]).astype(np.int64)
        for j in range(i):
            out += 2 * w[i] * w[j] * np.bitwise_count(planes[i] & planes[j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: list[np.ndarray], norms: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every vector the smallest number of a nearest centroid, and its squared distance."""
    own = squares(planes)
    cluster = np.zeros(planes.shape[1], np.int32)
    least = np.full(planes.shape[1], np.iinfo(np.int64).max)
    for k, (c, norm) in enumerate(zip(centroids, norms)):
        d = own - 2 * dots(planes, c) + norm
        closer = d < least
        least[closer], cluster[closer] = d[closer], k
    return cluster, least


def usable(vectors: Column) -> Column:
    """Whether a vector has 64 components, none of them null or not finite."""
    infinite = F.lit(float("inf"))
    return (F.size(vectors) == COMPONENTS) & F.forall(
        vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))


def pack(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, planes) of the usable vectors; a row has the planes that its task's largest value needs."""
    kept = vectors.filter(F.coalesce(usable(F.col(column)), F.lit(False))).select(
        F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("v"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                v = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(SCALE * v), -LARGEST, LARGEST).astype(np.int64)
                planes = packed_planes(whole)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(planes)], ["id", "planes"])

    return shipped(kept).mapInArrow(rows, "id long, planes array<long>")


def _lists(planes: np.ndarray) -> pa.ListArray:
    n, m = planes.shape
    flat = pa.array(np.ascontiguousarray(planes.T).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, n, dtype=np.int32)), flat)


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their planes; rows with fewer planes repeat their sign."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        lists = part.column(column)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        first = np.cumsum(lengths) - lengths
        place = np.minimum(np.arange(lengths.max())[:, None], lengths[None, :] - 1)
        yield part, flat[first[None, :] + place]


def first_centroids(packed: DataFrame, count: int, seed: str) -> np.ndarray:
    """The vectors whose salted id hashes lowest, in that order; equal ones by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = packed.orderBy(key.asc_nulls_last(), "planes").limit(count).collect()
    values = [unpacked(np.array(r["planes"], np.int64).view(np.uint64)[:, None])[0] for r in chosen]
    return np.array(values, np.int64).reshape(-1, COMPONENTS)


def sums_by_cluster(packed: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, n, sums) of the vectors nearest to each centroid; as many rows as centroids."""
    planes, norms = _as_planes(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(planes), np.int64)
        total = np.zeros((len(planes), COMPONENTS), np.int64)
        for batch in batches:
            for _, block in _blocks(batch, 0):
                cluster, _ = nearest(block, planes, norms)
                n += np.bincount(cluster, minlength=len(planes))
                np.add.at(total, cluster, unpacked(block))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(seen, COMPONENTS).astype(np.int32)), pa.array(np.tile(np.arange(COMPONENTS, dtype=np.int32), len(seen))),
             pa.array(np.repeat(n[seen], COMPONENTS)), pa.array(total[seen].ravel())], ["cluster", "place", "n", "total"])

    parts = shipped(packed).select("planes").mapInArrow(rows, "cluster int, place int, n long, total long")
    return parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()


def _as_planes(centroids: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    planes = [packed_planes(c[None, :])[:, 0] for c in centroids]
    return planes, [int((c * c).sum()) for c in centroids]


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """Centroids of the next round: exact floors of the means, empty clusters as they were."""
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["place"]] = r["total"] // r["n"]
    return out


def assign(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    planes, norms = _as_planes(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in _blocks(batch, 1):
                cluster, distance = nearest(block, planes, norms)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return shipped(packed).select("id", "planes").mapInArrow(rows, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the usable vectors."""
    packed = stash(pack(vectors), "planes")
    centroids = first_centroids(packed, count, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, sums_by_cluster(packed, centroids))
    placed = stash(assign(packed, centroids), "assigned")
    found = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.try_sum("distance").alias("inertia")).collect()}
    whole = placed.agg(F.try_sum("distance")).first()[0]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))

    return placed.select(
        F.col("id").alias("vec_id"), "cluster", "distance",
        of_cluster([found.get(k) for k in range(len(digests))], "bigint").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))
