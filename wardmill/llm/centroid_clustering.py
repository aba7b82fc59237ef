"""Centroid clustering (Lloyd's rounds in whole numbers) over dictionaries of subvectors.

Components are scaled and floored to whole numbers. Vectors are held in chunks; in a chunk each block of neighbouring
dimensions is dictionary-encoded without loss: its distinct subvectors once, and a code per vector. In a round a chunk
works out the squared distance of each distinct subvector to its part of every centroid once; a vector's distances are
the sums of these partial distances by its codes. The new centroids' sums come from the counts of codes per cluster,
times the dictionary. All of it is exact. A chunk's dictionaries are never larger than the chunk, whatever the data, so nothing about
the vectors has to be broadcast; a vector that a third of the rows have costs one dictionary entry per chunk.

Rows whose vector is null, has another length, or has a null, NaN or infinite component are left out. Scaled components
beyond 2^24 in size are taken as +-2^24, so that distances and sums fit 64 bits. Repeated ids are vectors of their own; ties for a first centroid go by the
vector. A null id hashes as the text ``null``. With fewer vectors than clusters each vector is a first centroid; without
vectors the result is empty. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
#: Neighbouring dimensions of a block, and vectors of a chunk.
BLOCK, CHUNK = 2, 16_384
#: Scaled components are at most this large.
LARGEST = 1 << 24
ENCODED = "ids array<long>, n int, codes binary, dictionary binary, sizes array<int>"


def usable(vectors: DataFrame, dimensions: int = DIMENSIONS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and the scaled components of the vectors that count."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kept = kept.where((F.size("v") == dimensions) & finite)
    scaled = F.transform("v", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), x * SCALE))))).cast("int"))
    return kept.select("vec_id", scaled.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; the driver gets ``clusters`` rows."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def encode(values: np.ndarray, block: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(codes per vector, distinct subvectors) for every block of dimensions."""
    codes, entries = [], []
    for at in range(0, values.shape[1], block):
        part = np.ascontiguousarray(values[:, at : at + block])
        width = part.dtype.itemsize * part.shape[1]
        whole = part.view({4: np.int32, 8: np.int64}.get(width, np.dtype((np.void, width)))).ravel()
        _, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
        codes.append(inverse.ravel().astype(np.int32))
        entries.append(part[first])
    return codes, entries


def encoded(vectors: DataFrame, dimensions: int = DIMENSIONS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk of vectors: ids, their codes block by block, and the blocks' distinct subvectors."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0

        def out() -> pa.RecordBatch:
            codes, entries = encode(np.concatenate(held), block)
            return pa.record_batch(
                [
                    pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                    pa.array([n], pa.int32()),
                    pa.array([np.concatenate(codes).tobytes()], pa.binary()),
                    pa.array([b"".join(e.tobytes() for e in entries)], pa.binary()),
                    pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
                ],
                names=["ids", "n", "codes", "dictionary", "sizes"],
            )

        for b in batches:
            values = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dimensions)
            for at in range(0, b.num_rows, chunk):
                ids.append(b.column(0).slice(at, chunk))
                held.append(values[at : at + chunk])
                n += len(held[-1])
                if n >= chunk:
                    yield out()
                    ids, held, n = [], [], 0
        if n:
            yield out()

    return vectors.select("vec_id", "v").mapInArrow(work, ENCODED)


def chunks(batch: pa.RecordBatch, dimensions: int, block: int) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray]]]:
    """(ids, codes, entries) of every chunk in the batch of ENCODED."""
    for i in range(batch.num_rows):
        codes = np.frombuffer(batch.column(2)[i].as_buffer(), np.int32).reshape(-1, batch.column(1)[i].as_py())
        flat, entries, at = np.frombuffer(batch.column(3)[i].as_buffer(), np.int32), [], 0
        for k, size in enumerate(batch.column(4)[i].as_py()):
            width = min(block, dimensions - k * block)
            entries.append(flat[at : at + size * width].reshape(size, width))
            at += size * width
        yield batch.column(0)[i].values, list(codes), entries


def nearest(codes: list[np.ndarray], entries: list[np.ndarray], centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of every vector; the smaller number in a tie."""
    total = np.zeros((len(codes[0]), len(centroids)), np.int64)
    for k, (code, entry) in enumerate(zip(codes, entries, strict=True)):
        part = centroids[:, k * block : k * block + entry.shape[1]]
        table = np.zeros((len(entry), len(centroids)), np.int64)
        for d in range(entry.shape[1]):
            step = entry[:, d].astype(np.int64)[:, None] - part[:, d][None, :]
            table += step * step
        total += table[code]
    best = total.argmin(1)
    return best, total[np.arange(len(best)), best]


def moved(chunked: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The centroids after one round; the driver gets one row per cluster."""
    clusters, dimensions = centroids.shape

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((clusters, dimensions), np.int64), np.zeros(clusters, np.int64)
        for b in batches:
            for _, codes, entries in chunks(b, dimensions, block):
                best, _ = nearest(codes, entries, centroids, block)
                counts += np.bincount(best, minlength=clusters)
                for k, (code, entry) in enumerate(zip(codes, entries, strict=True)):
                    seen, times = np.unique(best * len(entry) + code, return_counts=True)
                    part = entry[seen % len(entry)].astype(np.int64) * times[:, None]
                    np.add.at(sums[:, k * block : k * block + entry.shape[1]], seen // len(entry), part)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held), pa.array(counts[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = chunked.mapInArrow(work, "cluster long, n long, sums array<long>")
    # decimals: a cluster's sum over all vectors has no bound
    whole = [F.sum(F.col("sums")[d].cast("decimal(20,0)")).alias(f"s{d}") for d in range(dimensions)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():
        out[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dimensions)]
    return out


def assigned(chunked: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    dimensions = centroids.shape[1]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, codes, entries in chunks(b, dimensions, block):
                best, distance = nearest(codes, entries, centroids, block)
                yield pa.record_batch([ids, pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return chunked.mapInArrow(work, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, block: int = BLOCK, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every vector that counts; the final centroids)."""
    spark = vectors.sparkSession
    kept = usable(vectors, dimensions)
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dimensions), np.int64)
    chunked = written(encoded(kept, dimensions, block, chunk), "chunks")
    for _ in range(rounds):
        centroids = moved(chunked, centroids, block)
    return assigned(chunked, centroids, block), centroids


def cluster_digests(vectors: DataFrame, **options) -> DataFrame:
    """clustered() with each cluster's and the whole inertia and a checksum of the vector's centroid."""
    rows, centroids = clustered(vectors, **options)
    rows = written(rows, "assigned")
    spark = rows.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    whole = min(most, sum(sums.values()))
    named = [(k, min(most, s), whole, hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k, s in sums.items()]
    table = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
