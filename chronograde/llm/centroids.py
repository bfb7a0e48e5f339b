"""Clustering of integer vectors by Lloyd rounds that are sharded over the dimensions.

Vectors are cut into chunks of rows and each chunk into blocks of columns. A task holds blocks; it computes the exact partial
distances of a chunk's rows to the centroids within its columns. The partial distances of a chunk are added by key over
its blocks, the smallest sum gives the assignment, and each block then adds up its own columns by cluster, which updates
its own slice of the centroids. All arithmetic is on integers, so results don't depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde.llm.common import stage

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: Columns of a block and rows of a chunk.
WIDTH = 16
CHUNK = 4096
#: Scaled components must be smaller, so that a squared distance over all dimensions fits 64 bits.
LARGEST = 1 << 27
#: Vectors of a bucket, at least (64 columns of 16 bits: 128 MB).
BUCKET_ROWS = 1 << 20
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """True for vectors of the right length without null, infinite or undefined components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers, floor of ``scale`` times the component; fails on vectors whose distances would not fit."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) * float(scale) < float(LARGEST - 1))
    return F.when(small, whole).otherwise(F.raise_error(F.lit(f"a component times {scale} is not below {LARGEST - 1}")).cast("array<bigint>"))


def _start(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, in order of the hash, then of the vector; null ids come last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _pack(x: np.ndarray) -> bytes:
    """Numbers in the narrowest of three widths that holds them, with the width's letter before them."""
    top = int(np.abs(x).max(initial=0))
    kind = "h" if top < 1 << 15 else "i" if top < 1 << 31 else "q"
    return kind.encode() + np.ascontiguousarray(x).astype(f"<{ {'h': 'i2', 'i': 'i4', 'q': 'i8'}[kind] }").tobytes()


def _unpack(data: bytes, rows: int) -> np.ndarray:
    kind = {b"h": "<i2", b"i": "<i4", b"q": "<i8"}[data[:1]]
    return np.frombuffer(data, kind, offset=1).astype(np.int64).reshape(rows, -1)


def _blocks(vectors: DataFrame, dimensions: int) -> DataFrame:
    """One row for each chunk and block: ids (first block only) and the block's columns as bytes, column after column."""
    cuts = list(range(0, dimensions, WIDTH))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids, v = part.column(0), part.column(1).flatten().to_numpy().reshape(part.num_rows, dimensions)
                yield pa.RecordBatch.from_arrays([
                    pa.array([task << 32 | made] * len(cuts), pa.int64()), pa.array([c // WIDTH for c in cuts], pa.int32()),
                    pa.array([ids.to_pylist()] + [None] * (len(cuts) - 1), pa.list_(pa.int64())),
                    pa.array([_pack(v[:, c:c + WIDTH].T) for c in cuts], pa.binary())],
                    names=["chunk", "block", "ids", "data"])
                made += 1

    return vectors.select("vec_id", "v").mapInArrow(run, "chunk bigint, block int, ids array<bigint>, data binary")


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``chunk``, ``cluster`` and ``distance`` (bytes of one number a row): block distances, added by chunk, smallest sum."""
    k, dimensions = centroids.shape
    width = lambda b: min(WIDTH, dimensions - b * WIDTH)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = _unpack(data, width(b))
                own = centroids[:, b * WIDTH:b * WIDTH + width(b)]
                sums = np.zeros((k, x.shape[1]), np.int64)
                for column, c in zip(x, own.T):
                    sums += (column[None, :] - c[:, None]) ** 2
                out.append(_pack(sums))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["chunk", "part"])

    def added(table: pa.Table) -> pa.Table:
        total = 0
        for p in table.column("part").to_pylist():
            total = total + _unpack(p, k)
        nearest = total.argmin(axis=0)  # the smaller number where two are equal
        distance = total[nearest, np.arange(total.shape[1])]
        return pa.table({"chunk": table.column("chunk")[:1], "cluster": pa.array([nearest.astype("<i4").tobytes()], pa.binary()),
                         "distance": pa.array([distance.astype("<i8").tobytes()], pa.binary())})

    parts = blocks.select("chunk", "block", "data").mapInArrow(partial, "chunk bigint, part binary")
    return parts.groupBy("chunk").applyInArrow(added, "chunk bigint, cluster binary, distance binary")


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: every block sums its columns by cluster; clusters without rows stay."""
    k, dimensions = centroids.shape
    width = lambda b: min(WIDTH, dimensions - b * WIDTH)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data, cluster in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x, own = _unpack(data, width(b)), np.frombuffer(cluster, "<i4")
                at, n = total.setdefault(b, np.zeros((k, width(b)), np.int64)), count.setdefault(b, np.zeros(k, np.int64))
                n += np.bincount(own, minlength=k)
                for c in np.unique(own):
                    at[c] += x[:, own == c].sum(axis=1)
        rows = [(b, c, b * WIDTH + j, int(total[b][c, j]), int(count[b][c])) for b in total for c in range(k) for j in range(width(b))]
        yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5,
                                         names=["block", "cluster", "at", "total", "n"])

    joined = blocks.select("chunk", "block", "data").join(_assigned(blocks, centroids).select("chunk", "cluster"), "chunk")
    slices = joined.select("block", "data", "cluster").mapInArrow(sums, "block bigint, cluster bigint, at bigint, total bigint, n bigint")
    out = centroids.copy()
    for r in slices.groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # clusters x dimensions
        if r["n"]:
            out[r["cluster"], r["at"]] = r["total"] // r["n"]  # floor, also below zero
    return out


def cluster(vectors: DataFrame, column: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every usable vector.

    Null vectors and those of another length or with a null, infinite or undefined component are left out, as in
    ``usable``; repeated rows are clustered and returned each; a null id is clustered like any other but starts a centroid
    only if ids run out. With fewer than ``k`` vectors there are as many centroids; without any the result is empty. Further
    columns are ignored. Ties go to the smaller cluster number. Only the centroids, ``k`` times ``dimensions`` numbers,
    pass through the driver. Blocks are written once, in buckets of their chunk, so that a round shuffles partial distances
    and assignments but never the vectors.
    """
    spark = vectors.sparkSession
    v = F.col(column)
    kept = vectors.where(usable(v, dimensions)).select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled(v, scale).alias("v"))
    centroids = _start(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), kept.count() // BUCKET_ROWS)
    name = f"llm_blocks_{uuid.uuid4().hex}"
    try:
        _blocks(kept, dimensions).repartition(buckets, "chunk").write.format("parquet").bucketBy(buckets, "chunk").sortBy("chunk").saveAsTable(name)
        blocks = spark.table(name)
        for _ in range(rounds):
            centroids = _moved(blocks, centroids)
        found = stage(spark, _rows(blocks, centroids), "clusters")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # one number a cluster
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    each = spark.createDataFrame([(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()],
                                 "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rows(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, cluster, distance in zip(*(batch.column(i) for i in range(3))):
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.frombuffer(cluster.as_py(), "<i4")), pa.array(np.frombuffer(distance.as_py(), "<i8"))],
                    names=["vec_id", "cluster", "distance"])

    ids = blocks.where("block = 0").select("chunk", "ids")
    return ids.join(_assigned(blocks, centroids), "chunk").select("ids", "cluster", "distance") \
        .mapInArrow(run, "vec_id bigint, cluster int, distance bigint")
