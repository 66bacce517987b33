"""Centroid clustering by Lloyd's rounds with sharded dimensions, exact in whole numbers.

Vectors are cut into chunks of rows and shards of columns; a block is one chunk in one shard. A
round has two steps:

1. Every block's task computes the partial squared distances of its rows to its shard's slice of
   the centroids; ``reduceByKey`` adds the partial distances of a chunk, and the least wins.
2. The winners go back to the blocks, which stay where they were dealt; each shard sums its columns by
   cluster and replaces its own slice of the centroids.

A task holds one block and one slice at a time, so neither vectors nor centroids need to fit whole. Only the slices,
``clusters`` x dimensions numbers, pass the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import stored


@dataclass(frozen=True)
class LloydConfig:
    """Blocks of ``chunk_vectors`` x ``shard_columns`` numbers, ``blocks_per_task`` of them to a task."""

    clusters: int = 16
    rounds: int = 3
    width: int = 64
    scale: int = 64
    salt: str = "1"
    shard_columns: int = 16
    chunk_vectors: int = 4096
    blocks_per_task: int = 64

    def __post_init__(self) -> None:
        if not 1 <= self.clusters <= 65_535 or self.rounds < 0 or min(self.width, self.shard_columns, self.chunk_vectors) < 1:
            raise ValueError("clusters within 1 to 65535, rounds from 0, width, columns and vectors from 1")


#: Up to here in size, sums of squared differences stay exact in doubles; larger numbers are Python's integers.
PLAIN = 1 << 20
MOST = (1 << 63) - 1

BLOCKS = "chunk bigint, shard int, ids array<bigint>, n int, wide boolean, numbers binary"


def kept_vectors(vectors: DataFrame, config: LloydConfig) -> DataFrame:
    """(vec_id, embedding) of vectors with the right width and only finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(math.inf)))
    return vectors.select("vec_id", "embedding").filter((F.size("embedding") == config.width) & finite)


def whole_numbers(raw: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers where they hold it exactly, else Python's."""
    scaled = scale * raw
    if np.abs(scaled).max(initial=0) < PLAIN:
        return np.floor(scaled).astype(np.int64)
    # from 2**53 on a double is a whole number, and so is its product
    exact = [math.floor(scale * x) if abs(scale * x) < 2.0**53 else scale * int(x) for x in raw.ravel().tolist()]
    return np.array(exact, object).reshape(raw.shape)


def packed(numbers: np.ndarray) -> tuple[bool, bytes]:
    wide = numbers.dtype == object
    return wide, " ".join(map(str, numbers.ravel())).encode() if wide else numbers.tobytes()


def unpacked(wide: bool, content: bytes, n: int) -> np.ndarray:
    flat = np.array([int(x) for x in content.split()], object) if wide else np.frombuffer(content, np.int64)
    return flat.reshape(n, -1)


def cut_blocks(config: LloydConfig) -> Callable:
    """Rows of (row, vec_id, embedding) to blocks; the first shard's blocks carry the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("chunk", pa.int64()), ("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("n", pa.int32()),
            ("wide", pa.bool_()), ("numbers", pa.binary()),
        ])
        for batch in batches:
            for at in range(0, batch.num_rows, config.chunk_vectors):
                part = batch.slice(at, config.chunk_vectors)
                raw = np.asarray(part.column("embedding").flatten().to_numpy(zero_copy_only=False), np.float64)
                numbers = whole_numbers(raw.reshape(part.num_rows, config.width), config.scale)
                chunk, ids = part.column("row")[0].as_py(), part.column("vec_id").to_pylist()
                rows = []
                for shard, first in enumerate(range(0, config.width, config.shard_columns)):
                    wide, content = packed(numbers[:, first : first + config.shard_columns])
                    rows.append({
                        "chunk": chunk, "shard": shard, "ids": None if shard else ids, "n": part.num_rows, "wide": wide, "numbers": content,
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def seeds(kept: DataFrame, config: LloydConfig) -> np.ndarray:
    """The centroids to start from: the vectors with the smallest digests, in their order."""
    digest = F.sha2(F.concat(F.lit(f"{config.salt}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "embedding").limit(config.clusters).collect()  # as many as clusters
    raw = np.array([row.embedding for row in first], np.float64).reshape(len(first), config.width)
    return whole_numbers(raw, config.scale).astype(object)


def plain(numbers: np.ndarray) -> np.ndarray:
    """As 64-bit integers if all are small enough for exact sums of squares."""
    return numbers.astype(np.int64) if max(map(abs, numbers.ravel()), default=0) < PLAIN else numbers


def partial_distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of a block's rows to a slice of the centroids, exact."""
    if object in (block.dtype, centroids.dtype):
        block = block.astype(object)
        return np.array([((block - c) ** 2).sum(axis=1) for c in centroids.astype(object)], object).T
    x, c = block.astype(np.float64), centroids.astype(np.float64)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def cluster_sums(block: np.ndarray, nearest: np.ndarray, clusters: int) -> np.ndarray:
    """Sums of a block's rows by cluster."""
    out = np.zeros((clusters, block.shape[1]), block.dtype)
    np.add.at(out, nearest, block)
    return out.astype(object)


def place(key: tuple[int, int] | int) -> int:
    """The task of a block, or of a chunk or shard: the same in every round, so blocks are dealt once."""
    return xxhash.xxh3_64_intdigest(repr(key))


class Lloyd:
    """Rounds over blocks that were dealt to tasks once."""

    def __init__(self, blocks: DataFrame, config: LloydConfig) -> None:
        self.config, self.context = config, blocks.sparkSession.sparkContext
        self.shards = -(-config.width // config.shard_columns)
        tasks = max(1, min(n := blocks.count(), max(self.context.defaultParallelism, -(-n // config.blocks_per_task))))
        self.blocks = blocks.rdd.map(
            lambda r: ((r.chunk, r.shard), (r.ids, unpacked(r.wide, bytes(r.numbers), r.n)))
        ).partitionBy(tasks, place)
        self.tasks = self.blocks.getNumPartitions()

    def slices(self, centroids: np.ndarray) -> list:
        """One broadcast for each shard, fetched only by tasks that hold its blocks."""
        w = self.config.shard_columns
        return [self.context.broadcast(plain(centroids[:, s * w : (s + 1) * w])) for s in range(self.shards)]

    def distances(self, slices: list) -> RDD:
        """(chunk, (ids, distances to every centroid)): the partial distances of the shards, added."""

        def partial(rows: Iterator) -> Iterator:
            for (chunk, shard), (ids, block) in rows:
                yield chunk, (ids, partial_distances(block, slices[shard].value))

        def add(a: tuple, b: tuple) -> tuple:
            return a[0] if a[0] is not None else b[0], a[1] + b[1]

        return self.blocks.mapPartitions(partial).reduceByKey(add, self.tasks, place)

    def moved(self, slices: list) -> np.ndarray:
        """The centroids after one round."""
        shards, clusters = self.shards, len(slices[0].value)
        asked = self.distances(slices).flatMap(
            lambda row: [((row[0], s), row[1][1].argmin(axis=1).astype(np.uint16)) for s in range(shards)]
        ).partitionBy(self.tasks, place)
        both = asked.union(self.blocks)  # dealt alike, so a task has the winners of its blocks first, then the blocks
        if both.getNumPartitions() != self.tasks:
            raise RuntimeError("blocks and winners were dealt to different tasks")

        def by_shard(rows: Iterator) -> Iterator:
            nearest, out = {}, {}
            for key, value in rows:
                if isinstance(value, np.ndarray):
                    nearest[key] = value
                else:
                    own = nearest.pop(key)
                    sums, counts = out.get(key[1], (0, 0))
                    out[key[1]] = (
                        sums + cluster_sums(value[1], own, clusters), counts + np.bincount(own, minlength=clusters).astype(object),
                    )
            yield from out.items()

        def update(row: tuple) -> tuple:
            shard, (sums, counts) = row
            new = slices[shard].value.astype(object)
            some = counts > 0
            new[some] = sums[some] // counts[some][:, None]  # Python's integers: exact, rounded down
            return shard, new

        added = both.mapPartitions(by_shard).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), self.tasks, place)
        new = added.map(update).collectAsMap()  # the centroids
        return np.concatenate([new[s] for s in range(shards)], axis=1)


def cluster(vectors: DataFrame, config: LloydConfig = LloydConfig()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that can be clustered, and the final centroids.

    Left out: null vectors, those of another width and those with a null or non-finite component. A vector with a null
    id is clustered, and starts a centroid only if too few have ids. Repeated rows count as often as they occur. Fewer
    vectors than clusters: each starts a centroid. No vector: no row and no centroid. Ties go to the smaller number; a
    centroid without vectors stays. Sums and distances are exact at any size; a distance over 64 bits is
    returned as the largest such number. Only vec_id and embedding are read.
    """
    kept = kept_vectors(vectors, config)
    rows = kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    blocks = stored(rows.mapInArrow(cut_blocks(config), BLOCKS), "blocks")
    centroids, run = seeds(kept, config), Lloyd(blocks, config)
    kinds = "ids array<bigint>, cluster array<int>, distance array<bigint>"
    if not len(centroids):
        return blocks.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    for _ in range(config.rounds):
        centroids = run.moved(run.slices(centroids))

    def winners(row: tuple) -> tuple:
        _, (ids, distances) = row
        nearest = distances.argmin(axis=1)
        return ids, nearest.tolist(), [min(int(d), MOST) for d in distances[np.arange(len(nearest)), nearest]]

    found = blocks.sparkSession.createDataFrame(run.distances(run.slices(centroids)).map(winners), kinds)
    each = found.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("v"))
    return stored(each.select(F.col("v.ids").alias("vec_id"), "v.cluster", "v.distance"), "clustered"), centroids


def cluster_report(vectors: DataFrame, config: LloydConfig = LloydConfig()) -> DataFrame:
    """One row per clustered vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Inertia is the sum of the squared distances, over the cluster and over all; one over 64 bits is the largest such
    number. The digest is of the centroid's components as decimals joined by commas. Rows as in ``cluster``.
    """
    found, centroids = cluster(vectors, config)
    totals = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum")).collect()  # one per cluster
    everything = min(sum(int(r["sum"]) for r in totals), MOST)
    named = [
        (r.cluster, min(int(r["sum"]), MOST), everything, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest())
        for r in totals
    ]
    table = found.sparkSession.createDataFrame(
        named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.join(F.broadcast(table), "cluster").select(  # at most ``clusters`` rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
