"""Lloyd's clustering, sharded by dimension.

Vectors become whole numbers, ``floor(scale * x)``, and are stored once as column
blocks: a block holds a few dimensions of one chunk of vectors.  A round is three
steps over them.  A task of a column block fetches its slice of the centroids and
computes the exact partial squared distances of its vectors; ``reduceByKey`` adds
the partial distances of a chunk, after which the nearest centroid is an argmin;
the labels go back to the chunk's blocks, where each column block adds up its own
dimensions per cluster and makes its own slice of the next centroids.

Blocks are dealt by (chunk, block) once, so labels meet them without moving them
again.  What passes the driver is one slice per column block and round, ``k`` times
the number of dimensions in all, whatever the number of vectors.  Each round starts
from those numbers and the stored blocks, so its lineage does not grow and a lost
executor costs its own part of one round.

Distances are exact: values up to 2^22 use double arithmetic, which is exact
there, larger ones Python's integers.  A distance or inertia beyond 63 bits is
NULL.  Vectors that are NULL, of another length, or with a NULL or non-finite
component are left out.  A vector with a NULL id is clustered but never starts a
centroid; rows that repeat an id count as often as they occur, and may start
several equal centroids, of which the later ones stay empty.  Ties go to the
smaller centroid number.  With fewer than ``k`` vectors there are as many
centroids; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.storage import cut

DIMS, BLOCK_DIMS = 64, 16
CLUSTERS, ROUNDS, SCALE, SEED = 40, 5, 256, 2
CHUNK = 2048  # vectors whose partial distances are added at once
EXACT = 1 << 22  # squared distances of values up to this are exact in doubles, up to 64 dimensions
LONG = (1 << 63) - 1
SHARES = 64  # tasks that add up a column block's sums before they meet

Slice = np.ndarray  # (k, dimensions of one block)


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the least type that holds them."""
    if values.dtype != object:
        top = int(np.abs(values).max(initial=0))
        for kind in (np.int8, np.int16, np.int32):
            if top <= np.iinfo(kind).max:
                return np.dtype(kind).str, values.astype(kind).tobytes()
        return "<i8", values.astype("<i8").tobytes()
    return "text", ",".join(map(str, values.ravel())).encode()


def unpacked(kind: str, data: bytes, width: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(x) for x in data.split(b",")], object).reshape(-1, width)
    return np.frombuffer(data, kind).reshape(-1, width)


def _wide(values: np.ndarray) -> bool:
    return values.dtype == object or bool(len(values)) and int(np.abs(values.astype(np.int64)).max()) > EXACT


def partial_distances(block: np.ndarray, centroids: Slice) -> np.ndarray:
    """Squared distances of every row to every centroid over a block's dimensions."""
    if _wide(block) or _wide(centroids):
        b, c = block.astype(object), centroids.astype(object)
        return np.stack([((b - row) ** 2).sum(axis=1) for row in c], axis=1)
    b, c = block.astype(np.float64), centroids.astype(np.float64)
    return ((b * b).sum(axis=1)[:, None] - 2 * (b @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def _narrow(distances: np.ndarray) -> np.ndarray:
    if distances.dtype != object and distances.max(initial=0) < 1 << 32:
        return distances.astype(np.uint32)
    return distances


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype == object or b.dtype == object:
        return a.astype(object) + b.astype(object)
    return _narrow(a.astype(np.int64) + b.astype(np.int64))


def cluster_sums(block: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(count per cluster, sum per cluster and dimension)."""
    sums = np.zeros((k, block.shape[1]), block.dtype if block.dtype == object else np.int64)
    np.add.at(sums, labels, block)
    return np.bincount(labels, minlength=k), sums


def next_slice(old: Slice, counts: np.ndarray, sums: np.ndarray) -> Slice:
    """floor(sum / count); empty clusters keep their values."""
    full = counts > 0
    out = old.astype(object if sums.dtype == object or old.dtype == object else np.int64)
    out[full] = sums[full] // counts[full, None]
    return out


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id, x) of the vectors that count, as doubles."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("x"))
    usable = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(math.inf), F.lit(False)) & ~F.isnan(v))
    return rows.where((F.size("x") == dims) & usable)


def floors(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x)."""
    if np.abs(x).max(initial=0) < 1 << 40:
        return np.floor(x * float(scale)).astype(np.int64)
    return np.array([math.floor(Fraction(v) * scale) for v in x.ravel().tolist()], object).reshape(x.shape)


_BLOCKS = "chunk bigint, block int, kind string, data binary, ids binary"
_BLOCK_TYPES = pa.schema(
    [("chunk", pa.int64()), ("block", pa.int32()), ("kind", pa.string()), ("data", pa.binary()), ("ids", pa.binary())]
)


def _split(dims: int, width: int, scale: int):
    """Batches of vectors to column blocks; the first block carries the ids."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                whole = floors(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                ids = part.column(0)
                names = ids.is_valid().to_numpy(zero_copy_only=False).tobytes() + pc.fill_null(ids, 0).to_numpy().tobytes()
                rows = []
                for block, first in enumerate(range(0, dims, width)):
                    rows.append((chunk, block, *packed(whole[:, first : first + width]), None if block else names))
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _BLOCK_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, schema=_BLOCK_TYPES)
                chunk += 1

    return split


def start(rows: DataFrame, k: int, dims: int, scale: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.where("id is not null").orderBy(order, "x").limit(k).collect()
    return floors(np.array([r.x for r in first], np.float64).reshape(-1, dims), scale)


class Shards:
    """The stored blocks of all vectors, dealt by (chunk, column block)."""

    def __init__(self, table: DataFrame, dims: int, width: int):
        self.context = table.sparkSession.sparkContext
        self.borders = list(range(0, dims, width))
        self.width, self.dims, count = width, dims, len(self.borders)
        parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A task of a multiple of the blocks' number reads one column block.
        self.parts = -(-parts // count) * count
        self.place = lambda key: (key[0] * 0x9E3779B1 % (1 << 32)) * count + key[1]
        rows = table.rdd.map(lambda r: ((r.chunk, r.block), (r.kind, bytes(r.data), r.ids and bytes(r.ids))))
        self.blocks = rows.partitionBy(self.parts, self.place)

    def widths(self) -> list[int]:
        return [min(self.width, self.dims - first) for first in self.borders]

    def distances(self, slices: list, with_ids: bool = False) -> RDD:
        """(chunk, (squared distances to all centroids, ids or None)): partial
        distances per column block, added by chunk."""
        widths = self.widths()

        def partial(row):
            (chunk, block), (kind, data, ids) = row
            found = partial_distances(unpacked(kind, data, widths[block]), slices[block].value)
            return chunk, (_narrow(found), ids if with_ids else None)

        return self.blocks.map(partial).reduceByKey(lambda a, b: (_add(a[0], b[0]), a[1] or b[1]), self.parts)

    def next_slices(self, slices: list, k: int) -> list[Slice]:
        """Every column block's slice of the next centroids."""
        count, widths = len(self.borders), self.widths()
        labels = self.distances(slices).flatMap(
            lambda row: [((row[0], block), row[1][0].argmin(axis=1).astype(np.uint32)) for block in range(count)]
        )

        def sums(rows):
            held: dict[int, tuple] = {}
            for (_, block), (blocks, found) in rows:
                for (kind, data, _), own in zip(blocks, found):
                    made = cluster_sums(unpacked(kind, data, widths[block]), own, k)
                    held[block] = _both(held[block], made) if block in held else made
            share = TaskContext.get().partitionId() % SHARES
            return [((block, share), made) for block, made in held.items()]

        met = self.blocks.cogroup(labels.partitionBy(self.parts, self.place), self.parts)
        shares = met.mapPartitions(sums).reduceByKey(_both, min(SHARES, self.parts))
        totals = shares.map(lambda row: (row[0][0], row[1])).reduceByKey(_both, count)
        made = dict(totals.map(lambda row: (row[0], next_slice(slices[row[0]].value, *row[1]))).collect())
        return [made[block] for block in range(count)]


def _both(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


_NEAREST = "vec_id bigint, cluster int, distance bigint"


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
            n = len(ids) // 9
            valid = np.frombuffer(ids[:n], bool)
            found = unpacked(kind, data, 1).ravel()
            far = [int(d) if d <= LONG else None for d in found] if found.dtype == object else found.astype(np.int64)
            columns = [
                pa.array(np.frombuffer(ids[n:], np.int64), mask=~valid),
                pa.array(np.frombuffer(labels, np.uint32).astype(np.int32)),
                pa.array(far, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])


def clustered(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    dims: int = DIMS,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
    width: int = BLOCK_DIMS,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector, final centroids)."""
    spark = df.sparkSession
    rows = whole_vectors(df, id_col, vec_col, dims)
    centroids = start(rows, k, dims, scale, seed)
    if not len(centroids):
        return spark.createDataFrame([], _NEAREST), centroids
    shards = Shards(cut(rows.mapInArrow(_split(dims, width, scale), _BLOCKS)), dims, width)
    slices = [centroids[:, at : at + width] for at in shards.borders]
    for _ in range(rounds):
        sent = [shards.context.broadcast(s) for s in slices]
        slices = shards.next_slices(sent, len(centroids))
        for s in sent:
            s.unpersist()
    sent = [shards.context.broadcast(s) for s in slices]

    def nearest(row):
        distances, ids = row[1]
        return ids, distances.argmin(axis=1).astype(np.uint32).tobytes(), *packed(distances.min(axis=1))

    found = shards.distances(sent, with_ids=True).map(nearest)
    stored = spark.createDataFrame(found, "ids binary, labels binary, kind string, data binary")
    return cut(stored.mapInArrow(_nearest, _NEAREST)), np.concatenate(slices, axis=1)


def digest(df: DataFrame, **parameters) -> DataFrame:
    """Per vector: cluster, distance, the summed distances of its cluster and of
    all vectors, and the hash of its centroid."""
    found, centroids = clustered(df, **parameters)
    hashes = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    names = df.sparkSession.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    # At most k rows.
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), wide).alias("part"))
    total = sums.agg(F.when(F.count("part") == F.count("*"), F.sum("part")).alias("total")).first()["total"]
    inertia = F.lit(int(total) if total is not None and total <= LONG else None).cast("bigint")
    per_cluster = sums.join(F.broadcast(names), "cluster").select(
        "cluster", F.expr("try_cast(part as bigint) cluster_inertia"), inertia.alias("inertia"), "centroid_sha256"
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
