"""Exact centroid clustering with bounds kept in heaps."""

from __future__ import annotations

import hashlib
import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import Folder, scratch_path

CENTROIDS = 16
ROUNDS = 3
SCALE = 64
#: Components are held within this, so that squared distances fit in 64 bits.
LARGEST = 1 << 26
#: Up to here floating point holds squared distances of 64 components exactly.
EXACT = 1 << 21
BLOCK_VECTORS = 4096
#: Bounds give way by this part of the lengths they come from, far more than rounding can be.
SLACK = 1e-9

STATE = "ids array<long>, vectors binary, cluster binary, keys binary, members binary, first binary, sums array<long>"


def _integers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of each vector to each centroid, exactly."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if largest <= EXACT and vectors.shape[1] <= 64 else np.int64
    a, b = vectors.astype(kind), centroids.astype(kind)
    out = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return out.astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid, the smaller number in ties; how far it and the next one are."""
    squares = squared_distances(vectors, centroids)
    rows = np.arange(len(vectors))
    cluster = squares.argmin(1)
    upper = np.sqrt(squares[rows, cluster].astype(np.float64))
    if len(centroids) == 1:
        return cluster, upper, np.full(len(vectors), np.inf)
    squares[rows, cluster] = np.iinfo(np.int64).max
    return cluster, upper, np.sqrt(squares.min(1).astype(np.float64))


def _gaps(upper: np.ndarray, lower: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """What the centroids may still drift before the next one can be as near: less than the truth."""
    held = np.where(np.isinf(lower), 0, lower)
    return lower - upper - SLACK * (upper + held + drift + 1)


def _sums(vectors: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Counts and then component sums of each cluster."""
    out = np.zeros((k, vectors.shape[1] + 1), np.int64)
    np.add.at(out[:, 0], cluster, 1)
    for c in range(k):
        out[c, 1:] = vectors[cluster == c].sum(0)
    return out


class _Block:
    """Some vectors with their clusters; the members of each cluster are a heap of (gap and drift then, vector)."""

    def __init__(self, ids: pa.Array, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors

    @classmethod
    def first_assigned(cls, ids: pa.Array, vectors: np.ndarray, centroids: np.ndarray) -> _Block:
        self = cls(ids, vectors)
        self.cluster, upper, lower = nearest(vectors, centroids)
        keys = _gaps(upper, lower, np.zeros(len(vectors)))
        # a sorted list is a heap
        order = np.lexsort((keys, self.cluster))
        self.keys, self.members = keys[order], order
        self.first = np.searchsorted(self.cluster[order], np.arange(len(centroids) + 1))
        self.sums = _sums(vectors, self.cluster, len(centroids))
        return self

    @classmethod
    def read(cls, row: dict, dims: int) -> _Block:
        self = cls(row["ids"], np.frombuffer(row["vectors"], np.int32).reshape(-1, dims).astype(np.int64))
        self.cluster = np.frombuffer(row["cluster"], np.int32).astype(np.int64)
        self.keys = np.frombuffer(row["keys"], np.float64)
        self.members = np.frombuffer(row["members"], np.int32).astype(np.int64)
        self.first = np.frombuffer(row["first"], np.int64)
        self.sums = np.array(row["sums"], np.int64).reshape(len(self.first) - 1, dims + 1)
        return self

    def row(self) -> pa.RecordBatch:
        ids = pa.ListArray.from_arrays(pa.array([0, len(self.ids)], pa.int32()), pa.array(self.ids, pa.int64()))
        columns = [
            self.vectors.astype(np.int32), self.cluster.astype(np.int32), self.keys.astype(np.float64),
            self.members.astype(np.int32), self.first.astype(np.int64),
        ]
        held = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        sums = pa.array([self.sums.ravel().tolist()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [ids, *held, sums], ["ids", "vectors", "cluster", "keys", "members", "first", "sums"]
        )

    def move(self, centroids: np.ndarray, drift: np.ndarray) -> None:
        """Assign anew where the drift since may have closed the gap; the other vectors are not looked at."""
        top = np.minimum(self.first[:-1], max(len(self.keys) - 1, 0))
        ripe = (np.diff(self.first) > 0) & (self.keys[top] <= drift) if len(self.keys) else np.zeros(0, bool)
        if not ripe.any():
            return
        heaps = [
            list(zip(self.keys[a:b].tolist(), self.members[a:b].tolist())) for a, b in zip(self.first, self.first[1:])
        ]
        popped = []
        for heap, limit in zip(heaps, drift.tolist()):
            while heap and heap[0][0] <= limit:
                popped.append(heapq.heappop(heap)[1])
        rows = np.array(popped)
        cluster, upper, lower = nearest(self.vectors[rows], centroids)
        keys = _gaps(upper, lower, drift[cluster]) + drift[cluster]
        for key, row, c in zip(keys.tolist(), popped, cluster.tolist()):
            heapq.heappush(heaps[c], (key, row))
        moved = rows[cluster != self.cluster[rows]]
        self.sums = self.sums - _sums(self.vectors[moved], self.cluster[moved], len(centroids))
        self.cluster = self.cluster.copy()
        self.cluster[rows] = cluster
        self.sums = self.sums + _sums(self.vectors[moved], self.cluster[moved], len(centroids))
        self.keys = np.array([key for heap in heaps for key, _ in heap])
        self.members = np.array([row for heap in heaps for _, row in heap], np.int64)
        self.first = np.concatenate(([0], np.cumsum([len(heap) for heap in heaps])))


def _starting(centroids: np.ndarray):
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for low in range(0, batch.num_rows, BLOCK_VECTORS):
                vectors = _integers(flat[low : low + BLOCK_VECTORS])
                yield _Block.first_assigned(batch.column(0).slice(low, len(vectors)), vectors, centroids).row()

    return run


def _blocks(batches, dims: int):
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block.read({n: batch.column(n)[i].as_py() for n in batch.schema.names}, dims)


def _moving(centroids: np.ndarray, drift: np.ndarray):
    def run(batches):
        for block in _blocks(batches, centroids.shape[1]):
            block.move(centroids, drift)
            yield block.row()

    return run


def _own_distances(block: _Block, centroids: np.ndarray) -> np.ndarray:
    apart = block.vectors - centroids[block.cluster]
    return (apart * apart).sum(1)


def _inertia(centroids: np.ndarray):
    def run(batches):
        total = [0] * len(centroids)
        for block in _blocks(batches, centroids.shape[1]):
            distances = _own_distances(block, centroids)
            for c in np.unique(block.cluster).tolist():
                total[c] += sum(distances[block.cluster == c].tolist())
        clusters = pa.array(range(len(total)), pa.int32())
        yield pa.RecordBatch.from_arrays([clusters, pa.array(map(str, total), pa.string())], ["cluster", "inertia"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        for block in _blocks(batches, centroids.shape[1]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids, pa.int64()),
                    pa.array(block.cluster.astype(np.int32)),
                    pa.array(_own_distances(block, centroids)),
                ],
                ["id", "cluster", "distance"],
            )

    return run


def _add_up(batches):
    total = None
    for batch in batches:
        column = batch.column(0)
        held = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).sum(0)
        total = held if total is None else total + held
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["sums"])


def _totals(state: DataFrame, k: int, dims: int) -> np.ndarray:
    each = state.select("sums").mapInArrow(_add_up, "sums array<long>").select(F.posexplode("sums"))
    out = np.zeros(k * (dims + 1), np.int64)
    for place, total in each.groupBy("pos").agg(F.sum("col")).collect():
        out[place] = total
    return out.reshape(k, dims + 1)


def whole_vectors(column: Column, dims: int) -> Column:
    """True for vectors of ``dims`` components that are all there and finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(column) == dims) & finite, F.lit(False))


class Clustering:
    """Centroids and assigned vectors after ``rounds`` rounds: see :func:`heap_kmeans`."""

    def __init__(self, vectors: DataFrame, k: int, rounds: int, dims: int, seed: int, id_col: str, vector_col: str):
        source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        source = source.where(whole_vectors(F.col("vector"), dims))
        name = F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary")
        hashed = source.where("id IS NOT NULL").select(F.sha2(name, 256).alias("hash"), "vector")
        chosen = hashed.orderBy("hash", "vector").limit(k).collect()
        self.spark, self.dims = vectors.sparkSession, dims
        self.centroids = _integers(np.array([r["vector"] for r in chosen], np.float64).reshape(-1, dims))
        self.state, self.rescanned = None, []
        if not len(self.centroids):
            return
        drift = np.zeros(len(self.centroids))
        self._write(source.mapInArrow(_starting(self.centroids), STATE))
        for _ in range(rounds):
            drift = drift + self._replace_centroids()
            self._write(self.state.mapInArrow(_moving(self.centroids, drift), STATE))

    def _write(self, state: DataFrame) -> None:
        """The next state is written whole before the one it came from is removed."""
        path = scratch_path(self.spark, "clusters")
        state.write.parquet(path)
        if self.state is not None:
            Folder(self.spark, self._path).remove()
        self._path, self.state = path, self.spark.read.schema(STATE).parquet(path)

    def _replace_centroids(self) -> np.ndarray:
        """What each cluster's gaps lose: the way of its own centroid and the longest of any other."""
        totals = _totals(self.state, len(self.centroids), self.dims)
        counts, new = totals[:, :1], self.centroids.copy()
        held = counts[:, 0] > 0
        new[held] = totals[held, 1:] // counts[held]
        apart = (new - self.centroids).astype(np.float64)
        way = np.sqrt((apart * apart).sum(1)) * (1 + SLACK)
        self.centroids = new
        others = [np.delete(way, c).max(initial=0) for c in range(len(way))]
        return way + np.array(others)


def heap_kmeans(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = 64,
    seed: int = 1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, a row for each vector that counts.

    Vectors of ``dims`` components, none null or not finite, count; components become integers, ``floor(64 * x)``.
    Centroids start as the ``k`` vectors whose ids, with the seed, have the least SHA-256. A round assigns
    every vector to the nearest centroid and moves each centroid to the floor of its vectors' mean; after the last
    round vectors are assigned once more. Results are those of plain rounds: all arithmetic on integers.

    Vectors are kept in blocks. In each, a cluster's members are a heap by the gap between their
    nearest centroid and the next one, plus the cluster's drift when that was found. As centroids move, drift is
    added up once for a cluster; only members at the top of the heap whose gap it has used up are popped
    and compared with all centroids again. The blocks with their heaps are written to the
    shared folder each round; sums follow the vectors that moved. The driver gets ``k`` starting vectors and a row of
    sums for each component of each centroid.

    Ties go to the smaller number. A null id's vector is assigned but starts no centroid; rows that repeat an id are
    vectors of their own (with one hash, the smaller vector starts first). Fewer vectors than ``k`` make fewer
    centroids. Components beyond 2 ** 26 after scaling are held there, so that distances fit in 64 bits; an inertia
    that does not is the largest long. Other columns are ignored; no vectors give no rows.
    """
    found = Clustering(vectors, k, rounds, dims, seed, id_col, vector_col)
    if found.state is None:
        kinds = f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return found.spark.createDataFrame([], kinds)
    parts = found.state.mapInArrow(_inertia(found.centroids), "cluster int, inertia string")
    exact = F.sum(F.col("inertia").cast("decimal(38,0)"))
    each = dict(parts.groupBy("cluster").agg(exact).collect())
    most = (1 << 63) - 1
    spelled = [",".join(map(str, c)) for c in found.centroids.tolist()]

    def of_cluster(values: list) -> Column:
        pairs = reduce(list.__add__, [[F.lit(c), F.lit(v)] for c, v in enumerate(values)])
        return F.create_map(*pairs)[F.col("cluster")]

    own = [min(int(each.get(c) or 0), most) for c in range(len(spelled))]
    whole = min(sum(int(v or 0) for v in each.values()), most)
    rows = found.state.mapInArrow(_assigned(found.centroids), "id long, cluster int, distance long")
    return rows.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        of_cluster(own).cast("long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        of_cluster([hashlib.sha256(s.encode()).hexdigest() for s in spelled]).alias("centroid_sha256"),
    )
