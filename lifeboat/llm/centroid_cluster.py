"""Centroid clustering with heap-ordered bounds, in whole numbers.

Vectors are scaled to integers, so sums, distances and centroids are exact and the
result does not depend on the layout. Lloyd's rounds are sped up by one number
per vector: its gap, a lower bound of the distance to the second nearest
centroid less an upper bound of the distance to its own. When centroids move,
the gap of every vector of a cluster shrinks by at most the cluster's own drift plus
the largest drift of another; instead of touching all gaps, that is added to
the cluster's accumulated drift, and gaps are stored plus the drift at the time.
Each cluster keeps its vectors in a heap by that key: only vectors at the top
whose key the accumulated drift has passed are popped, compared exactly with all
centroids, and pushed on the heap of their cluster. All others keep theirs unseen.

Vectors are packed into blocks of ``block_rows`` with the heaps of the block, one heap per
cluster and block; nothing is shuffled. A round reads the blocks, writes them with the new
heaps as a staged table, and sums what moved (at most clusters x components numbers per task,
added up by a grouped aggregate). The driver holds centroids and drifts only, so a lost
executor costs the blocks of its running tasks.

Bounds are in floating point with a margin well above its error; every comparison that
decides an assignment is in integers (ties: the smaller cluster number).

Defined results: rows whose vector is null, has another number of components, or has a null or
non-finite one are left out; repeated ids are vectors of their own (of equal hashes the smaller id,
then the smaller vector starts first; a null id comes last); fewer vectors than clusters make as many clusters as vectors;
clusters that lose all vectors keep their centroid. A scaled component beyond 2^27 raises, as
distances would not fit 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from math import isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import discard, map_columns, stage

_LIMIT = 1 << 27
#: Up to here products of components sum exactly in doubles.
_EXACT = 1 << 22
_MARGIN = 1e-9

STATE = "v binary, cluster binary, heap_n array<int>, heap_key binary, heap_at binary, moved array<long>, scanned long, distance binary"


@dataclass(frozen=True)
class Settings:
    clusters: int = 16
    rounds: int = 3
    dimensions: int = 64
    scale: int = 64             # components are floor(scale * x)
    seed: str = "1"             # first centroids: the smallest sha256 of "<seed>:<id>"
    block_rows: int = 2048


def scaled(vectors: DataFrame, s: Settings, id_col: str, vector_col: str) -> DataFrame:
    """id, v (array of integers) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    whole = F.transform(F.col("x"), lambda e: F.floor(e * s.scale))
    fits = F.forall(F.col("x"), lambda e: F.abs(e * s.scale) <= _LIMIT)
    kept = vectors.select(F.col(id_col).alias("id"), x.alias("x"), (F.coalesce(F.size(x) == s.dimensions, F.lit(False)) & finite).alias("ok")).filter("ok")
    return kept.select("id", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a scaled component is beyond {_LIMIT}")))
                       .cast("array<int>").alias("v"))


def first_centroids(rows: DataFrame, s: Settings) -> list[list[int]]:
    """The vectors with the smallest hashes, in hash order."""
    h = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("id").cast("string")), 256)
    top = rows.select(h.alias("h"), "id", "v").orderBy(F.asc_nulls_last("h"), F.asc_nulls_last("id"), "v").limit(s.clusters)
    return [list(r["v"]) for r in top.collect()]


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x centroids."""
    if max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT:
        dot = (v.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        wide, c = v.astype(np.int64), centroids
        return (wide * wide).sum(1)[:, None] - 2 * dot + (c * c).sum(1)
    return np.stack([((v.astype(np.int64) - c) ** 2).sum(1) for c in centroids], 1)


class Block:
    """Vectors of one block, their clusters, and a heap of (gap plus drift, place) per cluster."""

    def __init__(self, v: np.ndarray, k: int, cluster: np.ndarray | None = None, heaps: list[list[tuple[float, int]]] | None = None):
        self.v, self.k = v, k
        self.cluster = np.full(len(v), -1, np.int32) if cluster is None else cluster
        self.heaps = [[] for _ in range(k)] if heaps is None else heaps
        self.new = cluster is None

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, int]:
        """Rescan the vectors whose gap has expired; (counts and sums by which the clusters change, vectors scanned)."""
        if self.new:
            popped, self.new = list(range(len(self.v))), False
        else:
            popped = []
            for heap, passed in zip(self.heaps, drift.tolist(), strict=True):
                while heap and heap[0][0] <= passed:
                    popped.append(heappop(heap)[1])
        change = np.zeros((self.k, self.v.shape[1] + 1), np.int64)
        if not popped:
            return change, 0
        at = np.array(popped)
        own = self.v[at]
        d = distances(own, centroids)
        best = d.argmin(1)                              # the first of equal distances
        near = np.sqrt(d[np.arange(len(at)), best].astype(np.float64))
        d[np.arange(len(at)), best] = np.iinfo(np.int64).max
        far = np.sqrt(d.min(1).astype(np.float64)) if self.k > 1 else np.full(len(at), np.inf)
        key = far * (1 - _MARGIN) - near * (1 + _MARGIN) - _MARGIN + drift[best]
        before = self.cluster[at]
        self.cluster[at] = best
        for x, c, i in zip(key.tolist(), best.tolist(), popped, strict=True):
            heappush(self.heaps[c], (x, i))
        moved = before != best
        wide = np.concatenate([np.ones((len(at), 1), np.int64), own.astype(np.int64)], 1)[moved]
        np.add.at(change, best[moved], wide)
        left = before[moved] >= 0
        np.subtract.at(change, before[moved][left], wide[left])
        return change, len(at)

    def own_distances(self, centroids: np.ndarray) -> np.ndarray:
        return ((self.v.astype(np.int64) - centroids[self.cluster]) ** 2).sum(1)


def _blocks(rows: DataFrame, s: Settings) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, s.block_rows):
                part = b.slice(at, s.block_rows)
                v = part.column(1).flatten().to_numpy().astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([v.tobytes()], pa.binary())], ["ids", "v"])

    out = map_columns(rows, [F.col("id"), F.col("v")], f"ids array<{kind}>, v binary", run)
    empty = F.lit(None).cast("binary")
    return out.select("ids", "v", empty.alias("cluster"), F.lit(None).cast("array<int>").alias("heap_n"), empty.alias("heap_key"),
                      empty.alias("heap_at"), F.lit(None).cast("array<long>").alias("moved"), F.lit(0).cast("long").alias("scanned"), empty.alias("distance"))


def _round(blocks: DataFrame, centroids: np.ndarray, drift: np.ndarray, last: bool, s: Settings) -> DataFrame:
    """The blocks after one assignment; ``moved`` has the change of counts and sums, or of the last round counts and inertias."""
    k = len(centroids)
    ids = blocks.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw = [b.column(j)[i] for j in range(6)]
                v = np.frombuffer(raw[1].as_buffer(), np.int32).reshape(-1, s.dimensions)
                if raw[2].is_valid:
                    n = np.cumsum([0, *raw[3].as_py()]).tolist()
                    pairs = list(zip(np.frombuffer(raw[4].as_buffer()).tolist(), np.frombuffer(raw[5].as_buffer(), np.int32).tolist(), strict=True))
                    block = Block(v, k, np.frombuffer(raw[2].as_buffer(), np.int32).copy(), [pairs[x:y] for x, y in zip(n, n[1:])])
                else:
                    block = Block(v, k)
                change, scanned = block.advance(centroids, drift)
                distance = None
                if last:
                    d = block.own_distances(centroids)
                    change = np.zeros((k, 2), np.int64)
                    np.add.at(change, block.cluster, np.stack([np.ones_like(d), d], 1))
                    distance = d.tobytes()
                flat = [x for heap in block.heaps for x in heap]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([block.cluster.tobytes()], pa.binary()),
                     pa.array([[len(h) for h in block.heaps]], pa.list_(pa.int32())), pa.array([np.array([x for x, _ in flat], np.float64).tobytes()], pa.binary()),
                     pa.array([np.array([i for _, i in flat], np.int32).tobytes()], pa.binary()), pa.array([change.ravel().tolist()], pa.list_(pa.int64())),
                     pa.array([scanned], pa.int64()), pa.array([distance], pa.binary())], names)

    names = ["ids", *(c.split()[0] for c in STATE.split(", "))]
    return map_columns(blocks, [F.col(c) for c in names], f"ids {ids}, {STATE}", run)


def _changes(blocks: DataFrame, k: int) -> np.ndarray:
    """``moved`` summed over all blocks, a row per cluster: one list per task, then a grouped sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            lists = b.column(0)
            if len(lists):
                part = lists.flatten().to_numpy().reshape(len(lists), -1).sum(0)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["moved"])

    parts = map_columns(blocks, [F.col("moved")], "moved array<long>", run)
    sums = parts.select(F.posexplode("moved").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    return np.array([r["n"] for r in sorted(sums, key=lambda r: r["at"])], np.int64).reshape(k, -1)


def _length(step: np.ndarray) -> float:
    """Upper bound of the length of an integer vector."""
    square = sum(int(x) ** 2 for x in step)
    root = isqrt(square)
    return float(root) if root * root == square else sqrt(square) * (1 + _MARGIN)


def cluster(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, list[dict], list[int]]:
    """(rows, clusters, scans): id, cluster, distance of every vector that takes part; per cluster its centroid, size and
    inertia; and how many vectors each assignment compared with all centroids."""
    s = settings
    rows = scaled(vectors, s, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    centroids = np.array(first_centroids(rows, s), np.int64)
    k = len(centroids)
    if not k:
        return vectors.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long"), [], []
    totals, drift, scans = np.zeros((k, s.dimensions + 1), np.int64), np.zeros(k), []
    state = None
    for number in range(s.rounds + 1):
        last = number == s.rounds
        now = stage(_round(_blocks(rows, s) if state is None else state, centroids, drift, last, s), "blocks")
        if state is not None:
            discard(state)
        state = now
        scans.append(state.agg(F.sum("scanned")).first()[0])
        if last:
            break
        totals = totals + _changes(state, k)
        moved = np.array([[int(x) // int(t[0]) for x in t[1:]] if t[0] else old.tolist() for t, old in zip(totals, centroids, strict=True)], np.int64)
        steps = np.array([_length(a - b) for a, b in zip(moved, centroids, strict=True)])
        others = np.array([max(np.delete(steps, c), default=0.0) for c in range(k)])
        drift, centroids = (drift + steps + others) * (1 + _MARGIN * 1e-3), moved
    sums = _changes(state, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1).flatten(), pa.array(np.frombuffer(b.column(1)[i].as_buffer(), np.int32)),
                     pa.array(np.frombuffer(b.column(2)[i].as_buffer(), np.int64))], ["id", "cluster", "distance"])

    out = map_columns(state, [F.col("ids"), F.col("cluster"), F.col("distance")], f"id {kind}, cluster int, distance long", run)
    return out, [{"cluster": c, "centroid": x.tolist(), "size": int(t[0]), "inertia": int(t[1])}
                 for c, (x, t) in enumerate(zip(centroids, sums, strict=True))], scans
