"""Variable-capacity best-fit packing of texts into training sequences.

Several sequence lengths are permitted, each with a cost. Pieces are packed
longest first: a piece goes into the open bin it fills best; if it fits in
none, every permitted length that holds it is tried out (the bin is filled
on trial, best fit first, from the pieces still waiting) and the length
with the least cost per packed unit is opened. At the end every bin is cut down to the
smallest permitted length that holds its contents.

Texts longer than the longest length are cut into pieces; nothing is dropped.
Pieces are dealt to packing shards by a hash, so a shard holds about
``shard_rows`` pieces whatever the size of the corpus and however its
sources are skewed, and only (row, piece, length) crosses the network. A shard
wastes at most its last few bins, which at that size is a share of a percent.

Defined results: null and empty texts have one piece of length 0, which takes
a place in a bin but no room; repeated rows are packed one by one; ties go by
row. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import stage, text_or_empty

#: Permitted lengths and the cost of one bin of each: its units plus a fixed cost per sequence.
CAPACITIES = (2048, 4096, 8192, 16384)
FIXED_COST = 64
SHARD_ROWS = 20_000


class Waiting:
    """Lengths still to pack, as counts per distinct length in ascending order."""

    def __init__(self, lengths: np.ndarray):
        self.lengths, self.left = (x.tolist() for x in np.unique(lengths, return_counts=True))
        self.below = list(range(len(self.lengths)))     # nearest place at or below that still has pieces

    def find(self, most: int) -> int:
        """The place of the largest length up to ``most`` that has pieces left, or -1."""
        return self._at(bisect_right(self.lengths, most) - 1)

    def _at(self, i: int) -> int:
        path = []
        while i >= 0 and not self.left[i]:
            path.append(i)
            i = self.below[i] if self.below[i] != i else i - 1
        for p in path:
            self.below[p] = i
        return i

    def fill(self, first: int, capacity: int) -> tuple[list[int], int]:
        """Places a bin of ``capacity`` would take, the longest that fit one after the other, and their units."""
        used, room, taken = [first], capacity - self.lengths[first], {first: 1}
        i = self.find(room)
        while i >= 0:
            if taken.get(i, 0) < self.left[i]:
                n = self.lengths[i]
                take = self.left[i] - taken.get(i, 0) if n == 0 else min(room // n, self.left[i] - taken.get(i, 0))
                if take:
                    used += [i] * take
                    taken[i] = taken.get(i, 0) + take
                    room -= take * n
                if n == 0:
                    break
            i = self._at(min(i - 1, bisect_right(self.lengths, room) - 1))
        return used, capacity - room

    def take(self, places: list[int]) -> None:
        for i in places:
            self.left[i] -= 1


def pack(lengths: np.ndarray, capacities: tuple[int, ...], costs: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity) of each piece; every length is at most the largest capacity."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    waiting = Waiting(lengths)
    queue: dict[int, list[int]] = {}
    for k in order[::-1].tolist():
        queue.setdefault(int(lengths[k]), []).append(k)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    used: list[int] = []
    rooms: list[tuple[int, int]] = []                   # (room left, bin), ascending
    i = waiting.find(capacities[-1])
    while i >= 0:
        size = waiting.lengths[i]
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):                             # the open bin that the piece fills best
            room, b = rooms.pop(at)
            cap, places = room + used[b], [i]
        else:
            best = None
            for c, cost in zip(capacities, costs, strict=True):
                if c >= size:
                    places, units = waiting.fill(i, c)
                    rate = cost / max(units, 1)
                    if best is None or rate < best[0]:
                        best = (rate, c, places)
            _, cap, places = best
            b = len(used)
            used.append(0)
        waiting.take(places)
        for p in places:
            k = queue[waiting.lengths[p]].pop()
            bins[k], offsets[k] = b, used[b]
            used[b] += waiting.lengths[p]
        insort(rooms, (cap - used[b], b))
        i = waiting.find(waiting.lengths[i])
    fitted = np.array(capacities)[np.searchsorted(capacities, used)] if used else np.zeros(0, np.int64)
    return bins, offsets, fitted[bins]


def best_fit(docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             capacities: tuple[int, ...] = CAPACITIES, fixed_cost: float = FIXED_COST,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: id, piece, start, length, bin, offset, capacity.

    ``length`` is an expression over ``docs`` in the units of ``capacities``;
    by default the UTF-8 bytes of the text (the tokens of a byte vocabulary).
    ``bin`` names the shard and the bin in it; ``start`` and ``offset`` are
    the piece's places in its text and in its bin.
    """
    capacities = tuple(sorted(capacities))
    costs = tuple(c + fixed_cost for c in capacities)
    most = capacities[-1]
    size = F.octet_length(text_or_empty(text_col)) if length is None else length
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"),
                       F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    pieces = stage(rows.select("row_id", "id", "size", F.explode(
        F.sequence(F.lit(0), F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / most).cast("int"))).alias("piece"))
        .select("row_id", "id", "piece", (F.col("piece") * F.lit(most)).cast("long").alias("start"),
                F.least(F.lit(most), F.col("size") - F.col("piece") * F.lit(most)).cast("long").alias("length")), "pieces")
    shards = max(1, -(-pieces.count() // shard_rows))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "piece", "start", "length", "bin", "offset", "capacity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            b, o, c = pack(t["length"].to_numpy(), capacities, costs)
            head = f"{t['shard'][0].as_py()}-"
            cols = [t[x].combine_chunks() for x in names[:4]] + [pa.array([head + str(x) for x in b.tolist()], pa.string()), pa.array(o), pa.array(c)]
            return pa.RecordBatch.from_arrays(cols, names)

        for batch in batches:                           # sorted by shard: cut where the shard changes
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                if held and held[-1].column(0)[0].as_py() != int(shard[s]):
                    yield out()
                    held = []
                held.append(batch.slice(s, e - s))
        if held:
            yield out()

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row_id", "piece"), F.lit(shards)).cast("int"))
    return (dealt.repartition(F.col("shard")).sortWithinPartitions("shard", "row_id", "piece")
            .select("shard", "id", "piece", "start", "length")
            .mapInArrow(run, f"id {kind}, piece int, start long, length long, bin string, offset long, capacity long"))
