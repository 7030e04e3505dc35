"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, components.

A text's fingerprint has the bits that more than half of its shingle hashes
have. The 64 bits are cut into six blocks. Two fingerprints that differ in at
most three bits differ in at most three blocks, so the other three are equal:
each fingerprint is filed under all 20 choices of three blocks, and within
one file (equal bits in the same three blocks, 31 to 33 of them) the distance
is verified. No pair at three bits or fewer can be missed.

Equal fingerprints are one row before any of this, so a group of copies of
any size is a single fingerprint. Within a file, links are found by comparing
sorted neighbours; a large file is walked from fingerprint to fingerprint,
each compared with those not reached yet, so a dense cluster costs about one
comparison per member and only the links of a spanning forest are emitted.
Components over those links are the components over all links.

Defined results: null text counts as empty; a text without words has
fingerprint zero and is linked like any other; a text of one or two words has
one shingle, all of it. Repeated rows are rows of one component. A null
doc_id is no candidate for the smallest id; a component of null ids only has
a null component_id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import free_name, map_columns, numbered, stage, text_or_empty
from lifeboat.llm.components import connected_components

BLOCK_BITS = (11, 11, 11, 11, 10, 10)
#: Files of up to so many fingerprints are compared by shifted neighbours, larger ones walked.
WALK_FROM = 16
_STEP = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(space + 1).tolist()]
    ends = [*space.tolist(), len(joined)][shingle - 1:]
    n, counts = len(ends), np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:at + _STEP], ends[at:at + _STEP])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, row: Column | None = None) -> DataFrame:
    """(row_id, id, fp) of every row; fp is the fingerprint's bits as a signed long. ``row``: the row's number, if it has one."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["row_id", "id", "fp"])

    number = F.monotonically_increasing_id() if row is None else row    # callers stage the result, so it is numbered once
    return map_columns(docs, [number.alias("row_id"), F.col(id_col).alias("id"),
                              text_or_empty(text_col).alias("text")], f"row_id long, id {kind}, fp long", run)


def _masks(bits: tuple[int, ...]) -> list[int]:
    out, at = [], 0
    for n in bits:
        m = ((1 << n) - 1) << at
        out.append(m - (1 << 64) if m >> 63 else m)
        at += n
    return out


def _walk(f: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of ``f`` under Hamming distance ``most``."""
    links, rest = [], np.arange(len(f))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(f[rest] ^ f[at]) <= most
            if near.any():
                hit = rest[near].tolist()
                links += [(at, x) for x in hit]
                queue += hit
                rest = rest[~near]
    return links


def file_links(key: np.ndarray, f: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``key``: positions (i, j), enough to connect what links connect."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    size = np.diff(edge)
    run = np.repeat(np.arange(len(size)), size)
    small = np.flatnonzero(size[run] <= WALK_FROM)
    left, right = [], []
    r, d = run[small], 1
    while len(small) > d and (same := r[d:] == r[:-d]).any():
        i, j = small[:-d][same], small[d:][same]
        ok = np.bitwise_count(f[i] ^ f[j]) <= most
        left.append(i[ok])
        right.append(j[ok])
        d += 1
    for k in np.flatnonzero(size > WALK_FROM):
        if pairs := _walk(f[edge[k]:edge[k + 1]], most):
            p = np.array(pairs) + edge[k]
            left.append(p[:, 0])
            right.append(p[:, 1])
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(fps: DataFrame, most: int = 3, bits: tuple[int, ...] = BLOCK_BITS) -> DataFrame:
    """(a, b) fingerprint links within ``most`` bits, a spanning forest per file at least."""
    masks = _masks(bits)
    choices = list(combinations(range(len(bits)), len(bits) - most))
    filed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("no"), F.col("fp").bitwiseAND(F.lit(sum(masks[i] for i in c))).alias("bits"))
        for n, c in enumerate(choices)])).alias("k")).select("k.no", "k.bits", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(no, key, f):
            step = np.flatnonzero(np.r_[True, (no[1:] != no[:-1]) | (key[1:] != key[:-1])])
            ids = np.zeros(len(key), np.int64)
            ids[step] = 1
            i, j = file_links(np.cumsum(ids), f.view(np.uint64), most)
            pairs = np.unique(np.stack([np.minimum(f[i], f[j]), np.maximum(f[i], f[j])], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held: list[list[np.ndarray]] = []       # a file that goes on over batches is put together once
        for b in batches:
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(now[0]):
                continue
            if held and (held[-1][0][-1] != now[0][0] or held[-1][1][-1] != now[1][0]):
                yield out(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield out(*map(np.concatenate, zip(*held, [x[:cut] for x in now], strict=True)))
                held = []
            held.append([x[cut:] for x in now])
        if held:
            yield out(*map(np.concatenate, zip(*held, strict=True)))

    return (filed.repartition("no", "bits").sortWithinPartitions("no", "bits", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
                    most: int = 3, row: Column | None = None) -> DataFrame:
    """One row per input row: row_id, id, fp, component_id (smallest id reachable), component (smallest fingerprint reachable).

    ``component`` names the component; ``component_id`` may be null or shared, as ids may be null or repeated.
    """
    own = stage(fingerprints(docs, text_col, id_col, shingle, row), "fingerprints")
    parts = connected_components(links(own.select("fp").distinct(), most))
    fps = stage(own.groupBy("fp").agg(F.min("id").alias("least"))
                .join(parts.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    # Staged before it is joined back, so a component or fingerprint with very many rows meets one row in as many tasks as it takes.
    least = stage(fps.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    named = stage(fps.select("fp", "component").join(least, "component"), "named")
    return own.join(named, "fp").select("row_id", "id", "fp", "component_id", "component")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, most: int = 3,
             row: Column | None = None) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of equal ids the first row)."""
    name = free_name(docs, "row_id")
    own = numbered(docs, row, name)
    found = stage(near_duplicates(own, text_col, id_col, shingle, most, F.col(name)), "components")
    # Rows with the smallest id are few per component (one, but for repeated ids), so this groups little.
    first = found.filter("id <=> component_id").groupBy("component", "fp").agg(F.min("row_id").alias("r"))
    keep = first.groupBy("component").agg(F.min("r").alias("r")).select(F.col("r").alias(name))
    gone = stage(found.select(F.col("row_id").alias(name)).join(keep, name, "left_anti"), "near-copies")
    return own.join(gone, name, "left_anti").drop(name)


def hex_digits(fp: Column) -> Column:
    """A fingerprint's 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
