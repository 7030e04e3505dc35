"""Substring deduplication with compressed FM-indexes, one per shard.

A window is 20 consecutive words. Every window is sent, with its neighbours, to
the shard that its smallest 4-gram hash names: equal windows have the same
4-grams, so they meet in one shard, and the work grows with the corpus, not
with documents times shards. A segment is a run of windows with the same
smallest hash (at most 64), so text is sent about three times, packed.

A shard concatenates its distinct segments and builds an FM-index over their words:
the Burrows-Wheeler transform from a suffix order of 32 words, kept as a
wavelet matrix of packed bits with block counts. All windows are then run
against it together: backward search over the wavelet matrix finds, for each end, how far the
match with another place reaches (matching statistics, cut at a window), and intervals
that reach the threshold are reported. The first words of a search are looked up: the suffix
order is made by doubling, and the intervals of its last but one step are kept. The suffix interval of a window holds all its
places, so the earliest start is known, and every later one is removed.

Skew: segments equal within a map task leave it once, its other places being
known copies at once, so a group of copies reaches a shard as one place per task.
4-grams that anchor more than one in 100,000 segments (at most 100,000, so
their broadcast is bounded) are used for an anchor only where a window has no
other, so a line that a third of the corpus holds does not draw all its neighbours
into one shard. Segments whose anchor no other segment has cannot repeat; they
leave the shard before the index is built (unless it occurs twice in the segment).

Defined results: null text has no words; texts of fewer than 20 words keep
all; places are ordered by id, of repeated ids by row; a null id comes first;
an empty table gives an empty result. Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import map_columns, numbered, stage, text_or_empty

GRAM = 4
RUN = 64                        # windows of a segment, at most
SHARD_WORDS = 1_000_000         # words of the segments that a shard gets, about
HOT_SHARE = 100_000             # a gram is hot when it anchors more than 1 / HOT_SHARE of the segments
HOT_LEAST = 200
SLICE_BYTES = 1_000_000         # text that is hashed at once
FLUSH_SEGMENTS = 200_000        # segments a map task holds before it packs them

_B = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = _U(base)
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate([out, out * step])
            step = step * step
    return out[:n]


class _Hasher:
    """Hashes of all words in a buffer of words between single spaces or line ends."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes) of the words."""
        a = np.frombuffer(buf, np.uint8)
        if len(a) > len(self.up):
            self.up = _powers(_B, len(a) * 2)
            self.down = _powers(pow(_B, -1, 1 << 64), len(a) * 2)
        gap = (a == 32) | (a == 10)
        edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1, append=1))
        starts, ends = edge[::2], edge[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + _U(1)) * self.up[:len(a)], dtype=np.uint64)])
        return starts, ends, mix((total[ends] - total[starts]) * self.down[starts])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def segments(h: np.ndarray, doc_of: np.ndarray, window: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, anchor, again) of every segment of the words ``h``; no window crosses documents.

    ``again``: the anchor occurs more than once in the segment, so it may repeat a window of its own.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    n = len(h) - window + 1
    if n < 1:
        return none
    gram = min(GRAM, window)
    g = h[:len(h) - gram + 1].copy()
    for i in range(1, gram):
        g = mix(g * _U(3) + h[i:len(h) - gram + 1 + i])
    g >>= _U(1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, g), len(hot) - 1)
        g[hot[at] == g] |= _U(1 << 63)
    width, have, low = window - gram + 1, 1, g
    while have < width:                                 # sliding minimum by doubling
        step = min(have, width - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    ok = doc_of[:n] == doc_of[window - 1:]
    new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (ok[1:] != ok[:-1]) | (doc_of[1:n] != doc_of[:n - 1])])
    size = np.diff(np.r_[new, n])
    new, size = new[ok[new]], size[ok[new]]
    parts = -(-size // RUN)                             # long runs are cut
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(new, parts) + nth * RUN
    size, anchor = np.minimum(RUN, np.repeat(size, parts) - nth * RUN), low[first]
    times, left = np.zeros(len(first), np.int64), np.arange(len(first))
    for i in range(int(size.max(initial=0)) + width - 1):
        left = left[size[left] + width - 1 > i]
        times[left] += g[first[left] + i] == anchor[left]
    return first, size, anchor, times > 1


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list[bytes]]]:
    rows, ids, texts, size = [], [], [], 0
    for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        t = b" ".join(text.as_py().encode("utf-8", "surrogatepass").split())
        rows.append(row)
        ids.append(doc)
        texts.append(t)
        size += len(t) + 1
        if size > SLICE_BYTES:
            yield rows, ids, texts
            rows, ids, texts, size = [], [], [], 0
    if texts:
        yield rows, ids, texts


def _hashed(texts: list[bytes], hasher: _Hasher) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, word starts, ends and hashes, the text of each word, and the first word of each text."""
    buf = b"\n".join(texts)
    starts, ends, h = hasher.words(buf)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    first = np.searchsorted(starts, at)
    doc_of = np.searchsorted(at, starts, side="right") - 1
    return buf, starts, ends, h, doc_of, first


# --- packing -------------------------------------------------------------------------------

def _pack(text: list[bytes], anchor: np.ndarray, again: np.ndarray, id_: np.ndarray, row: np.ndarray, start: np.ndarray) -> bytes:
    head = np.array([len(text)], np.int64).tobytes()
    nums = b"".join([(anchor >> _U(32)).astype(np.uint32).tobytes(), np.diff(id_, prepend=0).astype(np.int64).tobytes(),
                     np.diff(row, prepend=0).astype(np.int64).tobytes(), start.astype(np.int64).tobytes(),
                     again.astype(np.uint8).tobytes()])
    return zstandard.ZstdCompressor(level=6).compress(head + nums + b"\n".join(text))


def _unpack(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    b = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(b, np.int64, 1)[0])
    anchor = np.frombuffer(b, np.uint32, n, 8)
    id_, row, start = (np.frombuffer(b, np.int64, n, 8 + 4 * n + 8 * n * i) for i in range(3))
    again = np.frombuffer(b, np.uint8, n, 8 + 28 * n).astype(bool)
    return _split(pa.array([b[8 + 29 * n:]], pa.large_binary()), b"\n").flatten(), anchor, np.cumsum(id_), np.cumsum(row), start, again


def _split(texts: pa.Array, mark: bytes) -> pa.Array:
    return pc.split_pattern(texts, pattern=mark)


def _ranges(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row.astype(np.int64)), pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))],
                                      ["row_id", "start", "end"])


# --- the index -----------------------------------------------------------------------------

class Wavelet:
    """Wavelet matrix of a sequence of symbols: one packed bit vector with block counts per bit."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels = []
        for level in range(self.bits - 1, -1, -1):
            one = (seq >> level & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            count = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.uint32)
            self.levels.append((level, words, count, int(len(seq) - one.sum())))
            seq = np.concatenate([seq[~one], seq[one]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` lands on the way of ``symbol``: its rank there, plus the start of the symbol's block."""
        for level, words, count, zeros in self.levels:
            block = at >> 6
            ones = count[block] + np.bitwise_count(words[block] & ((_U(1) << (at & 63).astype(np.uint64)) - _U(1)))
            at = np.where(symbol >> level & 1, zeros + ones.astype(np.int64), at - ones)
        return at


class FMIndex:
    """Compressed index of a text of positive symbols; finds patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        n, sigma = len(text), int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.known, self.group, self.edge = 1, text, self.first
        rank, have = text.astype(np.int64), 1
        while True:                                     # suffix order by prefix doubling, to ``depth`` symbols
            order = np.argsort(rank)
            if have >= depth:
                break
            new = np.flatnonzero(np.r_[True, rank[order[1:]] != rank[order[:-1]]])
            dense = np.empty(n, np.int64)
            dense[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, n]))
            self.known, self.group, self.edge = have, dense, np.r_[new, n]
            nxt = np.zeros(n, np.int64)
            nxt[:-have] = dense[have:] + 1
            rank = dense * (n + 2) + nxt
            have *= 2
        self.n, self.order = n, order
        self.wavelet = Wavelet(text[order - 1], sigma)  # the last symbol precedes the first suffix
        symbols = np.arange(sigma)
        self.shift = self.first[:-1] - self.wavelet.place(symbols, np.zeros(sigma, np.int64))

    def start(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the ``known`` symbols of the text from each place ``at``: where a search begins."""
        return self.edge[self.group[at]], self.edge[self.group[at] + 1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of symbol + pattern."""
        k = len(symbol)
        got = self.wavelet.place(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return got[:k] + self.shift[symbol], got[k:] + self.shift[symbol]


def repeated_windows(index: FMIndex, text: np.ndarray, base: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text place, low, high) of every window of the segments that has another place in the index.

    All windows go backwards in step, from the last words that the index knows;
    one that has a single place left cannot repeat and is dropped.
    """
    n = np.maximum(size - window + 1, 0)
    place = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
    low, high = index.start(place + window - index.known)
    for left in range(window - index.known, -1, -1):
        more = high - low > 1
        place, low, high = place[more], low[more], high[more]
        if left:
            low, high = index.extend(text[place + left - 1], low, high)
    return place, low, high


def shard_ranges(blobs: list[bytes], window: int) -> pa.RecordBatch:
    """Ranges of words (row, start, end) that the windows of one shard remove."""
    parts = [_unpack(b) for b in blobs]
    texts = pa.concat_arrays([p[0] for p in parts])
    anchor, id_, row, start, again = (np.concatenate([p[i] for p in parts]) for i in range(1, 6))
    shared, which, n = np.unique(anchor, return_inverse=True, return_counts=True)
    keep = np.flatnonzero((n[which] > 1) | again)       # others cannot repeat
    numbers = texts.take(pa.array(keep)).dictionary_encode()
    seg = numbers.indices.to_numpy().astype(np.int64)
    id_, row, start = id_[keep], row[keep], start[keep]
    order = np.lexsort((start, row, id_, seg))
    lead = np.r_[True, seg[order][1:] != seg[order][:-1]] if len(order) else np.zeros(0, bool)
    first, later = order[lead], order[~lead]            # first place of each distinct segment, in segment order
    split = _split(numbers.dictionary, b" ")
    size = pc.list_value_length(split).to_numpy().astype(np.int64)
    later_row, later_start, later_end = row[later], start[later], start[later] + size[seg[later]]
    if not len(split):
        return _ranges(later_row, later_start, later_end)
    base = np.cumsum(size + 1) - size - 1
    text = np.zeros(int((size + 1).sum()), np.int64)    # symbol 0 ends each segment
    inside = np.ones(len(text), bool)
    inside[base + size] = False
    text[inside] = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    index = FMIndex(text, window)
    place, low, high = repeated_windows(index, text, base, size, window)
    # The earliest start of each group of equal windows; all of a group have the same interval.
    group_low, at = np.unique(low, return_index=True)
    group_size = high[at] - group_low
    members = np.repeat(group_low - (np.cumsum(group_size) - group_size), group_size) + np.arange(group_size.sum())
    spot = index.order[members]
    group = np.repeat(np.arange(len(group_low)), group_size)
    of = np.searchsorted(base, spot, side="right") - 1
    begin = start[first][of] + spot - base[of]
    order = np.lexsort((begin, row[first][of], id_[first][of], group))
    earliest = order[np.r_[True, group[order][1:] != group[order][:-1]]] if len(order) else order
    mine = np.searchsorted(group_low, low)
    gone = np.sort(place[spot[earliest][mine] != place]) if len(place) else place
    # Neighbouring windows make one range.
    of = np.searchsorted(base, gone, side="right") - 1
    head = np.r_[True, (gone[1:] != gone[:-1] + 1) | (of[1:] != of[:-1])] if len(gone) else np.zeros(0, bool)
    lead, tail = np.flatnonzero(head), np.r_[np.flatnonzero(head)[1:], len(gone)] - 1 if len(gone) else np.zeros(0, np.int64)
    own = of[lead]
    shift = start[first][own] - base[own]
    return _ranges(np.concatenate([later_row, row[first][own]]), np.concatenate([later_start, gone[lead] + shift]),
                   np.concatenate([later_end, gone[tail] + window + shift]))


# --- the job -------------------------------------------------------------------------------

def _hot_anchors(rows: DataFrame, window: int) -> tuple[int, np.ndarray]:
    """Words of all segments, and the grams that anchor too many of them (each task reports those it met three times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, none = _Hasher(), np.empty(0, np.uint64)
        n_words = n_segments = 0
        met = none
        for b in batches:
            for _, _, texts in _slices(b):
                _, _, _, h, doc_of, _ = _hashed(texts, hasher)
                _, n, anchor, _ = segments(h, doc_of, window, none)
                n_words += int(n.sum()) + (window - 1) * len(n)
                n_segments += len(n)
                met = np.concatenate([met, anchor])
            if len(met) > 1_000_000:
                yield out(met)
                met = none
        yield out(met)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2], pa.int64()), pa.array([n_words, n_segments], pa.int64())], ["gram", "n"])

    def out(met: np.ndarray) -> pa.RecordBatch:
        gram, n = np.unique(met, return_counts=True)
        often = n > 2
        return pa.RecordBatch.from_arrays([pa.array(gram[often].view(np.int64)), pa.array(n[often])], ["gram", "n"])

    counts = stage(rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = {r["gram"]: r["n"] for r in counts.filter("gram < 0").collect()}
    least = max(HOT_LEAST, total.get(-2, 0) // HOT_SHARE)
    hot = counts.filter(F.col("gram") >= 0).filter(F.col("n") > least).select("gram").collect()
    return total.get(-1, 0), np.sort(np.array([r["gram"] for r in hot], np.uint64))


def repeated_ranges(rows: DataFrame, window: int = 20) -> DataFrame:
    """(row_id, start, end): ranges of words covered by windows that also start earlier; ``rows`` has (row_id, id, text), row_id fixed."""
    rows = rows.select("row_id", F.col("id").cast("long").alias("id"), "text")
    n_words, hot = _hot_anchors(rows, window)
    shards = max(1, -(-n_words // SHARD_WORDS))
    none_id = -(1 << 63)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        numbers: dict[bytes, int] = {}
        seg, anchors, again, ids, rows_, starts_ = [], [], [], [], [], []
        held = 0

        def out() -> pa.RecordBatch:
            s, an, ag, i, r, st = (np.concatenate(x) for x in (seg, anchors, again, ids, rows_, starts_))
            texts = list(numbers)
            order = np.lexsort((st, r, i, s))
            lead = np.r_[True, s[order][1:] != s[order][:-1]]
            first, later = order[lead], order[~lead]
            keys, blobs = [], []
            size = np.array([t.count(b" ") + 1 for t in texts], np.int64)
            for part in np.array_split(later, max(1, len(later) // 50_000)):   # copies within the task are settled here
                if len(part):
                    keys.append(-1 - int(r[part[0]] % 1009))
                    blobs.append(np.stack([r[part], st[part], st[part] + size[s[part]]]).astype(np.int64).tobytes())
            shard = (mix(an[first]) % _U(shards)).astype(np.int64)
            by = np.lexsort((st[first], r[first], shard))
            cuts = np.flatnonzero(np.r_[True, shard[by][1:] != shard[by][:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(by)], strict=True):
                k = first[by[a:b]]
                keys.append(int(shard[by[a]]))
                blobs.append(_pack([texts[x] for x in s[k].tolist()], an[k], ag[k], i[k], r[k], st[k]))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["shard", "blob"])

        for b in batches:
            for row, doc, texts in _slices(b):
                buf, s0, s1, h, doc_of, first_word = _hashed(texts, hasher)
                first, n, anchor, twice = segments(h, doc_of, window, hot)
                if not len(first):
                    continue
                d = doc_of[first]
                seg.append(np.fromiter((numbers.setdefault(buf[x:y], len(numbers)) for x, y in zip(
                    s0[first].tolist(), s1[first + n + window - 2].tolist(), strict=True)), np.int64, len(first)))
                anchors.append(anchor)
                again.append(twice)
                ids.append(np.array([none_id if x is None else x for x in doc], np.int64)[d])
                rows_.append(np.array(row, np.int64)[d])
                starts_.append(first - first_word[d])
                held += len(first)
                if held > FLUSH_SEGMENTS:
                    yield out()
                    numbers = {}
                    seg, anchors, again, ids, rows_, starts_, held = [], [], [], [], [], [], 0
        if held:
            yield out()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for b in batches:
            for key, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key < 0:
                    yield _ranges(*np.frombuffer(blob.as_py(), np.int64).reshape(3, -1))
                    continue
                if key != shard and held:
                    yield shard_ranges(held, window)
                    held = []
                shard = key
                held.append(blob.as_py())
        if held:
            yield shard_ranges(held, window)

    sent = rows.mapInArrow(send, "shard long, blob binary")
    # As many tasks as shards, so a task's share does not grow with the corpus.
    return sent.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(search, "row_id long, start long, end long")


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 20, row: Column | None = None) -> DataFrame:
    """One row per document: row_id, id, n_words, n_removed, kept (the words left, joined by one space), kept_sha256."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = numbered(docs, row, "row_id", [F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")])
    per_row = repeated_ranges(rows, window).groupBy("row_id").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    rows = rows.withColumnRenamed("row_id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for text, starts, ends in zip(b.column(2), b.column(3), b.column(4), strict=True):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                n.append(len(words))
                if starts.is_valid:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, starts.values.to_numpy(), 1)
                    np.add.at(cover, ends.values.to_numpy(), -1)
                    left = np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()
                    gone.append(len(words) - len(left))
                    words = [words[i] for i in left]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["row_id", "id", "n_words", "n_removed", "kept", "kept_sha256"])

    return map_columns(rows.join(per_row, F.col("row") == F.col("row_id"), "left"), [F.col(c) for c in ("row", "id", "text", "starts", "ends")],
                       f"row_id long, id {kind}, n_words long, n_removed long, kept string, kept_sha256 string", run)
