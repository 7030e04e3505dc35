"""Benchmark decontamination by latent semantic retrieval.

The latent space is fitted on TF-IDF passages of the corpus (all passages of all documents) and the benchmark's items, weighted
alike: a distributed randomised SVD, every product a job over the staged sparse passages whose partial
sums are added up word range by word range in tasks. Words are counted over all documents, once for all items.

Every document is then retrieved against: its words are summed in the latent space in cells of 16 words,
and each item is compared by cosine with the passages of the item's own width (so many
cells as surely hold the item whole), one every 16 words. Items with a passage above the threshold are candidates and go
to the checks on the whole text: a longest common subsequence of the item and a stretch of the text of about
the item's length. A candidate is a leak when the subsequence covers most of the item; or a good part of it
while the item's answer (its last quarter) is there; or, for paraphrases that keep fewer of the words, a smaller part
while the answer is there and the passage's cosine is high. Only the retrieval leads to the third kind.

For the first two kinds a net of rare words makes sure that no cut of the rank loses a verbatim or edited copy: a leak has
at least ``need`` of the item's words, so it has at least ``anchors`` of the item's ``length - need + anchors``
rarest ones close together. Lists from those words to items (in all as long as the items' texts) name such
items; they, too, are checked. The result for these kinds is that of checking every document against every item (tested).

The benchmark is the stated query set. It is taken in blocks of at most ``block_items`` items and ``block_words``
words, which bounds what is broadcast (the latent vectors of at most ``block_words + fit_words`` words); a block is one narrow pass
over the documents, without a shuffle. All documents, all words and all passages take part.

Defined results: null and empty texts and items have no words and match
nothing; items of fewer than eight words match only in full, word for word;
repeated rows and items are reported one by one; empty tables give an empty
result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import free_name, map_columns, numbered, stage, text_or_empty

#: Cells compared at once, and characters of text read at once.
_CHUNK_CELLS = 2048
_SLICE_CHARS = 400_000
# Bytes of ASCII characters that are in no word become spaces; characters beyond ASCII that are in none are replaced before.
_GAPS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_WIDE_GAP = re.compile(r"[^\w\x00-\x7f]+")


@dataclass(frozen=True)
class Settings:
    cell: int = 16              # words between the starts of two passages
    passage: int = 64           # words of a passage that the latent space is fitted on
    rank: int = 96              # dimensions of the latent space, at most
    power: int = 1              # power iterations of the randomised SVD
    fit_words: int = 12_000     # corpus words with a latent vector besides those of the items: those in most passages
    cosine: float = 0.7         # passages from here on are candidates
    lcs: float = 0.8            # share of the item in common order that makes a leak
    lcs_answer: float = 0.6     # share that does if the answer is there too
    lcs_paraphrase: float = 0.45    # share that does if the answer is there and the passage is alike
    cosine_paraphrase: float = 0.7
    common: float = 0.1         # words in more than this share of all documents weigh nothing
    answer: float = 0.8         # share of the answer in common order
    anchors: int = 3            # rare words of an item, close together, that the net asks for
    block_items: int = 4_000    # items, and words of items, compared in one pass
    block_words: int = 400_000


def tokens(text: str) -> list[bytes]:
    """Runs of letters and digits, in lower case, as UTF-8."""
    text = text.lower()
    if not text.isascii() and _WIDE_GAP.search(text):
        text = _WIDE_GAP.sub(" ", text)
    return text.encode("utf-8", "surrogatepass").translate(_GAPS).split()


def words(text: str) -> list[str]:
    """``tokens`` as strings."""
    return [t.decode("utf-8", "surrogatepass") for t in tokens(text)]


def lcs_length(masks: dict[int, int], n: int, other: list[int]) -> int:
    """Length of the longest common subsequence of ``other`` and the n words behind ``masks`` (bit-parallel)."""
    full = (1 << n) - 1
    v = full
    for w in other:
        u = v & masks.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


class Item:
    """One benchmark item: its name, word numbers, and bit masks of it and of its answer."""

    def __init__(self, name, ids: list[int]):
        self.name, self.ids = name, ids
        self.answer = ids[-max(1, len(ids) // 4):]
        self.masks, self.answer_masks = ({}, {})
        for masks, seq in ((self.masks, ids), (self.answer_masks, self.answer)):
            for i, w in enumerate(seq):
                masks[w] = masks.get(w, 0) | 1 << i

    def least(self, s: Settings, share: float | None = None) -> tuple[int, int]:
        """(words of the item, within so many words) that a leak has; all of them, side by side, if the item is short."""
        m = len(self.ids)
        return (m, m) if m < 8 else (math.ceil((share or s.lcs_answer) * m - 1e-9), m + m // 4)

    def check(self, region: list[int] | np.ndarray, s: Settings, at: np.ndarray | None = None,
              near=None) -> tuple[float, float, int, int] | None:
        """(share, answer share, start, end) of the best stretch of ``region`` if it is a leak.

        ``at``: places of the item's words; ``near(start, end)``: largest cosine of the passages there, without it no stretch is a paraphrase.
        """
        m, region = len(self.ids), np.asarray(region)
        if m < 8:
            at = np.arange(len(region)) if at is None else at
            at = at[at <= len(region) - m]
            for i, w in enumerate(self.ids):
                at = at[region[at + i] == w]
            return (1.0, 1.0, int(at[0]), int(at[0]) + m) if len(at) else None
        # Words the item has, with their places; a stretch with too few of them cannot hold enough in order.
        floor = s.lcs_answer if near is None else s.lcs_paraphrase
        need, span, best = *self.least(s, floor), None
        sure = self.least(s)[0]
        at = np.flatnonzero(np.isin(region, self.ids)) if at is None else at
        if len(at) < need:
            return None
        after, step = -1, max(1, m // 8)
        for k in np.flatnonzero(at[need - 1:] < at[:len(at) - need + 1] + span).tolist():
            if at[k] < after:
                continue
            end = int(np.searchsorted(at, at[k] + span))
            if end - k < sure and near(int(at[k]), int(at[end - 1]) + 1) < s.cosine_paraphrase:
                continue                                # too few words for any other kind, not alike enough for this
            part = region[at[k:end]].tolist()
            after = at[k] + step
            share = lcs_length(self.masks, m, part) / m
            if share >= floor and (best is None or share > best[0]):
                told = lcs_length(self.answer_masks, len(self.answer), part) / len(self.answer)
                start, stop = int(at[k]), int(at[end - 1]) + 1
                if share >= s.lcs or told >= s.answer and (share >= s.lcs_answer or near(start, stop) >= s.cosine_paraphrase):
                    best = (share, told, start, stop)
        return best


def _lengths(n: int, passage: int) -> list[int]:
    """Words of the passages of a text of ``n`` words: all words are in one, a last half passage or less goes with the one before."""
    k = max(1, (n + passage // 2 - 1) // passage)
    return [*[passage] * (k - 1), n - passage * (k - 1)] if n else []


#: Words counted in a task before their counts are handed on.
_COUNTED = 500_000


def word_counts(rows: DataFrame, s: Settings) -> DataFrame:
    """(word, docs, passages) over all documents, staged: how many of them, and of their passages, have the word; of no word: how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m, docs, passages = 0, 0, Counter(), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([None, *docs], pa.binary()), pa.array([n, *docs.values()], pa.int64()),
                                               pa.array([m, *(passages[w] for w in docs)], pa.int64())], ["word", "docs", "passages"])

        for b in batches:
            for t in b.column(0):
                ws, at = tokens(t.as_py()), 0
                n += 1
                docs.update(set(ws))
                for size in _lengths(len(ws), s.passage):
                    passages.update(set(ws[at:at + size]))
                    at, m = at + size, m + 1
                if len(docs) > _COUNTED:
                    yield told()
                    n, m, docs, passages = 0, 0, Counter(), Counter()
        yield told()

    got = map_columns(rows, [text_or_empty("text").alias("text")], "word binary, docs long, passages long", run)
    return stage(got.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("passages").alias("passages")), "words")


def document_frequency(counts: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """Rows of the corpus, and in how many of them each word is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [-1 if w is None else vocabulary.get(w, -2) for w in b.column(0).to_pylist()]
            got = pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), b.column(1)], ["word", "n"])
            yield got.filter(pa.array([i > -2 for i in ids], pa.bool_()))

    total, out = 0, np.zeros(len(vocabulary), np.int64)
    got = map_columns(counts, [F.col("word"), F.col("docs")], "word int, n long", run).toArrow()        # one row per word of the vocabulary at most
    for w, n in zip(got.column("word").to_pylist(), got.column("n").to_pylist(), strict=True):
        if w < 0:
            total = n
        else:
            out[w] = n
    return total, out


def fit_passages(rows: DataFrame, vocabulary: dict[bytes, int], idf: np.ndarray, s: Settings) -> DataFrame:
    """(weight, ids of the words that weigh something) of all passages of all documents, staged."""
    weighs = {w: i for w, i in vocabulary.items() if idf[i] > 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = weighs.get
        for b in batches:
            parts, sizes = [np.empty(0, np.int32)], []
            for t in b.column(0):
                ws = tokens(t.as_py())
                parts.append(np.fromiter(map(get, ws, repeat(-1)), np.int32, len(ws)))
                sizes += _lengths(len(ws), s.passage)
            ids = np.concatenate(parts)
            kept = np.r_[0, np.cumsum(ids >= 0)][np.r_[0, np.cumsum(sizes, dtype=np.int64)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(sizes))), pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(ids[ids >= 0]))], ["weight", "ids"])

    return stage(map_columns(rows, [F.col("text")], "weight double, ids array<int>", run), "passages")


def corpus_words(counts: DataFrame, most: int) -> list[bytes]:
    """The words in most passages, two at least; of equal counts the smaller first."""
    return [bytes(r["word"]) for r in counts.filter("word is not null and passages > 1").orderBy(F.desc("passages"), "word").limit(most).collect()]


#: Words of one range whose partial sums are added up in one task, and passages multiplied at once.
_RANGE, _FIT_ROWS = 512, 512


def randomised_svd(passages: DataFrame, idf: np.ndarray, rank: int, power: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors (words x rank) of the weighted TF-IDF matrix whose rows are ``passages`` (weight, ids).

    Every product with the matrix is a job over the passages. A task makes partial
    sums of words x rank numbers and hands them on in ranges of words; each range is
    added up in one task, so the driver gets one matrix, however many tasks there are.
    """
    v = len(idf)
    k = min(v, rank + 8)

    def product(basis: np.ndarray, gram: bool) -> np.ndarray:
        height, basis = k if gram else v, basis.astype(np.float32)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, met = np.zeros((height, k), np.float32), False
            for b in batches:
                for at in range(0, b.num_rows, _FIT_ROWS):
                    part = b.slice(at, _FIT_ROWS)
                    lists = part.column(1)
                    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                    if not len(row):
                        continue
                    cell, tf = np.unique(row * v + lists.flatten().to_numpy(), return_counts=True)
                    row, word = cell // v, cell % v
                    x = tf * idf[word]
                    norm = np.sqrt(np.bincount(row, x * x, len(lists)))
                    x = (x * (part.column(0).to_numpy() / np.maximum(norm, 1e-12))[row]).astype(np.float32)
                    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                    y = np.add.reduceat(basis[word] * x[:, None], first, axis=0)
                    met = True
                    if gram:
                        total += y.T @ y
                    else:
                        by = np.argsort(word, kind="stable")
                        turn = np.flatnonzero(np.r_[True, word[by][1:] != word[by][:-1]])
                        nth = (np.cumsum(np.r_[True, row[1:] != row[:-1]]) - 1)[by]
                        total[word[by][turn]] += np.add.reduceat(y[nth] * x[by, None], turn, axis=0)
            if met:
                cuts = range(0, height, _RANGE)
                yield pa.RecordBatch.from_arrays([pa.array([i // _RANGE for i in cuts], pa.int32()),
                                                  pa.array([total[i:i + _RANGE].tobytes() for i in cuts], pa.binary())], ["part", "m"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for part, m in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    x = np.frombuffer(m.as_buffer(), np.float32)
                    sums[part] = sums[part] + x if part in sums else x
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "m"])

        parts = (passages.select("weight", "ids").mapInArrow(partial, "part int, m binary").repartition(8, "part").mapInArrow(add, "part int, m binary"))
        out = np.zeros((height, k))
        for r in parts.collect():
            out[r["part"] * _RANGE:(r["part"] + 1) * _RANGE] = np.frombuffer(r["m"], np.float32).reshape(-1, k)
        return out

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((v, k)))[0]
    for _ in range(power + 1):
        q = np.linalg.qr(product(q, False))[0]
    values, vectors = np.linalg.eigh(product(q, True))
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-10 * max(values.max(), 1e-12)]
    return q @ vectors[:, keep]


class Retriever:
    """Latent candidates of texts and their checks; what a task needs of one block of items."""

    def __init__(self, vocabulary: dict[bytes, int], items: list[Item], df: np.ndarray, latent: np.ndarray, settings: Settings):
        s = self.settings = settings
        self.vocabulary, self.items, self.none = vocabulary, items, len(latent)
        # The last row, of zeros, is that of words without a vector.
        self.latent = np.vstack([latent, np.zeros(latent.shape[1])]).astype(np.float32)
        self.weighs = self.latent.any(axis=1)
        queries = np.array([self.latent[item.ids].sum(0) for item in items])
        queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
        # Items by the cells that surely hold them whole.
        width = np.array([-(-(len(item.ids) - 1) // s.cell) + 1 for item in items])
        self.order = np.argsort(width, kind="stable")
        self.queries = queries[self.order].T.copy()
        self.column = np.argsort(self.order)
        width = width[self.order]
        edge = np.flatnonzero(np.r_[True, width[1:] != width[:-1], True]).tolist()
        self.widths = [(int(width[a]), a, b) for a, b in zip(edge, edge[1:])]
        # The net: lists from an item's rarest words to the item.
        lists: dict[int, list[int]] = {}
        self.anchors = np.zeros(len(items), np.int64)
        self.span = np.zeros(len(items), np.int64)
        for j, item in enumerate(items):
            need, span = item.least(s)
            self.anchors[j] = a = min(need, s.anchors)
            self.span[j] = span
            rare = sorted(item.ids, key=lambda w: (df[w], w))[:len(item.ids) - need + a]
            for w in set(rare):
                lists.setdefault(w, []).append(j)
        size = np.array([len(lists.get(w, ())) for w in range(self.none + 1)])
        self.list_start, self.list_size = np.cumsum(size) - size, size
        self.listed = np.array(list(chain.from_iterable(lists.get(w, ()) for w in range(self.none + 1))), np.int32)

    def _cells(self, ids: np.ndarray) -> np.ndarray:
        """Running sums of the latent vectors of the cells of ``ids`` (whole cells), a zero row first."""
        s, n = self.settings, len(ids) // self.settings.cell
        out = np.zeros((n + 1, self.latent.shape[1]), np.float32)
        known = np.flatnonzero(self.weighs[ids])
        if len(known):
            cell = known // s.cell
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            out[cell[first] + 1] = np.add.reduceat(self.latent[ids[known]], first, axis=0)
        return out

    def alike(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first cell, item) of the passages at or above the threshold; ``ids`` in whole cells."""
        s, n_cells, widest = self.settings, len(ids) // self.settings.cell, self.widths[-1][0]
        where, which = [], []
        for at in range(0, n_cells, _CHUNK_CELLS):
            end = min(n_cells, at + _CHUNK_CELLS + widest)
            cells = self._cells(ids[at * s.cell:end * s.cell])[1:]
            for width, a, b in self.widths:
                n = min(_CHUNK_CELLS, max(1, len(cells) - width + 1))
                vec = cells[:n].copy()
                for i in range(1, min(width, len(cells))):
                    vec += cells[i:i + n]
                norm = np.sqrt(np.einsum("ij,ij->i", vec, vec))
                hit, item = np.nonzero(vec @ self.queries[:, a:b] >= s.cosine * np.maximum(norm, 1e-6)[:, None])
                where.append(hit + at)
                which.append(self.order[item + a])
        return np.concatenate(where), np.concatenate(which)

    def netted(self, ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) where so many of the item's rare words stand close together in one document."""
        size = self.list_size[ids]
        at = np.flatnonzero(size)
        size = size[at]
        item = self.listed[np.repeat(self.list_start[ids[at]] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        place = np.repeat(at, size)
        by = np.argsort(item, kind="stable")            # places stay in order
        item, place = item[by], place[by]
        found_doc, found_item = [], []
        for a in np.unique(self.anchors).tolist():
            mine = self.anchors[item] == a
            i, p = item[mine], place[mine]
            if len(i) >= a:
                first, last = p[:len(p) - a + 1], p[a - 1:]
                ok = (i[:len(i) - a + 1] == i[a - 1:]) & (last - first < self.span[i[:len(i) - a + 1]]) & (doc[first] == doc[last])
                found_doc.append(doc[first[ok]])
                found_item.append(i[:len(i) - a + 1][ok])
        none = np.empty(0, np.int64)
        return np.concatenate([none, *found_doc]), np.concatenate([none, *found_item])

    def find(self, texts: list[str]) -> Iterator[tuple[int, object, float, float, float, int, int]]:
        """(text, item name, cosine, lcs, answer, start word, end word) of each item in the texts, its best place."""
        s, get, none = self.settings, self.vocabulary.get, self.none
        parts, sizes = [], []
        for t in texts:
            ws = tokens(t)
            ids = np.fromiter(map(get, ws, repeat(none)), np.int32, len(ws))
            sizes.append(len(ids))
            parts.append(ids)
            if pad := -len(ids) % s.cell:               # a text starts a cell
                parts.append(np.full(pad, none, np.int32))
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        if not len(ids):
            return
        sizes = np.array(sizes)
        whole = -(-sizes // s.cell) * s.cell
        start = np.cumsum(whole) - whole
        doc = np.repeat(np.arange(len(texts)), whole)
        cell, which = self.alike(ids)
        # A passage may reach over the next texts: they are candidates, too.
        reach = np.array([-(-(len(item.ids) - 1) // s.cell) + 1 for item in self.items])
        last = np.minimum(cell + reach[which], len(ids) // s.cell) - 1
        low, high = doc[cell * s.cell], doc[last * s.cell]
        by_item: dict[int, dict[int, list[int]]] = {}      # item -> text -> first words of its passages that are alike
        for j, c, a, b in zip(which.tolist(), cell.tolist(), low.tolist(), high.tolist(), strict=True):
            for d in range(a, b + 1):
                by_item.setdefault(j, {}).setdefault(d, []).append(c * s.cell - int(start[d]))
        for d, j in zip(*(x.tolist() for x in self.netted(ids, doc)), strict=True):
            by_item.setdefault(j, {}).setdefault(d, [])
        mask = np.zeros(none + 1, bool)
        for j, docs in sorted(by_item.items()):
            item, width = self.items[j], int(reach[j]) * s.cell
            mask[item.ids] = True
            for d, alike in sorted(docs.items()):
                own = ids[start[d]:start[d] + sizes[d]]
                at = np.flatnonzero(mask[own])
                if len(at) < item.least(s, s.lcs_paraphrase if alike else None)[0]:
                    continue
                alike.sort()

                def near(a: int, b: int, own=own, j=j, alike=alike, width=width) -> float:
                    """Cosine of a stretch that a retrieved passage overlaps, else 0."""
                    i = bisect_left(alike, b)
                    return self.cosine(j, own, a, b) if i and alike[i - 1] + width > a else 0.0

                found = item.check(own, s, at, near if alike else None)
                if found:
                    yield d, item.name, self.cosine(j, own, found[2], found[3]), *found
            mask[item.ids] = False

    def cosine(self, j: int, ids: np.ndarray, a: int, b: int) -> float:
        """Cosine of words ``a`` to ``b`` of a text with item ``j``."""
        vec = self.latent[ids[a:b]].sum(0)
        return float(vec @ self.queries[:, self.column[j]] / max(np.linalg.norm(vec), 1e-6))


FOUND = "cosine double, lcs double, answer double, start_word long, end_word long"


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t.as_py())
        size += len(held[-1])
        if size > _SLICE_CHARS:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


def _block(rows: DataFrame, counts: DataFrame, common: list[bytes], items: list[tuple], s: Settings, item_kind: str) -> DataFrame | None:
    """Leaks of one block of items (name, words): the latent space, a narrow pass over the documents."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws} | set(common)))}
    known = [Item(n, [vocabulary[w] for w in ws]) for n, ws in items]
    total, df = document_frequency(counts, vocabulary)
    idf = np.where(df > s.common * max(total, 100), 0.0, np.log((total + 1) / (df + 1)) + 1e-3)
    spark = rows.sparkSession
    passages = fit_passages(rows, vocabulary, idf, s)
    n = s.passage
    cut = [item.ids[i:i + n] for item in known for i in range(0, max(1, len(item.ids) - n // 2), n // 2)]
    weight = math.sqrt(max(1, passages.count()) / len(cut))     # the items weigh as much as the corpus
    both = passages.unionByName(stage(spark.createDataFrame([(weight, c) for c in cut], "weight double, ids array<int>").coalesce(1), "fitted"))
    latent = idf[:, None] * randomised_svd(both, idf, s.rank, s.power)
    retriever = Retriever(vocabulary, known, df, latent, s)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(at + d, *found) for at, texts in _slices(b.column(2)) for d, *found in retriever.find(texts)]
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            at = pa.array(cols[0], pa.int64())
            kinds = (item_type, *[pa.float64()] * 3, pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *(pa.array(c, t) for c, t in zip(cols[1:], kinds, strict=True))],
                                             ["row_id", "id", "item", "cosine", "lcs", "answer", "start_word", "end_word"])

    item_type = spark.createDataFrame([], f"item {item_kind}").toArrow().schema.field(0).type
    return map_columns(rows, [F.col("row_id"), F.col("id"), F.col("text")], f"row_id long, id {kind}, item {item_kind}, {FOUND}", run)


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id",
          item_text: str = "text", settings: Settings = Settings(), row: Column | None = None) -> DataFrame:
    """One row per document row and benchmark item it contains: row_id, id, item, cosine, lcs, answer, start_word, end_word.

    ``row``: see ``common.numbered``.
    """
    s = settings
    items = stage(benchmark.select(F.col(item_col).alias("item"), text_or_empty(item_text).alias("text")), "items")
    spark, item_kind = docs.sparkSession, items.schema["item"].dataType.simpleString()
    rows = numbered(docs, row, "row_id", [F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")])
    counts = word_counts(rows, s)
    common = corpus_words(counts, s.fit_words)
    found, block, size = [], [], 0
    for r in items.orderBy("item", "text").toLocalIterator():      # the query set, a block at a time
        if ws := tokens(r["text"]):
            block.append((r["item"], ws))
            size += len(ws)
        if len(block) == s.block_items or size >= s.block_words:
            found.append(_block(rows, counts, common, block, s, item_kind))
            block, size = [], 0
    if block:
        found.append(_block(rows, counts, common, block, s, item_kind))
    if not found:
        return spark.createDataFrame([], f"row_id long, id {docs.schema[id_col].dataType.simpleString()}, item {item_kind}, {FOUND}")
    return reduce(DataFrame.unionByName, found)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               settings: Settings = Settings(), row: Column | None = None) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item; same columns."""
    name = free_name(docs, "row_id")
    own = numbered(docs, row, name)
    gone = stage(leaks(own, benchmark, text_col, id_col, settings=settings, row=F.col(name)).select(F.col("row_id").alias(name)).distinct(), "leaks")
    return own.join(gone, name, "left_anti").drop(name)
