"""Source divergence audit: how far each source's word use lies from its language's and from every other source's.

Which terms are kept (those in at least ``least_docs`` documents of a language) is found
by iceberg prefix refinement. Terms are byte strings. At each level the prefixes
of terms to that many bytes are counted by documents, and those below the threshold
are dropped. A prefix's count in a block is the sum of its terms' distinct documents, at most all documents of the
language there: never less than the documents that have the prefix, so no term in enough documents is lost. The next level, of twice
the length, only looks at prefixes that extend a survivor. A term no longer than the level is its own prefix;
when no survivor is a part of a longer term, the survivors are the complete kept terms and their counts are exact.
Rare terms (most of a vocabulary) leave at a short prefix, before they cross the network.

What the next level needs of the survivors is a bit set of ``filter_bits`` bits (a fixed size, however
many survivors there are), in which each survivor sets the bit of its hash. A clash of
hashes lets a prefix through that is counted and dropped one level later; it never changes the result.

Documents are read once and staged in blocks: a dictionary of the block's terms, and of each term its distinct documents
and its occurrences by source. Nothing is held by document, neither there nor in the rows that pass through the JVM. A level is one pass
over the dictionaries that combines in the task before a grouped sum. Counts per (language, source, term) of the kept terms
are then one grouped table; shares are exact decimals and the rest is joins on it.
Sums over pairs of sources are made of blocks of about ``block_terms`` terms, all sources of a
language at a time and ``tile`` by ``tile`` of them, so neither a language with many sources
nor a source with a third of all rows meets in one task.

Defined results: null text, language and source count as ''; every (language, source) that occurs
is a group, also without terms; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeboat.llm.common import map_columns, stage

# Bytes that end a term become spaces and A-Z lower case; in UTF-8 every byte of a character beyond ASCII is 0x80 or more and stays.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    least_docs: int = 30
    smooth: int = 5
    unit: int = 1_000_000_000
    top: int = 50               # ranks of the part "term"
    first_level: int = 2        # bytes of the first prefixes; each level doubles them
    filter_bits: int = 1 << 24
    block_terms: int = 2000
    tile: int = 256


def terms_of(text: bytes) -> dict[bytes, int]:
    """The terms of a text with their counts; only A-Z become lower case."""
    return Counter(text.translate(_FOLD).split())


class _Codes(dict):
    """Numbers the terms of one language as they come."""

    def __init__(self, terms: list[bytes]):
        super().__init__()
        self.terms, self.new = terms, []

    def __missing__(self, term: bytes) -> int:
        code = self[term] = len(self.terms)
        self.terms.append(term)
        self.new.append(code)
        return code


BLOCK = "langs array<string>, sources array<string>, lang_docs binary, group_lang binary, group_source binary, terms array<binary>, term_lang binary, term_docs binary, starts binary, source binary, counts binary"
#: Bytes of text in one block.
_BLOCK_BYTES = 12_000_000
#: Rows that a task hands to the JVM at once.
_BATCH_ROWS = 1 << 14


class _Block:
    """Documents as they come, held as the codes and counts of their distinct terms until the block is full."""

    def __init__(self):
        self.langs, self.sources, self.terms, self.by_lang, self.size = {}, {}, [], [], 0
        self.doc_lang, self.doc_source, self.sizes, self.codes, self.counts = (array("i") for _ in range(5))

    def add(self, lang: str, source: str, text: bytes) -> None:
        l = self.langs.setdefault(lang, len(self.langs))
        if l == len(self.by_lang):
            self.by_lang.append(_Codes(self.terms))
        got = terms_of(text)
        self.doc_lang.append(l)
        self.doc_source.append(self.sources.setdefault(source, len(self.sources)))
        self.sizes.append(len(got))
        self.codes.extend(map(self.by_lang[l].__getitem__, got))
        self.counts.extend(got.values())
        self.size += len(text) + 100

    def encode(self) -> pa.RecordBatch:
        """One row: per term its language, its documents, and from ``starts`` on its sources with the occurrences in each."""
        doc_lang, doc_source, sizes, codes, counts = (np.frombuffer(x, np.int32) for x in (self.doc_lang, self.doc_source, self.sizes, self.codes, self.counts))
        n_sources, term_lang = len(self.sources), np.zeros(len(self.terms), np.int32)
        for l, d in enumerate(self.by_lang):
            term_lang[d.new] = l
        group = np.unique(doc_lang.astype(np.int64) * n_sources + doc_source)
        key = codes.astype(np.int64) * n_sources + np.repeat(doc_source, sizes)
        by = np.argsort(key)
        key = key[by]
        turn = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else by
        total = np.add.reduceat(counts[by], turn, dtype=np.int64) if len(key) else turn
        key = key[turn]
        raw = lambda x: pa.array([x.astype(np.int32).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([list(self.langs)], pa.list_(pa.string())), pa.array([list(self.sources)], pa.list_(pa.string())), raw(np.bincount(doc_lang)),
             raw(group // n_sources), raw(group % n_sources), pa.array([self.terms], pa.list_(pa.binary())), raw(term_lang),
             raw(np.bincount(codes, minlength=len(self.terms))), raw(np.searchsorted(key, np.arange(len(self.terms) + 1) * n_sources)), raw(key % n_sources), raw(total)],
            [c.split()[0] for c in BLOCK.split(", ")])


def term_table(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The blocks of all rows, staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                block.add(lang, source, text.as_py())
                if block.size > _BLOCK_BYTES:
                    yield block.encode()
                    block = _Block()
        if block.size:
            yield block.encode()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return stage(map_columns(docs, [text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text")], BLOCK, run), "terms")


def _ints(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int32)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _BATCH_ROWS):
        yield batch.slice(at, _BATCH_ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _lang_seed(lang: str) -> np.uint64:
    raw = lang.encode("utf-8", "surrogatepass")
    return prefix_hashes(pa.array([raw], pa.binary()), max(8, len(raw)), _U(0))[0]


def prefix_hashes(terms: pa.Array, size: int, seed: np.uint64) -> np.ndarray:
    """64-bit hashes of the first ``size`` bytes of each term."""
    offsets = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
    have = np.minimum(offsets[1:] - offsets[:-1], size)
    h = _mix(have.astype(np.uint64) ^ seed)
    for at in range(0, size, 8):                        # eight bytes at a time, zeros past the end
        left = have > at
        if not left.any():
            break
        word = np.zeros(int(left.sum()), np.uint64)
        start, n = offsets[:-1][left] + at, np.minimum(have[left] - at, 8)
        for i in range(8):
            more = n > i
            word[more] |= data[start[more] + i].astype(np.uint64) << _U(8 * i)
        h[left] = _mix(h[left] ^ _mix(word + _U(at + 1)))
    return h


class Survivors:
    """Bit set of the prefixes that are left, by language and prefix."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, _U(8 * len(bits) - 1)

    def has(self, terms: pa.Array, size: int, seed: np.uint64) -> np.ndarray:
        """Which of ``terms`` have a first ``size`` bytes in the set (all that survive, and those that clash with one)."""
        at = prefix_hashes(terms, size, seed) & self.mask
        return (self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)


def _bit_set(prefixes: DataFrame, size: int, n_bits: int) -> np.ndarray:
    """The survivors' bit set: their bits as 64-bit words, or-ed per place, at most n_bits / 64 rows to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, at = b.column(0).dictionary_encode(), np.zeros(b.num_rows, np.int64)
            for l, name in enumerate(lang.dictionary.to_pylist()):
                mine = np.flatnonzero(lang.indices.to_numpy() == l)
                at[mine] = (prefix_hashes(b.column(1).take(pa.array(mine)), size, _lang_seed(name)) & _U(n_bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6, pa.int64()), pa.array(np.left_shift(np.int64(1), at & 63))], ["word", "bits"])

    rows = map_columns(prefixes, [F.col("lang"), F.col("prefix")], "word long, bits long", run)
    got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(n_bits // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _level(terms: DataFrame, size: int, before: tuple[int, Survivors] | None, least: int) -> DataFrame:
    """(lang, prefix, n, longer) of the prefixes of ``size`` bytes that extend a survivor and count ``least`` documents; longer: part of a longer term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                langs, all_terms, lang_docs, term_lang, docs = b.column(0)[r].as_py(), b.column(2)[r].values, *(_ints(b.column(i)[r]) for i in (1, 3, 4))
                names, prefixes, counts, longer = [], [], [], []
                for l, lang in enumerate(langs):
                    mine = np.flatnonzero(term_lang == l)
                    own = all_terms.take(pa.array(mine))
                    if before is not None:
                        ok = before[1].has(own, before[0], _lang_seed(lang))
                        mine, own = mine[ok], own.filter(pa.array(ok))
                    coded = pc.binary_slice(own, 0, size).dictionary_encode()
                    at, k = coded.indices.to_numpy(), len(coded.dictionary)
                    names.append(pa.array([lang], pa.string()).take(pa.array(np.zeros(k, np.int64))))
                    prefixes.append(coded.dictionary)
                    counts.append(np.minimum(np.bincount(at, docs[mine], k).astype(np.int64), lang_docs[l]))
                    longer.append(np.bincount(at, pc.binary_length(own).to_numpy() > size, k) > 0)
                yield from _pieces(pa.RecordBatch.from_arrays([pa.concat_arrays(names), pa.concat_arrays(prefixes), pa.array(np.concatenate(counts)),
                                                               pa.array(np.concatenate(longer))], ["lang", "prefix", "n", "longer"]))

    rows = map_columns(terms, [F.col(c) for c in ("langs", "lang_docs", "terms", "term_lang", "term_docs")], "lang string, prefix binary, n long, longer boolean", run)
    return rows.groupBy("lang", "prefix").agg(F.sum("n").alias("n"), F.max("longer").alias("longer")).filter(F.col("n") >= least)


def kept_terms(terms: DataFrame, s: Settings) -> tuple[DataFrame, tuple[int, Survivors], list[tuple[int, int]]]:
    """(lang, prefix, n, longer) of the complete kept terms, the last level's bytes and bit set, and (bytes, survivors) of each level."""
    size, before, seen = s.first_level, None, []
    while True:
        level = stage(_level(terms, size, before, s.least_docs), "prefixes")
        survivors = Survivors(_bit_set(level, size, s.filter_bits))
        n, open_ = level.agg(F.count("*"), F.coalesce(F.max(F.col("longer").cast("int")), F.lit(0))).first()
        seen.append((size, n))
        if not open_:
            return level, (size, survivors), seen
        size, before = 2 * size, (size, survivors)


def term_counts(terms: DataFrame, last: tuple[int, Survivors]) -> DataFrame:
    """(lang, source, term, n): occurrences per group of the terms that the survivors' bit set lets through.

    A task hands on one row per language and term, with its sources and counts; they meet by language and term, so
    a frequent term is as many rows as there are tasks, not documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                langs, sources, all_terms = b.column(0)[r].as_py(), b.column(1)[r].values, b.column(2)[r].values
                term_lang, starts, source, n = (_ints(b.column(i)[r]) for i in (3, 4, 5, 6))
                ok = np.zeros(len(all_terms), bool)
                for l, lang in enumerate(langs):
                    mine = np.flatnonzero(term_lang == l)
                    ok[mine] = last[1].has(all_terms.take(pa.array(mine)), last[0], _lang_seed(lang))
                size = np.diff(starts)
                term, entry = np.flatnonzero(ok), np.repeat(ok, size)
                cuts = pa.array(np.r_[0, np.cumsum(size[ok])].astype(np.int32))
                yield from _pieces(pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()).take(pa.array(term_lang[term])), all_terms.take(pa.array(term)),
                     pa.ListArray.from_arrays(cuts, sources.take(pa.array(source[entry]))), pa.ListArray.from_arrays(cuts, pa.array(n[entry].astype(np.int64)))],
                    ["lang", "term", "sources", "ns"]))

    rows = map_columns(terms, [F.col(c) for c in ("langs", "sources", "terms", "term_lang", "starts", "source", "counts")],
                       "lang string, term binary, sources array<string>, ns array<long>", run)
    each = rows.repartition("lang", "term").select("lang", "term", F.explode(F.arrays_zip("sources", "ns")).alias("x"))
    return each.groupBy("lang", "term", F.col("x.sources").alias("source")).agg(F.sum("x.ns").alias("n"))


def _groups(terms: DataFrame) -> DataFrame:
    """The distinct (lang, source) of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([b.column(i)[r].values.take(pa.array(_ints(b.column(i + 2)[r]))) for i in (0, 1)], ["lang", "source"])

    return map_columns(terms, [F.col(c) for c in ("langs", "sources", "group_lang", "group_source")], "lang string, source string", run).distinct()


def _share(n: str, total: str, s: Settings) -> Column:
    """p = 1 + floor(unit * (n + smooth) / (total + smooth * v)), in exact decimals (0 kept terms: 1, which no sum uses)."""
    down = f"CAST({total} + {s.smooth} * v AS DECIMAL(20, 0))"
    return F.expr(f"CASE WHEN v = 0 THEN 1L ELSE 1L + (CAST({s.unit} AS DECIMAL(12, 0)) * CAST({n} + {s.smooth} AS DECIMAL(20, 0))) DIV {down} END")


def _pair_sums(blocks: DataFrame, tile: int) -> DataFrame:
    """(lang, source, item, value): partial sums over terms of abs(p - q) of each ordered pair of a language's sources.

    ``blocks`` has (lang, sources: every source with its p of a term it lacks, terms: per term the (source, p) that have it, or null).
    """
    def rows(lang: str, names: list[str], at: int, sums: np.ndarray) -> pa.RecordBatch:
        """Sums of the sources from ``at`` on with all sources, in both directions."""
        i, j = np.nonzero(np.arange(at, at + len(sums))[:, None] < np.arange(len(names))[None, :])
        value, i, k = sums[i, j], i + at, len(i)
        left = pa.array(names).take(pa.array(np.concatenate([i, j])))
        right = pa.array(names).take(pa.array(np.concatenate([j, i])))
        return pa.RecordBatch.from_arrays([pa.array([lang] * (2 * k), pa.string()), left, right, pa.array(np.concatenate([value, value]))],
                                          ["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[str], np.ndarray]] = {}
        for b in batches:
            for r in range(b.num_rows):
                lang, sources, terms = b.column(0)[r].as_py(), b.column(1)[r].values, b.column(2)[r]
                names, zero = sources.field(0).to_pylist(), sources.field(1).to_numpy()
                entries = terms.values if terms.is_valid else None
                p = np.tile(zero, (0 if entries is None else len(entries), 1))
                if len(p):
                    place = {x: i for i, x in enumerate(names)}
                    flat = entries.flatten()
                    size = np.diff(entries.offsets.to_numpy())
                    p[np.repeat(np.arange(len(p)), size), [place[x] for x in flat.field(0).to_pylist()]] = flat.field(1).to_numpy()
                small = len(names) <= tile
                total = held[lang][1] if lang in held else np.zeros((len(names), len(names)), np.int64) if small else None
                for at in range(0, len(names), tile):
                    part = total if small else np.zeros((min(tile, len(names) - at), len(names)), np.int64)
                    if len(p):
                        for i in range(len(part)):
                            part[i] += np.abs(p[:, at + i:at + i + 1] - p).sum(0)
                    if not small:
                        yield rows(lang, names, at, part)
                if small:
                    held[lang] = names, total
                if len(held) > 64:
                    yield from (rows(x, n, 0, t) for x, (n, t) in held.items())
                    held = {}
        yield from (rows(x, n, 0, t) for x, (n, t) in held.items())

    return map_columns(blocks, [F.col(c) for c in ("lang", "sources", "terms")], "lang string, source string, item string, value long", run)


def audit(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' has every other source of the language with the summed distance of
    shares, part 'term' the ``top`` kept terms the source uses more than its language."""
    s = settings
    terms = term_table(docs, text_col, lang_col, source_col)
    found, survivors, _ = kept_terms(terms, s)
    kept = found.select("lang", F.col("prefix").alias("term"))
    counts = stage(term_counts(terms, survivors).join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("v")).join(counts.groupBy("lang").agg(F.sum("n").alias("lang_total")), "lang")
    groups = stage(_groups(terms)
                   .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                   .join(per_lang, "lang", "left").na.fill(0, ["total", "v", "lang_total"]), "groups")
    every = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    shares = stage(counts.join(groups, ["lang", "source"]).join(every, ["lang", "term"])
                   .select("lang", "source", "term", "v", _share("n", "total", s).alias("p"), _share("lang_n", "lang_total", s).alias("q")), "shares")

    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = (shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
           .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= s.top))

    # A language's sources are one array: the result has as many rows for each of them.
    sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", _share("0", "total", s).alias("p")))).alias("sources"))
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / s.block_terms))
    per_term = shares.groupBy("lang", "v", "term").agg(F.collect_list(F.struct("source", "p")).alias("entries"))
    blocks = per_term.groupBy("lang", block.alias("block")).agg(F.collect_list("entries").alias("terms"))
    pairs = (_pair_sums(sources.join(blocks, "lang", "left"), s.tile).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(first)))
    return pairs.unionByName(top)
