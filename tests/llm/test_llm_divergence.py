"""Source divergence audit against a plain computation, and prefix refinement against plain document counts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from lifeboat.llm import divergence as dv
from lifeboat.llm.common import table

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain_audit(rows, s):
    docs = [(plain_terms(t), l or "", x or "") for t, l, x in rows]
    own, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for ts, l, x in docs:
        groups[l].add(x)
        own[l, x].update(ts)
        held[l].update(set(ts))
    out = []
    for l, sources in groups.items():
        kept = sorted(t for t, n in held[l].items() if n >= s.least_docs)
        every = Counter()
        for x in sources:
            every.update({t: own[l, x][t] for t in kept})

        def share(c):
            total = sum(c[t] for t in kept)
            return [1 + s.unit * (c[t] + s.smooth) // (total + s.smooth * len(kept)) for t in kept]

        p, q = {x: share(own[l, x]) for x in sources}, share(every)
        for x in sources:
            pair = [(-sum(abs(a - b) for a, b in zip(p[x], p[y])), y.encode()) for y in sources if y != x]
            term = [(b - a, t.encode()) for a, b, t in zip(p[x], q, kept) if own[l, x][t] and a > b]
            out += [(l, x, "pair", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(pair), 1)]
            out += [(l, x, "term", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(term)[:s.top], 1)]
    return sorted(out)


def check(df, s):
    got = dv.audit(df, s)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, s)


@pytest.mark.parametrize("s", [dv.Settings(least_docs=1), dv.Settings(least_docs=2, top=3, block_terms=7, tile=2), dv.Settings(least_docs=50)])
def test_edges(spark, s):
    check(edge_docs(spark), s)


def test_documents(spark):
    check(table(spark, "/root/testdata/sf0.001", "documents"), dv.Settings(least_docs=10, block_terms=100, tile=5))


def test_clashing_columns_and_empty(spark):
    df = edge_docs(spark).withColumn("term", F.lit(1)).withColumn("v", F.lit("x")).withColumn("terms", F.lit(2.0)).withColumn("rank", F.lit(9))
    check(df, dv.Settings(least_docs=2))
    assert dv.audit(empty_docs(spark)).count() == 0
    check(spark.createDataFrame([(None, None, None), ("", "en", "a"), ("!!", "en", None)], "text string, lang string, source string"), dv.Settings(least_docs=1))


def test_refinement_keeps_the_iceberg(spark):
    """Long shared prefixes, multi-byte characters cut in the middle, and a filter so small that checksums clash."""
    stems = ["interna", "international", "internationalisation", "x" * 300, "x" * 299 + "y", "é" * 9, "éé", "日本語", "日本", "a", "ab", "abc", "INTERNA"]
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(stems, rng.integers(0, 6))) + f" rare{i}", ["en", "fr", None][i % 3], "s") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    held = Counter((l or "", t) for _, x, l, _ in rows for t in set(plain_terms(x)))
    for bits in (64, 1 << 20):
        s = dv.Settings(least_docs=8, filter_bits=bits)
        kept, _, levels = dv.kept_terms(dv.term_table(df, "text", "lang", "source"), s)
        got = {(r["lang"], bytes(r["prefix"]).decode()): r["n"] for r in kept.collect()}
        assert got == {k: n for k, n in held.items() if n >= 8}
        assert [n for n, _ in levels] == [2 << i for i in range(len(levels))] and levels[-1][0] >= 300
        check(df, s)


def test_blocks_hold_nothing_by_document(spark):
    """Ten times the documents of the same terms make a block's row no larger."""
    def held(n):
        rows = [(f"one two three {['four', 'five'][i % 2]} two", ["en", "fr"][i % 2], f"s{i % 3}") for i in range(n)]
        blocks = dv.term_table(spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1), "text", "lang", "source")
        (r,) = blocks.collect()
        return sum(len(x) if isinstance(x, (bytes, bytearray)) else sum(map(len, x)) for x in r)
    assert held(300) == held(3000)


def test_prefix_counts_are_bounds(spark):
    """Of each prefix, at least the documents that have it and at most all of the language; exact where it is a whole term."""
    df = edge_docs(spark)
    docs = [(r["lang"] or "", set(plain_terms(r["text"]))) for r in df.collect()]
    terms = dv.term_table(df, "text", "lang", "source")
    for size in (1, 2, 4, 30_000):
        real = Counter((l, p) for l, ts in docs for p in {t.encode()[:size] for t in ts})
        got = {(r["lang"], bytes(r["prefix"])): r["n"] for r in dv._level(terms, size, None, 1).collect()}
        every = Counter(l for l, _ in docs)
        assert got.keys() == real.keys() and all(real[k] <= n <= every[k[0]] for k, n in got.items())
        assert size < 30_000 or got == real
