"""SimHash, substring dedup and packing against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_helpers import edge_docs, empty_docs, plain, prose
from pyspark.sql import functions as F

from lifeboat.llm import components, packing, simhash, substring_dedup
from lifeboat.llm.common import table

SF = "/root/testdata/sf0.01"


def _fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps, most=3):
    """Component of each fingerprint by comparing every pair."""
    f = np.array(sorted(set(fps)), np.uint64)
    label = np.arange(len(f))
    while True:
        new = label.copy()
        for i in range(len(f)):
            near = np.bitwise_count(f ^ f[i]) <= most
            new[near] = np.minimum(new[near], label[near].min())
        if (new == label).all():
            return {int(x): int(c) for x, c in zip(f, label, strict=True)}
        label = new


@pytest.mark.parametrize("source", ["edges", "documents", "near"])
def test_simhash_components(spark, source):
    df = edge_docs(spark).withColumn("text", F.substring("text", 1, 20_000)) if source == "edges" else table(spark, SF, "documents")
    if source == "near":                # six texts that differ in the last word, of every longer text
        df = (df.filter("n_chars > 3000").withColumn("n", F.explode(F.array(*map(F.lit, range(6)))))
              .select((F.col("doc_id") * 10 + F.col("n")).alias("doc_id"), F.concat("text", F.lit(" w"), "n").alias("text")))
    rows = plain(df)
    got = simhash.near_duplicates(df).collect()
    assert Counter((r["id"], r["fp"] & (1 << 64) - 1) for r in got) == Counter((i, _fingerprint(t)) for i, t in rows)
    classes = _classes([r["fp"] & (1 << 64) - 1 for r in got])
    least = {}
    for r in got:
        c = classes[r["fp"] & (1 << 64) - 1]
        if r["id"] is not None:
            least[c] = min(least.get(c, r["id"]), r["id"])
    assert all(r["component_id"] == least.get(classes[r["fp"] & (1 << 64) - 1]) for r in got)
    assert source != "near" or len(set(classes.values())) < len(classes)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len({classes[r["fp"] & (1 << 64) - 1] for r in got})


def test_simhash_keeps_a_row_of_each_component_under_null_and_repeated_ids(spark):
    texts = [prose(k, 60) for k in range(8)]
    rows = [(None, t) for t in texts[:5]] + [(None, texts[0]), (3, texts[5]), (3, texts[6]), (3, texts[6]), (4, texts[7]), (9, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    want = Counter([(None, t) for t in texts[:5]] + [(3, texts[5]), (3, texts[6]), (4, texts[7])])
    assert Counter(plain(simhash.keep_one(df))) == want


def test_simhash_empty(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0 == simhash.keep_one(empty_docs(spark)).count()


def test_file_links_walks_like_all_pairs():
    rng = np.random.default_rng(3)
    center = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    f = np.unique(np.array([c ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for c in center for a, b in rng.integers(0, 60, (12, 2))], np.uint64))
    for key in (np.zeros(len(f), np.int64), np.arange(len(f)) // 10):
        i, j = simhash.file_links(key, f, 3)
        assert (np.bitwise_count(f[i] ^ f[j]) <= 3).all() and (key[i] == key[j]).all()

        def groups(pairs):
            p = list(range(len(f)))

            def root(x):
                while p[x] != x:
                    x = p[x]
                return x
            for a, b in pairs:
                p[root(a)] = root(b)
            return {frozenset(k for k in range(len(f)) if root(k) == r) for r in {root(k) for k in range(len(f))}}
        every = [(a, b) for a in range(len(f)) for b in range(a) if key[a] == key[b] and int(f[a] ^ f[b]).bit_count() <= 3]
        assert groups(zip(i.tolist(), j.tolist(), strict=True)) == groups(every)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(1000, 1200)] + [(7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, 500: 500, **{k: 500 for k in range(1000, 1200)}}


def _kept(rows, window):
    seen, out = set(), Counter()
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    for k in order:
        words = (rows[k][1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        left = [w for w, g in zip(words, gone, strict=True) if not g]
        out[rows[k][0], len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("source", ["edges", "documents", "small shards"])
def test_substring_dedup(spark, source, monkeypatch):
    if source == "small shards":        # many shards, hot grams and several flushes per task
        monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50_000)
        monkeypatch.setattr(substring_dedup, "HOT_LEAST", 2)
        monkeypatch.setattr(substring_dedup, "FLUSH_SEGMENTS", 3_000)
        monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 100_000)
    df = edge_docs(spark) if source == "edges" else table(spark, SF, "documents")
    got = substring_dedup.remove_repeats(df).collect()
    assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == _kept(plain(df), 20)


def test_substring_dedup_other_windows_and_empty(spark):
    rows = [(i, "a b c d e f g"[: 2 * (i % 7) + 1] + " x" * (i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (2, 5):
        got = substring_dedup.remove_repeats(df, window=window).collect()
        assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == _kept(rows, window)
    assert substring_dedup.remove_repeats(empty_docs(spark)).count() == 0


def test_fm_index_counts():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 4, 400)
    text[-1] = 0
    index = substring_dedup.FMIndex(text, 8)
    for _ in range(200):
        at, n = int(rng.integers(0, 380)), int(rng.integers(1, 9))
        pattern = text[at:at + n]
        low, high = np.array([index.first[pattern[-1]]]), np.array([index.first[pattern[-1] + 1]])
        for c in pattern[-2::-1]:
            low, high = index.extend(np.array([c]), low, high)
        places = [i for i in range(len(text) - n + 1) if (text[i:i + n] == pattern).all()]
        assert sorted(index.order[low[0]:high[0]].tolist()) == places


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8, 20])
def test_windows_are_searched_in_step(window, monkeypatch):
    """Every repeated window and its places, with a step a word of the window and not one a word of the segments."""
    rng = np.random.default_rng(window)
    line = rng.integers(1, 50, 400)
    size = rng.integers(window, window + 64, 30)
    cut = [line[i:i + k] for i, k in zip(rng.integers(0, 400 - size), size, strict=True)]
    base = np.cumsum(size + 1) - size - 1
    text = np.concatenate([np.r_[c, 0] for c in cut])
    steps = []
    extend = substring_dedup.FMIndex.extend
    monkeypatch.setattr(substring_dedup.FMIndex, "extend", lambda self, *a: steps.append(1) or extend(self, *a))
    index = substring_dedup.FMIndex(text, window)
    place, low, high = substring_dedup.repeated_windows(index, text, base, size, window)
    want = {}
    for b, k in zip(base.tolist(), size.tolist(), strict=True):
        for i in range(b, b + k - window + 1):
            want.setdefault(tuple(text[i:i + window]), []).append(i)
    got = {p: sorted(index.order[lo:hi].tolist()) for p, lo, hi in zip(place.tolist(), low, high, strict=True)}
    assert len(got) == len(place) and got == {p: sorted(v) for v in want.values() if len(v) > 1 for p in v}
    assert len(got) > 20 and len(steps) < window


def test_pack_is_valid_and_tight():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(0, 40))
        size = rng.integers(0, 17, n)
        b, o, c = packing.pack(size, (4, 8, 16), (5, 9, 17))
        for x in set(b.tolist()):
            k = np.flatnonzero(b == x)
            k = k[np.lexsort((size[k], o[k]))]
            assert (o[k][1:] == (o[k] + size[k])[:-1]).all() and o[k][0] == 0
            assert set(c[k]) == {min(z for z in (4, 8, 16) if z >= size[k].sum())}


def test_packing(spark):
    df = edge_docs(spark)
    got = packing.best_fit(df, shard_rows=5).collect()
    total = Counter()
    for r in got:
        total[r["id"]] += r["length"]
        assert 0 <= r["offset"] and r["offset"] + r["length"] <= r["capacity"] and r["capacity"] in packing.CAPACITIES
    want = Counter()
    for i, t in plain(df):
        want[i] += len((t or "").encode())
    assert total == want
    assert sum(r["piece"] == 0 for r in got) == df.count()
    assert packing.best_fit(empty_docs(spark)).count() == 0
    docs = table(spark, SF, "documents")
    rows = packing.best_fit(docs).collect()
    bins = {r["bin"]: r["capacity"] for r in rows}
    assert sum(r["length"] for r in rows) > 0.98 * sum(bins.values())
