"""Byte-level BPE: the library on whole texts, awkward rows, and exact round trips."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from llm_helpers import edge_docs, empty_docs, plain
from pyspark.sql import functions as F

from lifeboat.llm import byte_bpe, catalog
from lifeboat.llm.common import table

SF = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("source", ["edges", "documents"])
def test_ids_are_the_library_s(spark, library, source):
    df = edge_docs(spark) if source == "edges" else table(spark, SF, "documents")
    got = byte_bpe.decode(byte_bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    want = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in plain(df))
    assert Counter((r["id"], tuple(r["ids"]), bytes(r["bytes"])) for r in got) == want


def test_query_digests(spark, library, tmp_path):
    edge_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op13_byte_bpe"][0](spark, str(tmp_path)).collect()
    want = Counter()
    for i, t in plain(edge_docs(spark)):
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    empty = byte_bpe.encode(empty_docs(spark), PATH, P.PATTERN)
    assert empty.count() == 0 and byte_bpe.decode(empty, PATH, P.PATTERN).count() == 0


def test_cuts_change_no_id(library, monkeypatch):
    """Random texts of awkward characters, cut every few characters, encode as a whole."""
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 3)
    monkeypatch.setattr(byte_bpe, "_BLANK", byte_bpe.re.compile(f"[{byte_bpe.WHITE}]{{4,}}"))
    codec = byte_bpe.Codec(byte_bpe.rank_bytes(PATH), P.PATTERN)
    rng = random.Random(3)
    alphabet = "ab'sred  \n\t\xa0\x85\x1c\x1f\u2003\u3000\u1680\u20281\uff19\xe9\u4e2d\U0001f642!.,-<|endoftext|>\x00"
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert codec.encode(text) == library.encode_ordinary(text), repr(text)
        assert "".join(p for p, _ in byte_bpe.pieces(text)) == text


def test_very_long_runs(library):
    codec = byte_bpe.Codec(byte_bpe.rank_bytes(PATH), P.PATTERN)
    for text in (" " * 200_000 + "a b", "q" * 200_000, "\n" * 150_000, "a" + " " * 100_000, "word 12! " * 30_000):
        assert codec.encode(text) == library.encode_ordinary(text)
    text = "x" + " " * 3_000_000 + "y" + "\n" * 2_000_000     # more than the library's regex engine takes at once
    assert codec.decode(codec.encode(text)) == text.encode()


def test_odd_rows(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(unhex('61ff62') AS string) AS text, 9 AS ids, 8 AS bytes")
    got = byte_bpe.decode(byte_bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).first()
    assert bytes(got["bytes"]).decode() == "a\ufffdb"
    none = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert [bytes(r["bytes"]) for r in byte_bpe.decode(none, PATH, P.PATTERN).collect()] == [b"", b""]
    with pytest.raises(Exception, match="(?i)invalid token|KeyError|99999"):
        byte_bpe.decode(spark.createDataFrame([(1, [99999])], "id long, ids array<int>"), PATH, P.PATTERN).collect()
    assert byte_bpe.encode(df.withColumn("text", F.lit(None)), PATH, P.PATTERN).first()["ids"] == []
