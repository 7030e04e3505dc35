"""Exact dedup, token counts, secret scan and chat rotation against plain computations."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from llm_helpers import edge_docs, empty_docs, plain, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lifeboat.llm import chat, exact_dedup, secret_scan, token_count
from lifeboat.llm.common import table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def _check_exact(df, got):
    rows = plain(df)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = Counter((i, max([x for x in groups[t or ""] if x is not None], default=None), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_edges(spark):
    df = edge_docs(spark)
    _check_exact(df, exact_dedup.exact_dedup(df).collect())
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns and left.count() == len({t or "" for _, t in plain(df)})
    assert exact_dedup.exact_dedup(empty_docs(spark)).count() == 0
    assert exact_dedup.drop_copies(empty_docs(spark)).columns == df.columns


def test_exact_dedup_verifies_identifiers(spark):
    """With a hash that collides all the time the verified identifiers still tell texts apart."""
    df = edge_docs(spark).unionByName(edge_docs(spark).withColumn("text", F.concat(F.lit(prose(5, 3000)), "text")))
    _check_exact(df, exact_dedup.exact_dedup(df, chunk_hash=lambda c: F.pmod(F.length(c), F.lit(3)).cast("long")).collect())


def test_chunks_are_the_text(spark):
    text = "\n".join(prose(i, 300) for i in range(60)) + "z" * 20_000
    got = spark.createDataFrame([(text,)], "t string").select(exact_dedup.chunk_array(F.col("t")).alias("c")).first()["c"]
    assert "".join(got) == text and len(got) > 10 and max(map(len, got)) <= 8192
    moved = spark.createDataFrame([("x" * 50 + text,)], "t string").select(exact_dedup.chunk_array(F.col("t")).alias("c")).first()["c"]
    assert len(set(got) & set(moved)) > 0.8 * len(got)


@pytest.mark.parametrize("source", ["edges", "documents"])
def test_token_counts_are_the_library_s(spark, source):
    df = edge_docs(spark) if source == "edges" else table(spark, SF, "documents")
    tok = Tokenizer.from_file(PATH)
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in plain(df))
    got = token_count.count_tokens(df, PATH).collect()
    assert Counter((r["id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_count.count_tokens(empty_docs(spark), PATH).count() == 0


def test_safe_boundaries(spark):
    tok = Tokenizer.from_file(PATH)
    counter = token_count.Counter(token_count.json_encoder(PATH))
    texts = ["a  b", " lead", "trail ", "a \n b", "\n x", "it's we'll 's", "<|endoftext|> a <|endoftext|>b", "x <|endoftext|>  y", "a  b  c",
             "日本 語 文", "1 22 333", "a\x1c b", "é è", "word. Next, (this) -- ok", " ", "  ", "　 a", "tab\t x"]
    assert counter.count(texts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def _spans(text):
    out = []
    for no, k in enumerate(secret_scan.BASE + secret_scan.ADDED):
        out += [(m.start(), no, m.end(), k.name, m[k.group]) for m in re.finditer(k.pattern, text) if len(m[k.group]) >= k.least]
    return sorted(out)


def test_secret_scan(spark):
    key, hexa = "AKIA" + "Q" * 16, "0123456789abcdef" * 3
    texts = [(1, f'é password = "hunter2hunter2", token:short TOKEN=abcdefgh1 {key}', "a"), (2, f"{hexa}\n{key} {hexa}", "b"), (3, f"{key} api-key x", "c"),
             (4, None, None), (5, "", "a"), (6, "token=secret=abcdefghijk api_key:\"zzzzzzzzz\" token=api_key:abcdefghijk", "a"),
             (7, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghijk", "a"),
             (8, "passwd:x " + "secret=abcdefgh " * 3000, "d"), (2, f"{hexa}\n{key} {hexa}", "b"), (None, "PassWord=12345678", "a")]
    df = spark.createDataFrame([(i, t, s, "en", "x", "y") for i, t, s in texts], "doc_id long, text string, source string, lang string, row_id string, found string")
    got = secret_scan.secret_scan(df, owner=F.col("source"), repository=F.col("source")).collect()
    want = Counter((i, tuple((s, e, k) for s, _, e, k, _ in _spans(t or ""))) for i, t, _ in texts)
    assert Counter((r["id"], tuple((f["start"], f["end"], f["kind"]) for f in r["found"])) for r in got) == want
    by = {f["kind"]: f for r in got if r["id"] == 1 for f in r["found"]}
    assert by["access"]["n_owners"] == 3 and by["access"]["copied"] and not by["assign"]["copied"]
    assert secret_scan.secret_scan(df.limit(0), owner=F.col("source")).count() == 0


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé"), (1, 3, "cy", None), (1, 3, "cy", None), (2, 0, "system", "alone"),
            (None, 0, None, "x"), (3, None, "user", "first"), (3, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "conv_id long, turn long, role string, text string, perspective string, people int")
    got = chat.rotate(df).collect()
    want = sum(len({r[2] or "unknown" for r in rows if r[0] == c} - {"system"}) * sum(r[0] == c for r in rows) for c in (1, 2, 3, None))
    assert len(got) == want
    for r in got:
        inside = r["rendered"][r["loss_start"]:r["loss_end"]]
        assert r["trained"] == (r["role"] == "assistant") == (inside != "")
        assert not r["trained"] or inside.endswith(chat.END)
        assert r["rendered"].startswith(f"{chat.START}{r['role']}" + (f" name={r['name']}" if r["name"] else "") + "\n")
    ann = [r for r in got if r["conv_id"] == 1 and r["perspective"] == "ann"]
    assert Counter((r["role"], r["name"]) for r in ann) == Counter([("system", None), ("assistant", None), ("user", "bob"), ("user", "cy"), ("user", "cy")])
    assert [r["rendered"] for r in got if r["conv_id"] is None] == ["<|im_start|>assistant\nx<|im_end|>\n"]
    assert chat.rotate(df.limit(0)).count() == 0
